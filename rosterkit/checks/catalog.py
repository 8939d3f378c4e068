"""Check queries (Spark) and their SQL oracles (DuckDB), by name.

Every query reads whole driver tables at ``sf_dir``; the oracle for the
same name restates the operator in SQL over the same derived input.
Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inputs as I
from . import sqlx as X

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_REGISTERED: dict[tuple[int, str], str] = {}


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the named driver tables as temp views (once per session
    and path; a different ``sf_dir`` replaces the view)."""
    for n in names:
        path = f"{sf_dir}/{n}.parquet"
        key = (id(spark), n)
        if _REGISTERED.get(key) == path and spark.catalog.tableExists(n):
            continue
        spark.read.parquet(path).createOrReplaceTempView(n)
        _REGISTERED[key] = path


def derive(spark: SparkSession, sf_dir: str, sql: str, tables: tuple[str, ...],
           headers: dict[str, str] | None = None) -> DataFrame:
    views(spark, sf_dir, *tables)
    df = spark.sql(sql)
    if headers:
        df = df.withColumnsRenamed(headers)
    return df


def cte(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items())


# --------------------------------------------------------------------------- scorecard

def _score_inputs(spark, sf):
    s = derive(spark, sf, I.STUDENTS, ("customer",), I.STUDENT_HEADERS)
    d = derive(spark, sf, I.DEGREES, ("orders",), I.DEGREE_HEADERS)
    w = derive(spark, sf, I.WORK, ("orders", "lineitem"), I.WORK_HEADERS)
    return s, d, w


_S_BASE = f"""
s0 AS (
  SELECT _ordinal, trim(email) AS email, {X.email_key('email')} AS _email_key,
         first_name AS firstName, last_name AS lastName, entry_semester AS studentScaleSemester,
         defense_experience AS defenseExperienceRaw
  FROM students WHERE {X.email_key('email')} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {X.email_key('email')} ORDER BY _ordinal) = 1),
s1 AS (
  SELECT *, {X.coded_flag('defenseExperienceRaw', 20, ('yes', 'y', 'true', '1', '20', '20.0'))}
              AS hasDefenseExperience,
         {X.flexible_date('studentScaleSemester', 'start', 'strict')} AS _start_date
  FROM s0)"""

_D_AGG = f"""
d0 AS (
  SELECT {X.email_key('student_email')} AS _email_key,
         upper(trim(coalesce(degree_type, ''))) AS _type,
         {X.graduate_degree('degree_type')} AS _grad,
         {X.flexible_date('grad_date', 'end', 'strict')} AS _gdate
  FROM degrees WHERE {X.email_key('student_email')} IS NOT NULL),
da AS (
  SELECT _email_key, count(*) AS totalDegrees, CAST(count_if(_grad) AS BIGINT) AS graduateDegreeCount,
         coalesce(array_to_string(list_sort(list_distinct(list(_type) FILTER (WHERE _type <> ''))), ', '), '')
           AS degreeTypes,
         max(_gdate) AS _latest_grad
  FROM d0 GROUP BY _email_key)"""

_W_AGG = f"""
w0 AS (
  SELECT {X.email_key('student_email')} AS _email_key,
         {X.coded_flag('defense_related', 1, ('yes', 'y', 'true', '1'))} AS _def
  FROM work WHERE {X.email_key('student_email')} IS NOT NULL),
wa AS (
  SELECT _email_key, count(*) AS totalWorkExperiences,
         CAST(count_if(_def) AS BIGINT) AS defenseWorkExperiences
  FROM w0 GROUP BY _email_key)"""


def _scored_sql(min_years=2.0, min_total=2, min_def=1) -> str:
    return f"""
j AS (
  SELECT s1.*, coalesce(da.totalDegrees, 0) AS totalDegrees,
         coalesce(da.graduateDegreeCount, 0) AS graduateDegreeCount,
         coalesce(da.degreeTypes, '') AS degreeTypes, da._latest_grad,
         coalesce(wa.totalWorkExperiences, 0) AS totalWorkExperiences,
         coalesce(wa.defenseWorkExperiences, 0) AS defenseWorkExperiences,
         {X.years_between('s1._start_date', 'da._latest_grad')} AS yearsInScaleBeforeGraduation
  FROM s1 LEFT JOIN da USING (_email_key) LEFT JOIN wa USING (_email_key)),
scored AS (
  SELECT _ordinal, firstName, lastName, email, defenseExperienceRaw, hasDefenseExperience,
         studentScaleSemester, {X.mdy('_start_date')} AS scaleStartDate,
         {X.mdy('_latest_grad')} AS graduationDateUsed, yearsInScaleBeforeGraduation,
         coalesce(yearsInScaleBeforeGraduation >= CAST({min_years} AS DOUBLE), false) AS inScaleTwoPlusYears,
         totalDegrees, graduateDegreeCount, degreeTypes,
         totalDegrees >= 2 AS hasMultipleDegrees, graduateDegreeCount >= 1 AS hasGraduateDegreeMSorPHD,
         totalDegrees >= 2 AND graduateDegreeCount >= 1 AS meetsDegreeCriteria,
         totalWorkExperiences, defenseWorkExperiences,
         totalWorkExperiences >= {min_total} AND defenseWorkExperiences >= {min_def}
           AS meetsStrongInternshipCriteria,
         hasDefenseExperience AND coalesce(yearsInScaleBeforeGraduation >= CAST({min_years} AS DOUBLE), false)
           AND totalDegrees >= 2 AND graduateDegreeCount >= 1
           AND totalWorkExperiences >= {min_total} AND defenseWorkExperiences >= {min_def} AS meetsAllCriteria
  FROM j)"""


def _score_cte(min_years=2.0, min_total=2, min_def=1) -> str:
    return (cte(students=I.STUDENTS, degrees=I.DEGREES, work=I.WORK) + ",\n"
            + ",\n".join([_S_BASE, _D_AGG, _W_AGG, _scored_sql(min_years, min_total, min_def)]))


_SCORE_COLS = ("firstName, lastName, email, defenseExperienceRaw, hasDefenseExperience, "
               "studentScaleSemester, scaleStartDate, graduationDateUsed, yearsInScaleBeforeGraduation, "
               "inScaleTwoPlusYears, totalDegrees, graduateDegreeCount, degreeTypes, hasMultipleDegrees, "
               "hasGraduateDegreeMSorPHD, meetsDegreeCriteria, totalWorkExperiences, "
               "defenseWorkExperiences, meetsStrongInternshipCriteria, meetsAllCriteria")
_CAND_COLS = ("firstName, lastName, email, hasDefenseExperience, studentScaleSemester, scaleStartDate, "
              "graduationDateUsed, yearsInScaleBeforeGraduation, totalDegrees, degreeTypes, "
              "totalWorkExperiences, defenseWorkExperiences")


@query("q_scorecard", _score_cte() + f"\nSELECT {_SCORE_COLS} FROM scored")
def q_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import scorecard
    return scorecard(*_score_inputs(spark, sf))


@query("q_candidates", _score_cte() + f"\nSELECT {_CAND_COLS} FROM scored WHERE meetsAllCriteria")
def q_candidates(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import ScorecardParams, candidates, scorecard
    p = ScorecardParams()
    return candidates(scorecard(*_score_inputs(spark, sf), p, keep_order=True), p)


@query("q_candidates_order", _score_cte() + """
SELECT email, row_number() OVER (ORDER BY defenseWorkExperiences DESC NULLS LAST, totalWorkExperiences DESC NULLS LAST,
                                          yearsInScaleBeforeGraduation DESC NULLS LAST, _ordinal) AS place
FROM scored WHERE meetsAllCriteria""")
def q_candidates_order(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every candidate, as the job gives it."""
    from ..plans.scorecard import ScorecardParams, candidates, scorecard
    p = ScorecardParams()
    return candidates(scorecard(*_score_inputs(spark, sf), p, keep_order=True), p, place="place").select("email", "place")


@query("q_score_summary", _score_cte() + """
SELECT metric, value FROM (
  SELECT 'students_evaluated' AS metric, CAST(count(*) AS DOUBLE) AS value FROM scored
  UNION ALL SELECT 'students_meeting_all_criteria', CAST(count_if(meetsAllCriteria) AS DOUBLE) FROM scored
  UNION ALL SELECT 'minimum_years_in_scale', CAST(2.0 AS DOUBLE)
  UNION ALL SELECT 'minimum_total_work_experiences', CAST(2 AS DOUBLE)
  UNION ALL SELECT 'minimum_defense_work_experiences', CAST(1 AS DOUBLE))""")
def q_score_summary(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import score_summary, scorecard
    return score_summary(scorecard(*_score_inputs(spark, sf)))


@query("q_params", _score_cte(1.5, 3, 2) + f"\nSELECT {_SCORE_COLS} FROM scored")
def q_params(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import ScorecardParams, scorecard
    p = ScorecardParams(min_years=1.5, min_total_work_experiences=3,
                        min_defense_work_experiences=2)
    return scorecard(*_score_inputs(spark, sf), p)


@query("q_students_base", cte(students=I.STUDENTS) + "," + _S_BASE + """
SELECT email, _email_key, firstName, lastName, studentScaleSemester, defenseExperienceRaw,
       hasDefenseExperience, _start_date FROM s1""")
def q_students_base(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import students_base
    s = derive(spark, sf, I.STUDENTS, ("customer",), I.STUDENT_HEADERS)
    return students_base(s).select("email", "_email_key", "firstName", "lastName",
                                   "studentScaleSemester", "defenseExperienceRaw",
                                   "hasDefenseExperience", "_start_date")


@query("q_degrees_agg", cte(degrees=I.DEGREES) + "," + _D_AGG + "\nSELECT * FROM da")
def q_degrees_agg(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import degrees_summary
    return degrees_summary(derive(spark, sf, I.DEGREES, ("orders",), I.DEGREE_HEADERS))


@query("q_work_agg", cte(work=I.WORK) + "," + _W_AGG + "\nSELECT * FROM wa")
def q_work_agg(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.scorecard import work_summary
    return work_summary(derive(spark, sf, I.WORK, ("orders", "lineitem"), I.WORK_HEADERS))


# --------------------------------------------------------------------------- reconcile

def _recon_inputs(spark, sf):
    m = derive(spark, sf, I.MASTER, ("customer", "orders"), I.MASTER_HEADERS)
    s = derive(spark, sf, I.SYSTEM, ("customer", "orders"), I.SYSTEM_HEADERS)
    return m, s


def _recon_params():
    from ..plans.reconcile import ReconcileParams
    return ReconcileParams(program_version="V7", as_of=I.RECONCILE_AS_OF)


def _key(prefix: str = "") -> str:
    f, l, d = f"{prefix}first_name", f"{prefix}last_name", f"{prefix}dob"
    nf, nl = X.norm_name(f), X.norm_name(l)
    return (f"CASE WHEN {nf} <> '' OR {nl} <> '' THEN {nf} || '|' || {nl} || '|' || "
            f"coalesce(CAST({X.date_text(d)} AS VARCHAR), 'None') END")


_RECON_CTE = cte(master=I.MASTER, system=I.SYSTEM) + f""",
sk AS (SELECT DISTINCT {_key()} AS k FROM system),
se AS (SELECT DISTINCT {X.email_key('e')} AS e FROM (SELECT email AS e FROM system
        UNION ALL SELECT mentor_email FROM system) t),
flag AS (
  SELECT master.*,
         EXISTS (SELECT 1 FROM sk WHERE sk.k = {_key('master.')}) AS in_name,
         EXISTS (SELECT 1 FROM se WHERE se.e = {X.email_key('master.email')}) AS in_email,
         coalesce(lower(trim({X.status('master.status')})) IN ('current', 'no mentor'), false) AS allowed,
         {X.date_text('master.application_date')} AS app
  FROM master),
new_rows AS (SELECT * FROM flag WHERE NOT in_name AND NOT in_email AND allowed)"""

_MASTER_OUT = ", ".join(["_ordinal"] + [f'{k} AS "{v}"' for k, v in I.MASTER_HEADERS.items()])


@query("q_new_rows", _RECON_CTE + f"\nSELECT {_MASTER_OUT} FROM new_rows")
def q_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.reconcile import reconcile
    return reconcile(*_recon_inputs(spark, sf), _recon_params()).new_rows


@query("q_new_rows_stored", _RECON_CTE + f"\nSELECT {_MASTER_OUT} FROM new_rows")
def q_new_rows_stored(spark: SparkSession, sf: str) -> DataFrame:
    """JN2 JN3 X4: the same against the export's keys, kept as bucketed tables."""
    import uuid
    from ..plans.reconcile import reconcile, stored_system_keys
    master, system = _recon_inputs(spark, sf)
    keys = stored_system_keys(system, f"export_{uuid.uuid4().hex[:12]}", 16, _recon_params())
    return reconcile(master, keys, _recon_params()).new_rows


@query("q_recent_suppressed", _RECON_CTE + f"""
SELECT trim(trim(coalesce(first_name, '')) || ' ' || trim(coalesce(last_name, ''))) AS "Name",
       trim(email) AS "Email", {X.mdy('app')} AS "Application Date",
       CASE WHEN in_email AND in_name THEN 'Email match; Name+DOB match'
            WHEN in_email THEN 'Email match' ELSE 'Name+DOB match' END AS "Suppression Reason"
FROM flag WHERE (in_name OR in_email) AND app >= DATE '{I.RECONCILE_AS_OF}' - 21""")
def q_recent_suppressed(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.reconcile import reconcile
    return reconcile(*_recon_inputs(spark, sf), _recon_params()).suppressed_recent


def _template_sql() -> str:
    from ..plans.reconcile import TEMPLATE_COLUMNS
    yes, no = "'yes', 'y', '1', 'true'", "'no', 'n', '0', 'false'"
    m = {
        "firstName": "first_name", "lastName": "last_name", "email": "email",
        "middleName": "middle_name", "preferredNameOrTitle": "preferred_name",
        "vertical": X.vertical("technical_area"),
        "linkedInPage": "linkedin",
        "isCitizen": f"CAST(CASE WHEN lower(citizen) IN ({yes}) THEN 1 WHEN lower(citizen) IN ({no}) "
                     f"THEN 0 END AS INTEGER)",
        "race": "race", "gender": X.gender("gender"),
        "scaleApplicationDate": "app", "scaleppApplicationDate": "app",
        "studentScaleSemester": "'Spring 2026'", "studentCurrentStatus": X.status("status"),
        "organization": "university",
    }
    m |= {"agreedToDataCollection": "CAST(1 AS INTEGER)", "seekingJobOffer": "CAST(1 AS INTEGER)", "organizationType": "'Academic'",
          "holdSecurityClearance": "CAST(0 AS INTEGER)", "recieveContacts": "CAST(1 AS INTEGER)",
          "grantsDataPermsission": "CAST(1 AS INTEGER)", "scaleVersion": "'V7'"}
    sel = ", ".join(f'{m.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in TEMPLATE_COLUMNS)
    return _RECON_CTE + f"\nSELECT {sel} FROM new_rows"


@query("q_template", _template_sql())
def q_template(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.reconcile import import_template, reconcile
    p = _recon_params()
    return import_template(reconcile(*_recon_inputs(spark, sf), p).new_rows, p)


def _degrees_tab_sql() -> str:
    grad = f"coalesce({X.term_date('expected_graduation', 'end', 'loose')}, {X.date_text('expected_graduation')})"
    masters = X.masters("educational_status")
    doctoral = X.doctoral("educational_status")
    yp = f"(CASE WHEN {masters} THEN 2 ELSE 4 END)"
    back = (f"CASE WHEN g IS NOT NULL THEN make_date(year(g) - {yp}, "
            f"CASE WHEN month(g) = 8 THEN 5 ELSE 8 END, 15) END")
    return _RECON_CTE + f""",
dg AS (SELECT *, {grad} AS g FROM new_rows WHERE email IS NOT NULL AND email <> '')
SELECT email AS studentEmail, university,
       CASE WHEN {doctoral} OR {masters} THEN 'PHD' ELSE 'BS' END AS degreeType, major,
       coalesce({back}, {X.date_text('program_start')}) AS startDate, g AS graduationDate
FROM dg"""


@query("q_degrees_tab", _degrees_tab_sql())
def q_degrees_tab(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.reconcile import degrees_tab, reconcile
    p = _recon_params()
    return degrees_tab(reconcile(*_recon_inputs(spark, sf), p).new_rows, p)
