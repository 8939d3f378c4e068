"""Reconcile job (M3, M4, P1-P3, P6, P7, P10, P11, T2, A9, B2 inputs).

A master list is matched against a system export on two keys: the
normalised name (+ DOB when both sides have one) and the email against
*every* email column of the export. Rows found by either key are
suppressed (with the reason); the rest, restricted to an allowed status,
are new and get mapped onto the fixed import template.

Plan shape: each key set of the export is reduced to DISTINCT keys
(partial aggregation), then joined to the master list with a LEFT join
carrying a flag -- two keyed exchanges of the master list, no fan-out,
no OR join condition (that would plan a nested loop).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ..functions.classify import degree_code, program_years_prior
from ..functions.dates import days_before, format_mdy, graduation_date, parse_date_text, \
    start_from_graduation
from ..functions.text import display_name, email_key, normalize_status, translate_gender, \
    translate_vertical, trim_u, truncate_text, yes_no_flag
from ..operators.match import flag_membership, match_reason, name_key, stack_columns, store_keys
from ..operators.schema import columns_containing, detect_columns, empty_frame, first_containing, qcol
from ..session import shared_path


@dataclass(frozen=True)
class ReconcileParams:
    """A10: run parameters of the reconcile job."""
    as_of: str | None = None                 # 'YYYY-MM-DD'; None = today
    recent_days: int = 21                    # suppression report window
    allowed_statuses: tuple[str, ...] = ("current", "no mentor")
    blank_names_match: bool = False          # D4
    system_email_columns: tuple[str, ...] | None = None   # None = every header containing 'email'
    master_overrides: Mapping[str, str] = field(default_factory=dict)
    system_overrides: Mapping[str, str] = field(default_factory=dict)
    semester: str = "Spring 2026"            # written to the semester column
    program_version: str | None = None       # written to the version column; the import template needs it


@dataclass
class ReconcileResult:
    new_rows: DataFrame              # master rows (original columns) to import
    suppressed_recent: DataFrame     # Name, Email, Application Date, Suppression Reason
    flagged: DataFrame               # every master row + _in_name, _in_email, _allowed
    master_mapping: dict[str, str]
    system_mapping: dict[str, str]


def application_date_column(columns: Sequence[str]) -> str | None:
    """Header equal to ``application date`` first, else one containing it."""
    return first_containing(columns, ("application date", "applicationdate"),
                            exact_first="application date")


@dataclass(frozen=True)
class SystemKeys:
    """What :func:`reconcile` asks of a system export: its name keys (with
    or without the date of birth) and its email keys, one column each."""
    columns: Mapping[str, str]
    names: DataFrame
    names_with_dob: DataFrame | None
    emails: DataFrame | None


def _name_key(m: Mapping[str, str], use_dob: bool, params: ReconcileParams) -> Column:
    dob = parse_date_text(qcol(m["dob"])) if use_dob else None
    return name_key(qcol(m["first_name"]), qcol(m["last_name"]), dob, blank_names_match=params.blank_names_match)


def _named(columns: Mapping[str, str], side: str) -> Mapping[str, str]:
    if "first_name" not in columns or "last_name" not in columns:
        raise ValueError(f"Could not detect first/last name columns in the {side}")
    return columns


def system_keys(system: DataFrame, params: ReconcileParams = ReconcileParams()) -> SystemKeys:
    """JN2/JN3/X3: the key sets of a system export."""
    sm = _named(detect_columns(system.columns, overrides=params.system_overrides), "system export")
    cols = list(params.system_email_columns) if params.system_email_columns is not None else columns_containing(system.columns, "email")
    emails = stack_columns(system, cols, "e").select(email_key(F.col("e")).alias("k")) if cols else None
    keys = lambda dob: system.select(_name_key(sm, dob, params).alias("k"))
    return SystemKeys(sm, keys(False), keys(True) if "dob" in sm else None, emails)


def stored_system_keys(system: DataFrame, name: str, buckets: int, params: ReconcileParams = ReconcileParams()) -> SystemKeys:
    """:func:`system_keys` kept as bucketed tables ``<name>_names`` ... in the
    shared folder: an export is read once, however many lists are held
    against it, and its keys are never shuffled again."""
    keys = system_keys(system, params)

    def kept(df: DataFrame | None, what: str) -> DataFrame | None:
        return None if df is None else store_keys(df, f"{name}_{what}", buckets, shared_path(system.sparkSession, f"{name}_{what}"))

    return SystemKeys(keys.columns, kept(keys.names, "names"), kept(keys.names_with_dob, "names_with_dob"), kept(keys.emails, "emails"))


def reconcile(master: DataFrame, system: DataFrame | SystemKeys,
              params: ReconcileParams = ReconcileParams()) -> ReconcileResult:
    """M3: new master rows and the recent-suppression report, against a
    system export or the keys kept of one."""
    keys = system if isinstance(system, SystemKeys) else system_keys(system, params)
    mm, sm = _named(detect_columns(master.columns, overrides=params.master_overrides), "master list"), keys.columns
    use_dob = "dob" in mm and keys.names_with_dob is not None
    flagged = flag_membership(master, _name_key(mm, use_dob, params), keys.names_with_dob if use_dob else keys.names, "_in_name")

    master_email = mm.get("email")
    if master_email is None:
        found = columns_containing(master.columns, "email")
        master_email = found[0] if found else None
    if master_email and keys.emails is not None:
        flagged = flag_membership(flagged, email_key(qcol(master_email)), keys.emails, "_in_email")
    else:
        flagged = flagged.withColumn("_in_email", F.lit(False))

    if "status" in mm:
        st = F.lower(trim_u(normalize_status(qcol(mm["status"]))))
        allowed = F.coalesce(st.isin(*params.allowed_statuses), F.lit(False))
    else:
        allowed = F.lit(True)
    flagged = flagged.withColumn("_allowed", allowed)

    new_rows = flagged.where(~F.col("_in_name") & ~F.col("_in_email") & F.col("_allowed")) \
        .select(*[qcol(c) for c in master.columns])

    app_col = application_date_column(master.columns)
    if app_col is not None:
        app = parse_date_text(qcol(app_col))
        as_of = F.lit(params.as_of).cast("date") if params.as_of else None
        cutoff = days_before(as_of, params.recent_days)
        # The status filter does not apply to this report.
        rep = flagged.where((F.col("_in_name") | F.col("_in_email")) & (app >= cutoff))
        email_out = trim_u(qcol(master_email)) if master_email else F.lit(None).cast("string")
        suppressed = rep.select(
            display_name(qcol(mm["first_name"]), qcol(mm["last_name"])).alias("Name"),
            email_out.alias("Email"),
            format_mdy(app).alias("Application Date"),
            match_reason(F.col("_in_email"), F.col("_in_name")).alias("Suppression Reason"),
            app.alias("_sort_date"),
        ).orderBy(F.col("_sort_date").desc_nulls_last(), F.col("Name").asc()).drop("_sort_date")
    else:
        suppressed = empty_frame(master.sparkSession, SUPPRESSED_SCHEMA)
    return ReconcileResult(new_rows, suppressed, flagged, mm, sm)


SUPPRESSED_SCHEMA = StructType([StructField(n, StringType()) for n in
                                ("Name", "Email", "Application Date", "Suppression Reason")])

# The 52 import-template columns in order (the spelling of
# some names is part of the target schema).
TEMPLATE_COLUMNS = (
    "firstName", "middleName", "lastName", "preferredNameOrTitle", "email",
    "vertical", "webPage", "linkedInPage", "agreedToDataCollection",
    "favoriteActivity", "bestSkills", "organization", "organizationType",
    "race", "isCitizen", "gender", "studentScaleSemester", "scaleApplicationDate",
    "studentCurrentStatus", "seekingJobOffer", "grade",
    "participatedInScaleEventOrMeeting", "helpedWithScaleStudentActivities",
    "participatedInScaleResearch", "researchCreditsEarned", "presentedWork",
    "hasApplied", "enrolledInCourse", "participatedInDesignProject",
    "recievedAcademicCredit", "paidByScale", "interest", "holdSecurityClearance",
    "recieveContacts", "grantsDataPermsission", "reviewCofirmation",
    "scaleSocialMediaMembership", "scaleNanoHubAccess",
    "haveMemberOfScaleGroupOnNanoHub", "usedScaleSocialMediaIntershipOrJobFair",
    "creditHoursFromScaleOrDefense", "ifCreditsEarnedDescribeActivities", "level",
    "attendedOrientationMeeting", "viewedOrientationFile", "technicalTraining",
    "localTraining", "aboutMe", "scaleVersion", "scaleppVertical",
    "scaleppApplicationDate", "studentScaleppSemester",
)
# Constant template cells.
TEMPLATE_FIXED = {
    "agreedToDataCollection": 1, "seekingJobOffer": 1, "organizationType": "Academic",
    "holdSecurityClearance": 0, "recieveContacts": 1, "grantsDataPermsission": 1,
}
FREE_TEXT_FIELDS = ("favoriteActivity", "bestSkills", "interest",
                    "ifCreditsEarnedDescribeActivities", "aboutMe")
# Header patterns of the template's source columns.
TEMPLATE_PATTERNS = {
    "middleName": ("middle name", "middlename", "middle"),
    "preferredNameOrTitle": ("preferred name", "preferredname", "preferred"),
    "vertical": ("vertical", "technical area", "new technical area"),
    "linkedInPage": ("linkedin", "linkedinpage"),
    "isCitizen": ("citizen", "u.s. citizen", "iscitizen"),
    "race": ("race", "ethnicity"),
    "gender": ("gender", "sex"),
    "studentCurrentStatus": ("status", "current status", "student current status"),
    "organization": ("university", "organization", "name of university", "school"),
}
DEGREE_PATTERNS = ("degree type", "degree", "educational status", "program level", "program")
DEGREE_FALLBACK_PATTERNS = ("grade", "level")
MAJOR_PATTERNS = ("major", "field", "discipline")
GRADUATION_PATTERNS = ("graduation date", "graduation", "expected graduation")
START_PATTERNS = ("start date", "program start", "enrollment date", "enrolled date")

def _null_s() -> Column:
    return F.lit(None).cast(StringType())


def import_template(new_rows: DataFrame, params: ReconcileParams = ReconcileParams()) -> DataFrame:
    """One ``select`` from master rows onto the 52-column template.

    Mapped cells copy a detected column (some translated), constants are
    literals, everything else is a NULL string (rendered '' by a sink).
    """
    cols = new_rows.columns
    mm = detect_columns(cols, overrides=params.master_overrides)
    null_s = _null_s()          # one NULL column, aliased wherever a cell is blank

    def src(field_name: str) -> Column | None:
        c = first_containing(cols, TEMPLATE_PATTERNS[field_name])
        return qcol(c) if c is not None else None

    def copy(name: str) -> Column:
        return qcol(mm[name]).cast("string") if name in mm else null_s

    def mapped(field_name: str, fn=None) -> Column:
        c = src(field_name)
        if c is None:
            return null_s
        return fn(c) if fn is not None else c

    app_col = application_date_column(cols)
    app = parse_date_text(qcol(app_col)) if app_col else F.lit(None).cast(DateType())
    citizen = src("isCitizen")
    exprs: dict[str, Column] = {
        "firstName": copy("first_name"),
        "lastName": copy("last_name"),
        "email": copy("email"),
        "middleName": mapped("middleName"),
        "preferredNameOrTitle": mapped("preferredNameOrTitle"),
        "vertical": mapped("vertical", translate_vertical),
        "linkedInPage": mapped("linkedInPage"),
        "isCitizen": yes_no_flag(citizen) if citizen is not None else F.lit(None).cast(IntegerType()),
        "race": mapped("race"),
        "gender": mapped("gender", translate_gender),
        "scaleApplicationDate": app,
        "scaleppApplicationDate": app,
        "studentScaleSemester": F.lit(params.semester),
        "studentCurrentStatus": mapped("studentCurrentStatus", normalize_status),
        "organization": mapped("organization"),
    }
    if params.program_version is None:
        raise ValueError("the import template needs ReconcileParams.program_version")
    exprs["scaleVersion"] = F.lit(params.program_version)
    for k, v in TEMPLATE_FIXED.items():
        exprs[k] = F.lit(v)
    out = []
    for name in TEMPLATE_COLUMNS:
        e = exprs.get(name, null_s)
        if name in FREE_TEXT_FIELDS and e is not null_s:   # NULL stays NULL: nothing to cut
            e = truncate_text(e, 499)
        out.append(e.alias(name))
    return new_rows.select(*out)


DEGREES_SCHEMA = StructType([
    StructField("studentEmail", StringType()), StructField("university", StringType()),
    StructField("degreeType", StringType()), StructField("major", StringType()),
    StructField("startDate", DateType()), StructField("graduationDate", DateType()),
])
WORK_EXPERIENCE_SCHEMA = StructType([StructField(n, StringType()) for n in (
    "studentEmail", "employerName", "employerType", "jobType", "defenseRelated",
    "startDate", "endDate", "hoursPerWeek", "academicCredit")])
MENTORING_SCHEMA = StructType([StructField("studentEmail", StringType()),
                               StructField("mentorEmail", StringType())])


def degrees_tab(new_rows: DataFrame, params: ReconcileParams = ReconcileParams()) -> DataFrame:
    """M4: one degree row per new master row that has an email.

    degreeType from the degree/level column (K5); graduation from the
    loose term grammar (L3); start back-calculated from graduation (L9,
    K6), else the source start date (D18)."""
    cols = new_rows.columns
    mm = detect_columns(cols, overrides=params.master_overrides)
    if "email" not in mm:
        return empty_frame(new_rows.sparkSession, DEGREES_SCHEMA)
    email = qcol(mm["email"])

    def pick(patterns) -> Column | None:
        c = first_containing(cols, patterns)
        return qcol(c) if c is not None else None

    deg = pick(DEGREE_PATTERNS)
    if deg is None:
        deg = pick(DEGREE_FALLBACK_PATTERNS)
    deg_src = deg if deg is not None else F.lit("")
    uni, major = pick(TEMPLATE_PATTERNS["organization"]), pick(MAJOR_PATTERNS)
    grad_src, start_src = pick(GRADUATION_PATTERNS), pick(START_PATTERNS)
    grad = graduation_date(grad_src) if grad_src is not None else F.lit(None).cast(DateType())
    back = start_from_graduation(grad, program_years_prior(deg_src))
    start = F.coalesce(back, parse_date_text(start_src)) if start_src is not None else back
    return new_rows.where(email.isNotNull() & (email.cast("string") != "")).select(
        email.cast("string").alias("studentEmail"),
        (uni.cast("string") if uni is not None else _null_s()).alias("university"),
        degree_code(deg_src).alias("degreeType"),
        (major.cast("string") if major is not None else _null_s()).alias("major"),
        start.cast(DateType()).alias("startDate"),
        grad.alias("graduationDate"),
    )


def import_set(spark: SparkSession, new_rows: DataFrame,
               params: ReconcileParams = ReconcileParams()) -> dict[str, DataFrame]:
    """B2 inputs: the four tables of the import file."""
    return {
        "Users": import_template(new_rows, params),
        "WorkExperience": empty_frame(spark, WORK_EXPERIENCE_SCHEMA),
        "Degrees": degrees_tab(new_rows, params),
        "Mentoring": empty_frame(spark, MENTORING_SCHEMA),
    }


def write_import_set(spark: SparkSession, new_rows: DataFrame, base: str,
                     params: ReconcileParams = ReconcileParams(), fmt: str = "parquet") -> list[str]:
    """B2: write the four import tables; nothing when there are no new
    rows. ``new_rows`` feeds two of them, so it is cached for the
    duration of the writes (recomputed from its inputs if a block is lost)."""
    from ..sources.sinks import write_tables
    cached = new_rows.persist()
    try:
        return write_tables(import_set(spark, cached, params), base, fmt=fmt, require_rows="Users")
    finally:
        cached.unpersist()
