"""Scorecard job (M1, M2, F1, F2, JN1, P8, P9, P13, P14, T1, B7, C12).

Plan shape: three scans; students deduped by a keyed window, degrees and
work experience pre-aggregated per email key (partial + final hash
aggregation), then two LEFT joins on that same key. The three inputs of
the joins are all hash-partitioned on the email key by their own
exchanges, so the joins add no further shuffle (or AQE turns them into
broadcasts once the aggregated sides are known to be small).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import is_graduate_degree, student_defense_flag, work_defense_flag
from ..functions.dates import flexible_date, format_mdy, years_between
from ..functions.text import email_key, trim_u, upper_code
from ..operators.dedupe import keep_first, ranked
from ..operators.schema import FieldSpec, qcol, standardize


@dataclass(frozen=True)
class ScorecardParams:
    """A10: rule thresholds (constructor arguments of the job)."""
    min_years: float = 2.0
    min_total_work_experiences: int = 2
    min_defense_work_experiences: int = 1
    order_column: str = "_ordinal"


# Header candidates and Excel-letter fallbacks per table.
STUDENT_SPEC = (
    FieldSpec("email", ("email", "studentEmail", "student email", "emailAddress", "email address"),
              required=True),
    FieldSpec("firstName", ("firstName", "first name", "firstname")),
    FieldSpec("lastName", ("lastName", "last name", "lastname", "surname")),
    FieldSpec("studentScaleSemester", ("studentScaleSemester", "student scale semester", "scale semester"),
              fallback_letter="AD", required=True),
    FieldSpec("defenseExperienceRaw",
              ("hasDefenseExperience", "defenseExperience", "defense experience", "in defense"),
              fallback_letter="CE", required=True),
)
DEGREE_SPEC = (
    FieldSpec("email", ("studentEmail", "student email", "email", "emailAddress", "email address"),
              fallback_letter="A", required=True),
    FieldSpec("degreeType", ("degreeType", "degree type", "degree"), fallback_letter="D", required=True),
    FieldSpec("graduationDate", ("graduationDate", "graduation date", "gradDate", "grad date"),
              required=True),
)
WORK_SPEC = (
    FieldSpec("email", ("studentEmail", "student email", "email", "emailAddress", "email address"),
              fallback_letter="O", required=True),
    FieldSpec("defenseRelated", ("defenseRelated", "defense related", "isDefenseRelated"),
              fallback_letter="L", required=True),
)

OUTPUT_COLUMNS = (
    "firstName", "lastName", "email", "defenseExperienceRaw", "hasDefenseExperience",
    "studentScaleSemester", "scaleStartDate", "graduationDateUsed",
    "yearsInScaleBeforeGraduation", "inScaleTwoPlusYears", "totalDegrees", "graduateDegreeCount",
    "degreeTypes", "hasMultipleDegrees", "hasGraduateDegreeMSorPHD", "meetsDegreeCriteria",
    "totalWorkExperiences", "defenseWorkExperiences", "meetsStrongInternshipCriteria",
    "meetsAllCriteria",
)
# Columns of the full table that the candidates list leaves out.
CANDIDATE_HIDDEN = (
    "defenseExperienceRaw", "inScaleTwoPlusYears", "graduateDegreeCount", "hasMultipleDegrees",
    "hasGraduateDegreeMSorPHD", "meetsDegreeCriteria", "meetsStrongInternshipCriteria",
    "meetsAllCriteria",
)


def students_base(students: DataFrame, params: ScorecardParams = ScorecardParams()) -> DataFrame:
    """M1: resolve columns, key by email, drop blank keys, keep the first
    row per key (in ``order_column`` order), derive the flag and start."""
    ordc = params.order_column
    if ordc not in students.columns:
        raise ValueError(f"students needs an order column {ordc!r} (row order decides ties)")
    s = standardize(students, STUDENT_SPEC, keep=[ordc])
    s = s.select(
        qcol(ordc),
        trim_u(F.col("email")).alias("email"),
        email_key(F.col("email")).alias("_email_key"),
        "firstName", "lastName", "studentScaleSemester", "defenseExperienceRaw",
    ).where(F.col("_email_key").isNotNull())
    s = keep_first(s, ["_email_key"], [qcol(ordc).asc()])
    return s.withColumns({
        "hasDefenseExperience": student_defense_flag(F.col("defenseExperienceRaw")),
        "_start_date": flexible_date(F.col("studentScaleSemester"), mode="start", grammar="strict"),
    })


def degrees_summary(degrees: DataFrame) -> DataFrame:
    """per email key: count, graduate-degree count, sorted distinct
    non-empty upper-cased types joined by ', ', latest graduation date."""
    d = standardize(degrees, DEGREE_SPEC)
    d = d.select(
        email_key(F.col("email")).alias("_email_key"),
        upper_code(F.col("degreeType")).alias("_type"),
        is_graduate_degree(F.col("degreeType")).alias("_grad"),
        flexible_date(F.col("graduationDate"), mode="end", grammar="strict").alias("_gdate"),
    ).where(F.col("_email_key").isNotNull())
    # Types are counted before they are listed: a key with many rows is
    # summed on the way, and no task holds more than its distinct types.
    by_type = d.groupBy("_email_key", "_type").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_grad")).alias("_graduate"), F.max("_gdate").alias("_gdate"))
    return by_type.groupBy("_email_key").agg(
        F.sum("_n").alias("totalDegrees"),
        F.sum("_graduate").alias("graduateDegreeCount"),
        F.array_join(F.array_sort(F.collect_list(F.nullif(F.col("_type"), F.lit("")))), ", ")
        .alias("degreeTypes"),
        F.max("_gdate").alias("_latest_grad"),
    )


def work_summary(work: DataFrame) -> DataFrame:
    """per email key: total and defence-related work experiences."""
    w = standardize(work, WORK_SPEC)
    w = w.select(
        email_key(F.col("email")).alias("_email_key"),
        work_defense_flag(F.col("defenseRelated")).alias("_def"),
    ).where(F.col("_email_key").isNotNull())
    return w.groupBy("_email_key").agg(
        F.count(F.lit(1)).alias("totalWorkExperiences"),
        F.count_if(F.col("_def")).alias("defenseWorkExperiences"),
    )


def scorecard(students: DataFrame, degrees: DataFrame, work: DataFrame,
              params: ScorecardParams = ScorecardParams(), keep_order: bool = False) -> DataFrame:
    """M2: every student with the four criteria (20 columns, P13).

    ``keep_order`` also returns the order column (used by
    :func:`candidates` to break ties in input order)."""
    base = students_base(students, params)
    scored = (base.join(degrees_summary(degrees), on="_email_key", how="left")
              .join(work_summary(work), on="_email_key", how="left"))
    zero = F.lit(0).cast("long")
    years = years_between(F.col("_start_date"), F.col("_latest_grad"))
    scored = scored.withColumns({
        "totalDegrees": F.coalesce(F.col("totalDegrees"), zero),
        "graduateDegreeCount": F.coalesce(F.col("graduateDegreeCount"), zero),
        "degreeTypes": F.coalesce(F.col("degreeTypes"), F.lit("")),
        "totalWorkExperiences": F.coalesce(F.col("totalWorkExperiences"), zero),
        "defenseWorkExperiences": F.coalesce(F.col("defenseWorkExperiences"), zero),
        "yearsInScaleBeforeGraduation": years,
        "scaleStartDate": format_mdy(F.col("_start_date")),
        "graduationDateUsed": format_mdy(F.col("_latest_grad")),
    })
    scored = scored.withColumns({
        # NULL >= x is NULL in Spark but False in pandas.
        "inScaleTwoPlusYears": F.coalesce(
            F.col("yearsInScaleBeforeGraduation") >= F.lit(float(params.min_years)),
            F.lit(False)),
        "hasMultipleDegrees": F.col("totalDegrees") >= 2,
        "hasGraduateDegreeMSorPHD": F.col("graduateDegreeCount") >= 1,
        "meetsStrongInternshipCriteria":
            (F.col("totalWorkExperiences") >= F.lit(params.min_total_work_experiences))
            & (F.col("defenseWorkExperiences") >= F.lit(params.min_defense_work_experiences)),
    })
    scored = scored.withColumn("meetsDegreeCriteria",
                               F.col("hasMultipleDegrees") & F.col("hasGraduateDegreeMSorPHD"))
    scored = scored.withColumn("meetsAllCriteria",
                               F.col("hasDefenseExperience") & F.col("inScaleTwoPlusYears")
                               & F.col("meetsDegreeCriteria") & F.col("meetsStrongInternshipCriteria"))
    cols = list(OUTPUT_COLUMNS) + ([params.order_column] if keep_order else [])
    return scored.select(*[qcol(c) for c in cols])


def candidates(scored: DataFrame, params: ScorecardParams = ScorecardParams(),
               sort: bool = True, place: str | None = None) -> DataFrame:
    """P9 + C12 + T1: students meeting every criterion, strongest first
    (defence work, total work, years; NULLs last; ties in input order),
    internal columns removed. ``scored`` must come from
    ``scorecard(..., keep_order=True)`` for the input-order tie-break.
    With ``place`` each row carries its number in that order in this
    column, which a write or a shuffle does not lose."""
    c = scored.where(F.col("meetsAllCriteria"))
    if sort:
        keys = [F.col("defenseWorkExperiences").desc_nulls_last(),
                F.col("totalWorkExperiences").desc_nulls_last(),
                F.col("yearsInScaleBeforeGraduation").desc_nulls_last()]
        if params.order_column in c.columns:
            keys.append(qcol(params.order_column).asc())
        c = ranked(c, keys, place) if place else c.orderBy(*keys)
    drop = [x for x in (*CANDIDATE_HIDDEN, params.order_column) if x in c.columns]
    return c.drop(*drop)


def score_summary(scored: DataFrame, params: ScorecardParams = ScorecardParams()) -> DataFrame:
    """B7 + F6: ``(metric, value DOUBLE)``, five rows, from one aggregate."""
    agg = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("meetsAllCriteria")).alias("k"))

    def row(metric: str, value):
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    return agg.select(F.inline(F.array(
        row("students_evaluated", F.col("n")),
        row("students_meeting_all_criteria", F.col("k")),
        row("minimum_years_in_scale", F.lit(float(params.min_years))),
        row("minimum_total_work_experiences", F.lit(params.min_total_work_experiences)),
        row("minimum_defense_work_experiences", F.lit(params.min_defense_work_experiences)),
    )))


def run_scorecard(tables: dict[str, DataFrame], params: ScorecardParams = ScorecardParams()
                  ) -> dict[str, DataFrame]:
    """A1 + M2 + B1 inputs: pick the three tables of a workbook by name
    (C2) and return the three report tables."""
    from ..operators.schema import resolve_sheet
    names = list(tables)
    s = tables[resolve_sheet(names, ["students", "student"])]
    d = tables[resolve_sheet(names, ["degrees", "degree"])]
    w = tables[resolve_sheet(names, ["workExperience", "work experience", "work_experience", "work"])]
    scored = scorecard(s, d, w, params, keep_order=True)
    return {
        "Candidates": candidates(scored, params),
        "AllStudentsEvaluated": scored.drop(params.order_column),
        "Summary": score_summary(scored, params),
    }
