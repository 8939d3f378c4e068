"""Flag and degree classification as native column expressions (K1-K6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c, trim_u

# A number as ``pd.to_numeric`` reads it (after stripping). Guards
# try_cast, which would otherwise also accept ``20D`` or ``Infinity``.
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Text vocabularies of the two defence flags.
STUDENT_FLAG_WORDS = ("yes", "y", "true", "1", "20", "20.0")
WORK_FLAG_WORDS = ("yes", "y", "true", "1")

# Degree vocabularies.
MASTERS_PATTERNS = ("masters graduate student", "master graduate student",
                    "ms", "m.s", "master", "masters")
DOCTORAL_PATTERNS = ("ph.d. graduate student", "ph.d graduate student",
                     "phd graduate student", "phd", "ph.d", "doctoral", "doctorate")


def _coded_flag(x: ColumnOrName, code: int, words: tuple[str, ...]) -> Column:
    s = trim_u(_c(x).cast("string"))
    is_num = s.rlike(NUMERIC_RE)
    num = F.when(is_num, s.try_cast("double"))
    # Python round() is half-to-even, like bround.
    by_number = F.when(is_num, F.bround(num, 0) == F.lit(float(code)))
    by_text = F.lower(s).isin(*words)
    return F.coalesce(by_number, by_text, F.lit(False))


def student_defense_flag(x: ColumnOrName) -> Column:
    """K1: numeric code rounds to 20, or a yes-word; NULL -> false."""
    return _coded_flag(x, 20, STUDENT_FLAG_WORDS)


def work_defense_flag(x: ColumnOrName) -> Column:
    """K2: numeric value rounds to 1, or a yes-word; NULL -> false."""
    return _coded_flag(x, 1, WORK_FLAG_WORDS)


def is_graduate_degree(x: ColumnOrName) -> Column:
    """K3: letters only, lower-cased; contains ``phd``/``doctor``/``master``
    or equals ``ms``/``msc``."""
    n = F.regexp_replace(F.lower(_c(x)), "[^a-z]", "")
    hit = (n.contains("phd") | n.contains("doctor") | n.isin("ms", "msc") | n.contains("master"))
    return F.coalesce((n != "") & hit, F.lit(False))


def _contains_any(low: Column, patterns: tuple[str, ...]) -> Column:
    cond = None
    for p in patterns:
        c = low.contains(p)
        cond = c if cond is None else (cond | c)
    return cond


def is_masters_degree(x: ColumnOrName) -> Column:
    """K4: any master's pattern is a substring of the stripped lower value
    (substring rules misfire on purpose, e.g. ``systems`` contains ``ms``)."""
    low = F.lower(trim_u(_c(x)))
    return F.coalesce(_contains_any(low, MASTERS_PATTERNS), F.lit(False))


def degree_code(x: ColumnOrName) -> Column:
    """K5: doctoral -> ``PHD``; master's -> ``PHD`` (intended); else ``BS``
    (blank or NULL -> ``BS``)."""
    low = F.lower(trim_u(_c(x)))
    doctoral = F.coalesce(_contains_any(low, DOCTORAL_PATTERNS), F.lit(False))
    return F.when(doctoral | is_masters_degree(x), F.lit("PHD")).otherwise(F.lit("BS"))


def program_years_prior(x: ColumnOrName) -> Column:
    """K6: years to go back from graduation: 2 for master's, else 4."""
    return F.when(is_masters_degree(x), F.lit(2)).otherwise(F.lit(4))
