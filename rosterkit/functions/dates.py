"""Academic-term and date parsing as native column expressions.

Two term grammars exist (D1):

* ``strict``: ``term yy[yy]`` or ``yy[yy] term`` with word boundaries on
  both sides of the year (used by the scorecard);
* ``loose``: no boundary after the year in ``term year`` and none before
  the year in ``year term`` (used by the import template's graduation
  dates), e.g. ``Fall 20265`` -> 2026.

When both orders match, ``term year`` wins. Two-digit years get +2000.
Non-term text falls back to a closed list of formats (D2); each format
returns NULL on mismatch, so nothing raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c, trim_u

_TERMS = "spring|summer|fall|sp|su|fa"

# The term grammars.
STRICT_DIRECT = rf"(?iU)\b({_TERMS})\b\s*['\s]*([0-9]{{2,4}})\b"
STRICT_REVERSE = rf"(?iU)\b([0-9]{{2,4}})\b\s*['\s]*({_TERMS})\b"
LOOSE_DIRECT = rf"(?iU)\b({_TERMS})\b\s*['\s]*([0-9]{{2,4}})'?"
LOOSE_REVERSE = rf"(?iU)['\s]*([0-9]{{2,4}})'?\s*\b({_TERMS})\b"
# Documented intent ``Su26``: the term may be glued to the year.
JOINED_DIRECT_STRICT = rf"(?iU)\b({_TERMS})(?:\b|(?=[0-9]))\s*['\s]*([0-9]{{2,4}})\b"
JOINED_DIRECT_LOOSE = rf"(?iU)\b({_TERMS})(?:\b|(?=[0-9]))\s*['\s]*([0-9]{{2,4}})'?"

# Fixed values: (month, day) of a term's start and end.
TERM_START = {"spring": (1, 15), "summer": (5, 15), "fall": (8, 15)}
TERM_END = {"spring": (5, 15), "summer": (8, 15), "fall": (12, 15)}

# Closed lists of fallback formats tried in order after ISO dates (D2),
# with four- and with two-digit years. Each list is one pattern of optional
# sections, so that a column of text is parsed at most once per list.
DATE_FORMATS = (
    "M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "yyyyMMdd", "d-MMM-yyyy", "d-MMMM-yyyy",
    "MMMM yyyy", "MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy",
)
SHORT_YEAR_FORMATS = ("M/d/yy", "d-MMM-yy", "d-MMMM-yy")
# Text that a list may fit: parsing what cannot fit is costly, a test is one regex.
DATE_SHAPE = r"^([0-9]{1,4}[-/][0-9A-Za-z]+[-/][0-9]{1,4}|[0-9]{8}|[A-Za-z]+ ([0-9]{1,2},? )?[0-9]{4}|[0-9]{1,2} [A-Za-z]+ [0-9]{4})$"
SHORT_YEAR_SHAPE = r"[-/][0-9]{2}$"
# Other ways to write those formats, each with its usual form.
DATE_SPELLINGS = (
    (r"(?i)^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?,? ", ""),
    (r"(?i)\bsept\b", "Sep"),
    (r"([A-Za-z]{3,})\.", "$1"),
    (r"([0-9])(st|nd|rd|th)\b", "$1"),
    (r"^([0-9]{1,4})\.([0-9]{1,2})\.([0-9]{1,4})$", "$1/$2/$3"),
    (r"^([A-Za-z]+)[-,] ?([0-9]{4})$", "$1 $2"),
)
# A time of day after the date is dropped.
TIME_OF_DAY = r"[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?( ?[AaPp][Mm])?$"


def _term_name(t: Column) -> Column:
    low = F.lower(t)
    return (F.when(low.isin("sp", "spring"), F.lit("spring"))
            .when(low.isin("su", "summer"), F.lit("summer"))
            .when(low.isin("fa", "fall"), F.lit("fall")))


def term_parts(x: ColumnOrName, grammar: str = "strict", allow_joined: bool = False) -> Column:
    """Struct ``(term, year)`` of a term string, or NULL fields if none.

    ``term`` is one of spring/summer/fall; ``year`` an INT with two-digit
    years moved to 20xx.
    """
    s = trim_u(F.coalesce(_c(x).cast("string"), F.lit("")))
    s = F.replace(s, F.lit("’"), F.lit("'"))
    if grammar == "strict":
        s = F.replace(s, F.lit("-"), F.lit(" "))
        direct = JOINED_DIRECT_STRICT if allow_joined else STRICT_DIRECT
        reverse = STRICT_REVERSE
    elif grammar == "loose":
        s = F.replace(s, F.lit(","), F.lit(" "))
        direct = JOINED_DIRECT_LOOSE if allow_joined else LOOSE_DIRECT
        reverse = LOOSE_REVERSE
    else:
        raise ValueError(f"unknown term grammar {grammar!r}")
    # A match always fills both groups, so "direct matched" is the same
    # as "its group is non-empty": each regex is evaluated once per row.
    term = F.coalesce(F.nullif(F.regexp_extract(s, direct, 1), F.lit("")),
                      F.nullif(F.regexp_extract(s, reverse, 2), F.lit("")))
    year_txt = F.coalesce(F.nullif(F.regexp_extract(s, direct, 2), F.lit("")),
                          F.nullif(F.regexp_extract(s, reverse, 1), F.lit("")))
    year = year_txt.try_cast("int")
    year = year + F.when(year < 100, F.lit(2000)).otherwise(F.lit(0))
    return F.struct(_term_name(term).alias("term"), year.alias("year"))


def term_to_date(x: ColumnOrName, mode: str = "start", grammar: str = "strict",
                 allow_joined: bool = False) -> Column:
    """L1/L3: term string -> DATE at the start or end of the term."""
    table = {"start": TERM_START, "end": TERM_END}[mode]
    p = term_parts(x, grammar, allow_joined)
    months = F.create_map(*[F.lit(v) for t in ("spring", "summer", "fall") for v in (t, table[t][0])])
    days = {table[t][1] for t in table}
    if len(days) != 1:
        raise ValueError("term tables with different days need a day map")
    # make_date only ever sees a matched term (else a NULL input), so it cannot raise.
    return F.make_date(p["year"], F.element_at(months, p["term"]), F.lit(days.pop()))


def parse_date_text(x: ColumnOrName) -> Column:
    """General date text -> DATE, NULL when nothing matches.

    ISO dates and timestamps (and a bare ``yyyy``/``yyyy-MM``) go through
    ``try_cast``; then the closed :data:`DATE_FORMATS` list, with or
    without a time of day after it. Timestamps
    and dates pass through unchanged.
    """
    c = _c(x)
    s = F.nullif(trim_u(c.cast("string")), F.lit(""))
    day = F.regexp_replace(s, TIME_OF_DAY, "")
    usual = day
    for other, form in DATE_SPELLINGS:
        usual = F.regexp_replace(usual, other, form)
    day = F.when(day.rlike("[A-Za-z.]"), usual).otherwise(day)
    # A first number above 12 is the day: put the month first.
    day = F.regexp_replace(day, "^(1[3-9]|[23][0-9])([-/])([0-9]{1,2})([-/])", "$3$2$1$4")
    parse = lambda fmts: F.try_to_date(day, "".join(f"[{f}]" for f in fmts))
    # Two-digit years: 69-99 are 19xx, 00-68 are 20xx.
    short = parse(SHORT_YEAR_FORMATS)
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    listed = F.when(day.rlike(DATE_SHAPE), F.when(day.rlike(SHORT_YEAR_SHAPE) & ~day.rlike("^[0-9]{4}"), short).otherwise(parse(DATE_FORMATS)))
    return F.coalesce(s.try_cast("date"), listed)


def flexible_date(x: ColumnOrName, mode: str = "start", grammar: str = "strict",
                  allow_joined: bool = False) -> Column:
    """L2/L3: a term string first, then general date text."""
    return F.coalesce(term_to_date(x, mode, grammar, allow_joined), parse_date_text(x))


def graduation_date(x: ColumnOrName, allow_joined: bool = False) -> Column:
    """L3: graduation value -> end-of-term DATE (loose grammar) or a date."""
    return flexible_date(x, mode="end", grammar="loose", allow_joined=allow_joined)


def format_mdy(d: ColumnOrName) -> Column:
    """``M/D/YYYY`` without zero padding; NULL stays NULL."""
    return F.date_format(_c(d), "M/d/y")


def format_mmddyyyy(d: ColumnOrName) -> Column:
    """``MM/DD/YYYY``."""
    return F.date_format(_c(d), "MM/dd/yyyy")


def format_month_year(d: ColumnOrName) -> Column:
    """``Month YYYY``."""
    return F.date_format(_c(d), "MMMM yyyy")


def years_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """K7: ``round(days / 365.25, 2)``; NULL if either side is NULL."""
    days = F.datediff(_c(end), _c(start)).cast("double")
    return F.round(days / F.lit(365.25), 2)


def days_before(as_of: ColumnOrName | None, days: int) -> Column:
    """Midnight of ``as_of`` (default today) minus ``days`` days."""
    base = F.current_date() if as_of is None else F.to_date(_c(as_of))
    return F.date_sub(base, days)


def start_from_graduation(grad: ColumnOrName, years_prior: Column) -> Column:
    """Start date = graduation year minus ``years_prior``; an August
    graduation starts on May 15, any other month on Aug 15."""
    g = _c(grad)
    return F.when(g.isNotNull(), F.make_date(
        F.year(g) - years_prior,
        F.when(F.month(g) == 8, F.lit(5)).otherwise(F.lit(8)),
        F.lit(15)))
