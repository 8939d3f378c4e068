"""SQL expression builders for the DuckDB oracles.

The oracles restate each operator in plain SQL, independently of the
Spark code. Inputs in the check data are ASCII, so ``trim``/``lower``
and RE2 word boundaries agree with the Unicode-aware Spark versions.
"""

from __future__ import annotations

TERMS = "spring|summer|fall|sp|su|fa"
# Term grammars (RE2 form; same rules as the Spark side).
STRICT_DIRECT = rf"(?i)\b({TERMS})\b\s*['\s]*([0-9]{{2,4}})\b"
STRICT_REVERSE = rf"(?i)\b([0-9]{{2,4}})\b\s*['\s]*({TERMS})\b"
LOOSE_DIRECT = rf"(?i)\b({TERMS})\b\s*['\s]*([0-9]{{2,4}})'?"
LOOSE_REVERSE = rf"(?i)['\s]*([0-9]{{2,4}})'?\s*\b({TERMS})\b"


def lit(s: str) -> str:
    """A DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"


def email_key(x: str) -> str:
    return f"nullif(lower(trim({x})), '')"


def term_date(x: str, mode: str = "start", grammar: str = "strict") -> str:
    """Term text -> DATE (NULL if no term)."""
    if grammar == "strict":
        norm = f"replace(replace(trim(coalesce({x}, '')), chr(8217), chr(39)), '-', ' ')"
        d, r = STRICT_DIRECT, STRICT_REVERSE
    else:
        norm = f"replace(replace(trim(coalesce({x}, '')), chr(8217), chr(39)), ',', ' ')"
        d, r = LOOSE_DIRECT, LOOSE_REVERSE
    dt = f"regexp_extract({norm}, {lit(d)}, 1)"
    dy = f"regexp_extract({norm}, {lit(d)}, 2)"
    ry = f"regexp_extract({norm}, {lit(r)}, 1)"
    rt = f"regexp_extract({norm}, {lit(r)}, 2)"
    term = f"lower(CASE WHEN {dt} <> '' THEN {dt} ELSE nullif({rt}, '') END)"
    y0 = f"CAST(CASE WHEN {dt} <> '' THEN {dy} ELSE nullif({ry}, '') END AS INTEGER)"
    year = f"(CASE WHEN {y0} < 100 THEN {y0} + 2000 ELSE {y0} END)"
    if mode == "start":
        sp, su, fa = (1, 15), (5, 15), (8, 15)
    else:
        sp, su, fa = (5, 15), (8, 15), (12, 15)
    return (f"(CASE WHEN {term} IN ('sp','spring') THEN make_date({year}, {sp[0]}, {sp[1]}) "
            f"WHEN {term} IN ('su','summer') THEN make_date({year}, {su[0]}, {su[1]}) "
            f"WHEN {term} IN ('fa','fall') THEN make_date({year}, {fa[0]}, {fa[1]}) END)")


def flexible_date(x: str, mode: str = "start", grammar: str = "strict") -> str:
    """Term first, then an ISO date (the only other format in the check data)."""
    return f"coalesce({term_date(x, mode, grammar)}, try_cast(trim({x}) AS DATE))"


def mdy(d: str) -> str:
    return f"strftime({d}, '%-m/%-d/%Y')"


NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def coded_flag(x: str, code: int, words: tuple[str, ...]) -> str:
    t = f"trim({x})"
    ws = ", ".join(lit(w) for w in words)
    return (f"coalesce(CASE WHEN regexp_matches({t}, {lit(NUMERIC_RE)}) "
            f"THEN round_even(CAST({t} AS DOUBLE), 0) = {code} END, "
            f"lower({t}) IN ({ws}), false)")


def graduate_degree(x: str) -> str:
    n = f"regexp_replace(lower({x}), '[^a-z]', '', 'g')"
    return (f"coalesce({n} <> '' AND (contains({n}, 'phd') OR contains({n}, 'doctor') "
            f"OR {n} IN ('ms', 'msc') OR contains({n}, 'master')), false)")


def years_between(a: str, b: str) -> str:
    return f"round(CAST(datediff('day', {a}, {b}) AS DOUBLE) / 365.25, 2)"


def norm_name(x: str) -> str:
    return f"regexp_replace(lower(trim(coalesce({x}, ''))), '\\s+', ' ', 'g')"


def date_text(x: str) -> str:
    """ISO date or M/D/YYYY (the formats present in the check data)."""
    return (f"coalesce(try_cast(trim({x}) AS DATE), "
            f"CAST(try_strptime(trim({x}), '%m/%d/%Y') AS DATE))")


def status(x: str) -> str:
    low = f"regexp_replace(lower(trim({x})), '\\s+', ' ', 'g')"
    return (f"(CASE WHEN {low} = 'current' THEN 'Current' "
            f"WHEN {low} = 'no mentor' OR regexp_full_match({low}, 'current\\s*-\\s*no mentor') "
            f"THEN 'No Mentor' ELSE trim({x}) END)")


def translate(x: str, exact, contains) -> str:
    low = f"lower(trim({x}))"
    parts = [f"WHEN {low} = {lit(k.lower())} THEN {lit(v)}" for k, v in exact]
    for needles, v in contains:
        cond = " OR ".join(f"contains({low}, {lit(n)})" for n in needles)
        parts.append(f"WHEN {cond} THEN {lit(v)}")
    return f"(CASE {' '.join(parts)} ELSE trim({x}) END)"


def contains_any(x: str, pats) -> str:
    low = f"lower(trim({x}))"
    return "coalesce(" + " OR ".join(f"contains({low}, {lit(p)})" for p in pats) + ", false)"


# The oracle's own statement of the fixed vocabularies; nothing is
# imported from the implementation, so a wrong code there shows.

def vertical(x: str) -> str:
    low = f"lower(trim({x}))"
    return (f"(CASE WHEN {low} IN ('system-on-chip (soc)', 'csme (graduate students only)') THEN 'SoC' "
            f"WHEN {low} = 'radiation hardening (rh)' THEN 'RH' "
            f"WHEN {low} = 'embedded security systems/trusted ai (ess/tai)' THEN 'TAI' "
            f"WHEN {low} = 'heterogeneous integration and advanced packaging (hi/ap)' THEN 'HI/AP' "
            f"WHEN contains({low}, 'soc') OR contains({low}, 'system-on-chip') OR contains({low}, 'csme') THEN 'SoC' "
            f"WHEN contains({low}, 'rh') OR contains({low}, 'radiation hardening') THEN 'RH' "
            f"WHEN contains({low}, 'tai') OR contains({low}, 'ess/tai') OR contains({low}, 'trusted ai') THEN 'TAI' "
            f"WHEN contains({low}, 'hi/ap') OR contains({low}, 'heterogeneous integration') THEN 'HI/AP' ELSE trim({x}) END)")


def gender(x: str) -> str:
    low = f"lower(trim({x}))"
    return f"(CASE WHEN {low} IN ('man', 'male') THEN 'Male' WHEN {low} IN ('woman', 'female') THEN 'Female' ELSE trim({x}) END)"


def masters(x: str) -> str:
    return f"coalesce(contains(lower({x}), 'ms') OR contains(lower({x}), 'm.s') OR contains(lower({x}), 'master'), false)"


def doctoral(x: str) -> str:
    return (f"coalesce(contains(lower({x}), 'phd') OR contains(lower({x}), 'ph.d') OR contains(lower({x}), 'doctoral') "
            f"OR contains(lower({x}), 'doctorate'), false)")
