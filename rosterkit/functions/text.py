"""String normalisers as native column expressions (no Python UDFs).

Every function takes and returns a ``Column`` so it stays inside
whole-stage codegen. Python's ``str.strip``/``lower``/``\\s`` are
Unicode-aware, Spark's ``trim`` strips only U+0020, so the helpers use
Java regexes with ``(?U)`` (Unicode character classes) instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Python's str.isspace() also counts U+001C..U+001F; Java's Unicode \s does not.
_WS = r"[\s\u001c-\u001f]"
# Every character Python's str.strip() removes.
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                    + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_u(x: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``).
    A character-set trim, not a regex: cheap enough to repeat."""
    return F.btrim(_c(x), F.lit(WHITESPACE_CHARS))


def collapse_ws(x: ColumnOrName) -> Column:
    """Collapse every run of Unicode whitespace to one space."""
    return F.regexp_replace(_c(x), rf"(?U){_WS}+", " ")


def blank_to_null(x: ColumnOrName) -> Column:
    """A cell that is empty or only whitespace becomes NULL; other
    values are kept unchanged (not stripped)."""
    c = _c(x)
    return F.when(trim_u(c) == "", F.lit(None).cast("string")).otherwise(c)


def alnum_key(x: ColumnOrName) -> Column:
    """Strip, lower-case and drop every run of non ``[a-z0-9]``."""
    return F.regexp_replace(F.lower(trim_u(_c(x))), "[^a-z0-9]+", "")


def email_key(x: ColumnOrName) -> Column:
    """Strip + lower-case; NULL for NULL or blank."""
    return F.nullif(F.lower(trim_u(_c(x))), F.lit(""))


def normalize_name(x: ColumnOrName) -> Column:
    """NULL -> '', lower, strip, collapse whitespace runs to one space."""
    return collapse_ws(trim_u(F.lower(F.coalesce(_c(x).cast("string"), F.lit("")))))


def display_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``strip(first) + ' ' + strip(last)``, stripped; NULL parts are ''."""
    f = trim_u(F.coalesce(_c(first), F.lit("")))
    s = trim_u(F.coalesce(_c(last), F.lit("")))
    return trim_u(F.concat(f, F.lit(" "), s))


def upper_code(x: ColumnOrName) -> Column:
    """NULL -> '', strip, upper-case."""
    return F.upper(trim_u(F.coalesce(_c(x), F.lit(""))))


def truncate_text(x: ColumnOrName, max_length: int = 499) -> Column:
    """Strip, then keep the first ``max_length`` characters.
    NULL stays NULL (rendered as '' by a sink)."""
    return F.substring(trim_u(_c(x)), 1, max_length)


def safe_filename(x: ColumnOrName, default: str = "Unknown_Employer") -> Column:
    """Replace ``<>:"/\\|?*`` by ``_``, collapse whitespace, strip,
    drop trailing dots; blank (or NULL) gives ``default``."""
    c = F.regexp_replace(_c(x), r'[<>:"/\\|?*]', "_")
    c = trim_u(collapse_ws(c))
    c = F.regexp_replace(c, r"\.+$", "")
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def person_key(first: ColumnOrName, last: ColumnOrName, email: ColumnOrName) -> Column:
    """``email:<email>`` when an email is present, else
    ``name:<first last>`` lower-cased, else NULL."""
    e = F.nullif(trim_u(F.lower(F.coalesce(_c(email), F.lit("")))), F.lit(""))
    n = F.nullif(
        F.lower(trim_u(F.concat(trim_u(F.coalesce(_c(first), F.lit(""))), F.lit(" "),
                                trim_u(F.coalesce(_c(last), F.lit("")))))),
        F.lit(""),
    )
    return F.coalesce(F.concat(F.lit("email:"), e), F.concat(F.lit("name:"), n))


def file_basename(path: ColumnOrName) -> Column:
    """The part after the last ``/`` or ``\\``."""
    return F.regexp_extract(_c(path), r"([^/\\]*)$", 1)


def file_extension(name: ColumnOrName) -> Column:
    """Lower-cased extension like ``os.path.splitext`` (leading dots of
    the base name never start an extension; ``'file.'`` gives ``'.'``)."""
    base = file_basename(name)
    return F.lower(F.regexp_extract(base, r"(?s)^\.*[^.].*(\.[^.]*)$", 1))


def resume_filename(first: ColumnOrName, last: ColumnOrName, ext: ColumnOrName) -> Column:
    """``First_Last`` (outer ``_`` stripped) -> safe name -> spaces to
    ``_`` -> ``_Resume`` + lower-cased extension (default ``.pdf``)."""
    full = F.concat(trim_u(F.coalesce(_c(first), F.lit(""))), F.lit("_"),
                    trim_u(F.coalesce(_c(last), F.lit(""))))
    full = F.regexp_replace(full, r"^_+|_+$", "")
    safe = F.replace(safe_filename(F.coalesce(F.nullif(full, F.lit("")), F.lit("Unknown_Student"))),
                     F.lit(" "), F.lit("_"))
    e = F.lower(F.coalesce(_c(ext), F.lit("")))
    e = F.when(e == "", F.lit(".pdf")).otherwise(e)
    return F.concat(safe, F.lit("_Resume"), e)


def url_quote(x: ColumnOrName) -> Column:
    """``urllib.parse.quote`` for names without ``/``: Java's form encoder
    plus the two differences (space and ``~``). ``*`` never reaches it
    because :func:`safe_filename` replaced it."""
    enc = F.url_encode(_c(x))
    return F.replace(F.replace(enc, F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~"))


def resume_url(file_name: ColumnOrName, *, file_base_url: str = "", folder_base_url: str = "",
               local_dir: str = "") -> Column:
    """Public link of a saved résumé. Branch chosen by parameters:
    a per-file base, a shared-folder base (``/:f:/`` links get a
    ``#file=`` hint), else a ``file:///`` path under ``local_dir``."""
    name = _c(file_name)
    if file_base_url:
        return F.concat(F.lit(file_base_url.rstrip("/") + "/"), url_quote(name), F.lit("?web=1"))
    if folder_base_url:
        if "/:f:/" in folder_base_url:
            return F.concat(F.lit(folder_base_url + "#file="), url_quote(name))
        return F.concat(F.lit(folder_base_url.rstrip("/") + "/"), url_quote(name))
    prefix = local_dir.replace("\\", "/")
    prefix = prefix if prefix.endswith("/") or not prefix else prefix + "/"
    return F.concat(F.lit("file:///" + prefix), name)


def hyperlink_formula(url: ColumnOrName, label: str = "View Resume") -> Column:
    """``=HYPERLINK("url","label")`` with ``"`` doubled; blank -> ''."""
    u = F.coalesce(_c(url), F.lit(""))
    safe_label = label.replace('"', '""')
    return F.when(u == "", F.lit("")).otherwise(
        F.concat(F.lit('=HYPERLINK("'), F.replace(u, F.lit('"'), F.lit('""')),
                 F.lit(f'","{safe_label}")')))


def extract_employer(body: ColumnOrName, default: str = "Unknown_Employer") -> Column:
    """Text between ``application to`` and the next ``through`` on the
    same line, stripped; no match or blank gives ``default``.
    (Python's ``.`` stops only at ``\\n``, hence ``[^\\n]``.)"""
    got = F.regexp_extract(_c(body), r"application to ([^\n]*?) through", 1)
    return F.coalesce(F.nullif(trim_u(got), F.lit("")), F.lit(default))


def composite_key(*parts: Column, sep: str = "|") -> Column:
    """Parts joined by ``sep`` (NULL if any part is NULL)."""
    out: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(p)
    return F.concat(*out)


def normalize_status(x: ColumnOrName) -> Column:
    """``current`` -> ``Current``; ``no mentor`` or
    ``current - no mentor`` (any spacing) -> ``No Mentor``; else the
    stripped original. NULL stays NULL."""
    s = trim_u(_c(x))
    low = collapse_ws(F.lower(s))
    return (F.when(low == "current", F.lit("Current"))
            .when((low == "no mentor") | low.rlike(r"(?U)^current\s*-\s*no mentor$"), F.lit("No Mentor"))
            .otherwise(s))


def translate(x: ColumnOrName, exact: Sequence[tuple[str, str]],
              contains_rules: Sequence[tuple[Sequence[str], str]] = ()) -> Column:
    """J5/J6/JN7: value translation with precedence.

    The stripped value is compared case-insensitively with ``exact``
    (pairs in order), then tested against ``contains_rules`` in order
    (any listed substring of the lower-cased value wins); otherwise the
    stripped original is returned. NULL stays NULL.
    """
    s = trim_u(_c(x))
    low = F.lower(s)
    expr = None
    for key, out in exact:
        cond = low == key.lower()
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    for needles, out in contains_rules:
        cond = None
        for n in needles:
            c = low.contains(n.lower())
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return s if expr is None else expr.otherwise(s)


# Vertical (technical area) translation, exact matches first,
# then substring rules in this order.
VERTICAL_EXACT = [
    ("system-on-chip (soc)", "SoC"),
    ("csme (graduate students only)", "SoC"),
    ("radiation hardening (rh)", "RH"),
    ("embedded security systems/trusted ai (ess/tai)", "TAI"),
    ("heterogeneous integration and advanced packaging (hi/ap)", "HI/AP"),
]
VERTICAL_CONTAINS = [
    (("soc", "system-on-chip", "csme"), "SoC"),
    (("rh", "radiation hardening"), "RH"),
    (("tai", "ess/tai", "trusted ai"), "TAI"),
    (("hi/ap", "heterogeneous integration"), "HI/AP"),
]

# Gender translation (exact, case-insensitive).
GENDER_EXACT = [("man", "Male"), ("woman", "Female"), ("male", "Male"), ("female", "Female")]


def translate_vertical(x: ColumnOrName) -> Column:
    """Technical-area label to its import code."""
    return translate(x, VERTICAL_EXACT, VERTICAL_CONTAINS)


def translate_gender(x: ColumnOrName) -> Column:
    """Gender label to the import vocabulary."""
    return translate(x, GENDER_EXACT)


# yes/no vocabularies of the citizen flag (compared lower-cased, not stripped).
YES_WORDS = ("yes", "y", "1", "true")
NO_WORDS = ("no", "n", "0", "false")


def yes_no_flag(x: ColumnOrName) -> Column:
    """Yes-words -> 1, no-words -> 0, anything else (and NULL) -> NULL.
    The text is lower-cased but deliberately not stripped."""
    low = F.lower(_c(x))
    return (F.when(low.isin(*YES_WORDS), F.lit(1))
            .when(low.isin(*NO_WORDS), F.lit(0))
            .otherwise(F.lit(None).cast("int")))
