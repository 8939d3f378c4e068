"""Check queries for the building blocks: dedupe, group fill, scalar
functions and header resolution. Each reads whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqlx as X
from .catalog import cte, derive, query, views

# --------------------------------------------------------------------------- dedupe


@query("q_dedupe_first", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def q_dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """first order per customer in (date, key) order."""
    from ..operators.dedupe import keep_first
    views(spark, sf, "orders")
    o = spark.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_first(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


_LATEST_IN = """
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'c' || cast(o_custkey AS string) END AS k
FROM orders"""


@query("q_dedupe_latest", cte(src=_LATEST_IN) + """
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice, k FROM src WHERE k IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_orderstatus, k
                           ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderdate DESC, o_orderkey DESC) = 1
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice, k FROM src WHERE k IS NULL""")
def q_dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    """latest order per (status, customer) by date, then time, then
    key; rows without a key are all kept."""
    from ..operators.dedupe import keep_latest
    src = derive(spark, sf, _LATEST_IN, ("orders",))
    return keep_latest(src, F.col("k"),
                       [F.to_date("o_orderdate"), F.col("o_orderdate"), F.col("o_orderkey")],
                       partition=["o_orderstatus"], row_id=F.col("o_orderkey"))


@query("q_dedupe_latest_split", cte(src=_LATEST_IN) + """
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice, k FROM src WHERE k IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_orderstatus, k
                           ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderdate DESC, o_orderkey DESC) = 1
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice, k FROM src WHERE k IS NULL""")
def q_dedupe_latest_split(spark: SparkSession, sf: str) -> DataFrame:
    """F4/P12/X2 without a row id: blank keys bypass the window."""
    from ..operators.dedupe import keep_latest
    src = derive(spark, sf, _LATEST_IN, ("orders",))
    return keep_latest(src, F.col("k"),
                       [F.to_date("o_orderdate"), F.col("o_orderdate"), F.col("o_orderkey")],
                       partition=["o_orderstatus"])


@query("q_distinct_rows", """
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def q_distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    """exact duplicate rows removed."""
    from ..operators.dedupe import distinct_rows
    views(spark, sf, "orders")
    return distinct_rows(spark.table("orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


_FILL_IN = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       CASE WHEN l_partkey % 4 = 0 THEN cast(cast(l_shipdate AS date) AS string)
            WHEN l_partkey % 4 = 1 THEN '   ' ELSE NULL END AS uploaded
FROM lineitem"""
_FILL_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query("q_fill_first", cte(src=_FILL_IN) + f""",
v AS (SELECT *, CASE WHEN trim(uploaded) = '' THEN NULL ELSE uploaded END AS u FROM src)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       coalesce(u, first_value(u IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY {_FILL_ORDER}
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS uploaded
FROM v""")
def q_fill_first(spark: SparkSession, sf: str) -> DataFrame:
    """blank cells take the first non-blank value of their order."""
    from ..operators.dedupe import fill_from_first
    src = derive(spark, sf, _FILL_IN, ("lineitem",))
    return fill_from_first(src, "uploaded", ["l_orderkey"],
                           [F.col(c.strip()) for c in _FILL_ORDER.split(",")])


# --------------------------------------------------------------------------- dates

_TERM_IN = """
SELECT o_orderkey,
       CASE o_orderkey % 16
            WHEN 0 THEN 'Fall ' || cast(year(o_orderdate) AS string)
            WHEN 1 THEN 'FA ' || substr(cast(year(o_orderdate) AS string), 3, 2)
            WHEN 2 THEN substr(cast(year(o_orderdate) AS string), 3, 2) || ' Spring'
            WHEN 3 THEN 'Spring ' || chr(39) || substr(cast(year(o_orderdate) AS string), 3, 2)
            WHEN 4 THEN 'Fall-' || cast(year(o_orderdate) AS string)
            WHEN 5 THEN 'Su' || substr(cast(year(o_orderdate) AS string), 3, 2)
            WHEN 6 THEN 'junk'
            WHEN 7 THEN 'Summer ' || cast(year(o_orderdate) AS string) || '5'
            WHEN 8 THEN '1' || cast(year(o_orderdate) AS string) || ' Fall'
            WHEN 9 THEN 'Fall ' || cast(year(o_orderdate) AS string) || ' Spring ' || cast(year(o_orderdate) + 1 AS string)
            WHEN 10 THEN 'sp, ' || cast(year(o_orderdate) AS string)
            WHEN 11 THEN 'Fall ' || cast(year(o_orderdate) % 1000 AS string)
            WHEN 12 THEN cast(cast(o_orderdate AS date) AS string)
            WHEN 13 THEN 'SUMMER   ' || chr(39) || chr(39) || substr(cast(year(o_orderdate) AS string), 3, 2)
            WHEN 14 THEN 'spring' || cast(year(o_orderdate) AS string)
            ELSE NULL END AS txt
FROM orders"""


@query("q_term_dates", cte(src=_TERM_IN) + f"""
SELECT o_orderkey, txt, {X.term_date('txt', 'start', 'strict')} AS term_start,
       {X.term_date('txt', 'end', 'strict')} AS term_end FROM src""")
def q_term_dates(spark: SparkSession, sf: str) -> DataFrame:
    """L1: strict term grammar, start and end of term."""
    from ..functions.dates import term_to_date
    src = derive(spark, sf, _TERM_IN, ("orders",))
    return src.select("o_orderkey", "txt",
                      term_to_date("txt", "start", "strict").alias("term_start"),
                      term_to_date("txt", "end", "strict").alias("term_end"))


@query("q_term_dates_start", cte(src=_TERM_IN) + f"""
SELECT o_orderkey, {X.flexible_date('txt', 'start', 'strict')} AS start_date FROM src""")
def q_term_dates_start(spark: SparkSession, sf: str) -> DataFrame:
    """L2: term first, then a general date."""
    from ..functions.dates import flexible_date
    src = derive(spark, sf, _TERM_IN, ("orders",))
    return src.select("o_orderkey", flexible_date("txt", "start", "strict").alias("start_date"))


@query("q_grad_dates", cte(src=_TERM_IN) + f"""
SELECT o_orderkey, coalesce({X.term_date('txt', 'end', 'loose')}, try_cast(trim(txt) AS DATE)) AS grad
FROM src""")
def q_grad_dates(spark: SparkSession, sf: str) -> DataFrame:
    """L3: loose grammar (graduation dates)."""
    from ..functions.dates import graduation_date
    src = derive(spark, sf, _TERM_IN, ("orders",))
    return src.select("o_orderkey", graduation_date("txt").alias("grad"))


@query("q_date_formats", """
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS mmddyyyy, strftime(o_orderdate, '%B %Y') AS month_year,
       strftime(o_orderdate, '%-m/%-d/%Y') AS mdy, CAST(o_orderdate AS DATE) AS d FROM orders""")
def q_date_formats(spark: SparkSession, sf: str) -> DataFrame:
    """L6 L7 L8 L10."""
    from ..functions.dates import format_mdy, format_mmddyyyy, format_month_year
    views(spark, sf, "orders")
    o = spark.table("orders")
    return o.select("o_orderkey", format_mmddyyyy("o_orderdate").alias("mmddyyyy"),
                    format_month_year("o_orderdate").alias("month_year"),
                    format_mdy("o_orderdate").alias("mdy"), F.to_date("o_orderdate").alias("d"))


@query("q_years_between", f"""
SELECT o_custkey, {X.years_between('min(CAST(o_orderdate AS DATE))', 'max(CAST(o_orderdate AS DATE))')} AS years
FROM orders GROUP BY o_custkey""")
def q_years_between(spark: SparkSession, sf: str) -> DataFrame:
    """K7 between each customer's first and last order."""
    from ..functions.dates import years_between
    views(spark, sf, "orders")
    a = spark.table("orders").groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return a.select("o_custkey", years_between("a", "b").alias("years"))


# --------------------------------------------------------------------------- classification

_LABEL_IN = """
SELECT p_partkey,
       CASE p_partkey % 12
            WHEN 0 THEN 'System-on-Chip (SoC)' WHEN 1 THEN '  csme (graduate students only) '
            WHEN 2 THEN 'RADIATION HARDENING (RH)' WHEN 3 THEN 'Embedded Security Systems/Trusted AI (ESS/TAI)'
            WHEN 4 THEN 'Heterogeneous Integration and Advanced Packaging (HI/AP)'
            WHEN 5 THEN 'associate ' || p_name WHEN 6 THEN 'overhead ' || p_type
            WHEN 7 THEN 'trusted ai lab' WHEN 8 THEN 'HI/AP group' WHEN 9 THEN p_name
            WHEN 10 THEN '' ELSE NULL END AS vertical,
       CASE p_partkey % 7 WHEN 0 THEN 'Man' WHEN 1 THEN ' WOMAN ' WHEN 2 THEN 'male' WHEN 3 THEN 'Female'
            WHEN 4 THEN p_brand WHEN 5 THEN '' ELSE NULL END AS gender,
       CASE p_partkey % 9 WHEN 0 THEN 'Current' WHEN 1 THEN ' current ' WHEN 2 THEN 'No  Mentor'
            WHEN 3 THEN 'Current - No Mentor' WHEN 4 THEN 'current-no mentor' WHEN 5 THEN 'CURRENT   -   NO MENTOR'
            WHEN 6 THEN ' ' || p_type || ' ' WHEN 7 THEN '' ELSE NULL END AS status,
       CASE p_partkey % 11 WHEN 0 THEN 'Yes' WHEN 1 THEN 'y' WHEN 2 THEN '1' WHEN 3 THEN 'TRUE'
            WHEN 4 THEN 'No' WHEN 5 THEN 'n' WHEN 6 THEN '0' WHEN 7 THEN 'false' WHEN 8 THEN ' yes '
            WHEN 9 THEN '1.0' ELSE NULL END AS yes_no
FROM part"""


def _translate_sql(col: str, which: str) -> str:
    expr = X.vertical(col) if which == "vertical" else X.gender(col)
    return cte(src=_LABEL_IN) + f"\nSELECT p_partkey, {expr} AS {col} FROM src"


@query("q_vertical", _translate_sql("vertical", "vertical"))
def q_vertical(spark: SparkSession, sf: str) -> DataFrame:
    """J5/JN7: exact-then-substring translation."""
    from ..functions.text import translate_vertical
    src = derive(spark, sf, _LABEL_IN, ("part",))
    return src.select("p_partkey", translate_vertical("vertical").alias("vertical"))


@query("q_gender", _translate_sql("gender", "gender"))
def q_gender(spark: SparkSession, sf: str) -> DataFrame:
    """J6."""
    from ..functions.text import translate_gender
    src = derive(spark, sf, _LABEL_IN, ("part",))
    return src.select("p_partkey", translate_gender("gender").alias("gender"))


@query("q_status", cte(src=_LABEL_IN) + f"\nSELECT p_partkey, {X.status('status')} AS status FROM src")
def q_status(spark: SparkSession, sf: str) -> DataFrame:
    """J4."""
    from ..functions.text import normalize_status
    src = derive(spark, sf, _LABEL_IN, ("part",))
    return src.select("p_partkey", normalize_status("status").alias("status"))


@query("q_yes_no", cte(src=_LABEL_IN) + """
SELECT p_partkey, CAST(CASE WHEN lower(yes_no) IN ('yes', 'y', '1', 'true') THEN 1
                            WHEN lower(yes_no) IN ('no', 'n', '0', 'false') THEN 0 END AS INTEGER) AS flag
FROM src""")
def q_yes_no(spark: SparkSession, sf: str) -> DataFrame:
    """J19 (the value is not stripped)."""
    from ..functions.text import yes_no_flag
    src = derive(spark, sf, _LABEL_IN, ("part",))
    return src.select("p_partkey", yes_no_flag("yes_no").alias("flag"))


_DEGREE_IN = """
SELECT o_orderkey,
       CASE o_orderkey % 14
            WHEN 0 THEN 'MS' WHEN 1 THEN 'M.Sc.' WHEN 2 THEN 'Ph.D' WHEN 3 THEN 'Doctorate'
            WHEN 4 THEN 'Masters Graduate Student' WHEN 5 THEN 'BS' WHEN 6 THEN 'MBA' WHEN 7 THEN 'MEng'
            WHEN 8 THEN 'Systems Engineering BS' WHEN 9 THEN 'PhD Graduate Student'
            WHEN 10 THEN 'Fourth Year Undergraduate Student' WHEN 11 THEN ''
            WHEN 12 THEN o_orderpriority ELSE NULL END AS degree
FROM orders"""


def _degree_class_sql() -> str:
    m, d = X.masters("degree"), X.doctoral("degree")
    return cte(src=_DEGREE_IN) + f"""
SELECT o_orderkey, {X.graduate_degree('degree')} AS is_graduate, {m} AS is_masters,
       CASE WHEN {d} OR {m} THEN 'PHD' ELSE 'BS' END AS degree_code,
       CASE WHEN {m} THEN 2 ELSE 4 END AS years_prior
FROM src"""


@query("q_degree_class", _degree_class_sql())
def q_degree_class(spark: SparkSession, sf: str) -> DataFrame:
    """K3 K4 K5 K6."""
    from ..functions.classify import degree_code, is_graduate_degree, is_masters_degree, \
        program_years_prior
    src = derive(spark, sf, _DEGREE_IN, ("orders",))
    return src.select("o_orderkey", is_graduate_degree("degree").alias("is_graduate"),
                      is_masters_degree("degree").alias("is_masters"),
                      degree_code("degree").alias("degree_code"),
                      program_years_prior("degree").alias("years_prior"))


_FLAG_IN = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE l_partkey % 13
            WHEN 0 THEN '20' WHEN 1 THEN '20.0' WHEN 2 THEN cast(l_linenumber + 13 AS string) || '.5'
            WHEN 3 THEN ' 20 ' WHEN 4 THEN '2e1' WHEN 5 THEN '20D' WHEN 6 THEN 'yes' WHEN 7 THEN 'Y'
            WHEN 8 THEN 'true' WHEN 9 THEN '1' WHEN 10 THEN 'inf' WHEN 11 THEN cast(l_discount AS string)
            ELSE NULL END AS code,
       CASE l_suppkey % 9
            WHEN 0 THEN '1' WHEN 1 THEN '1.4' WHEN 2 THEN '1.5' WHEN 3 THEN '0.5' WHEN 4 THEN 'yes'
            WHEN 5 THEN 'no' WHEN 6 THEN '.9' WHEN 7 THEN '+1' ELSE NULL END AS work_flag
FROM lineitem"""


@query("q_code_flags", cte(src=_FLAG_IN) + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {X.coded_flag('code', 20, ('yes', 'y', 'true', '1', '20', '20.0'))} AS student_flag,
       {X.coded_flag('work_flag', 1, ('yes', 'y', 'true', '1'))} AS work_flag
FROM src""")
def q_code_flags(spark: SparkSession, sf: str) -> DataFrame:
    """K1 K2 with D3's numeric-text rules."""
    from ..functions.classify import student_defense_flag, work_defense_flag
    src = derive(spark, sf, _FLAG_IN, ("lineitem",))
    return src.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      student_defense_flag("code").alias("student_flag"),
                      work_defense_flag("work_flag").alias("work_flag"))


# --------------------------------------------------------------------------- strings

@query("q_clean_strings", """
SELECT doc_id,
       regexp_replace(lower(trim(text)), '[^a-z0-9]+', '', 'g') AS alnum,
       regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') AS name_norm,
       CASE WHEN regexp_matches(text, '^\\s*$') THEN NULL ELSE text END AS nonblank,
       coalesce(nullif(regexp_replace(trim(regexp_replace(
           regexp_replace(source || ' ' || lang || '?', '[<>:"/\\\\|?*]', '_', 'g'), '\\s+', ' ', 'g')),
           '\\.+$', ''), ''), 'Unknown_Employer') AS safe_name,
       upper(trim(coalesce(lang, ''))) AS lang_code
FROM documents""")
def q_clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    """J1 J3 J8 J14 J18 over whole documents."""
    from ..functions.text import alnum_key, blank_to_null, normalize_name, safe_filename, upper_code
    views(spark, sf, "documents")
    d = spark.table("documents")
    return d.select("doc_id", alnum_key("text").alias("alnum"), normalize_name("text").alias("name_norm"),
                    blank_to_null("text").alias("nonblank"),
                    safe_filename(F.concat_ws(" ", "source", F.concat("lang", F.lit("?"))))
                    .alias("safe_name"),
                    upper_code("lang").alias("lang_code"))


@query("q_truncate", """
SELECT doc_id, substr(trim(text), 1, 499) AS text_499, CAST(length(substr(trim(text), 1, 499)) AS INTEGER) AS n
FROM documents""")
def q_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """J7 on whole documents (characters, not bytes)."""
    from ..functions.text import truncate_text
    views(spark, sf, "documents")
    d = spark.table("documents").select("doc_id", truncate_text("text", 499).alias("text_499"))
    return d.withColumn("n", F.length("text_499"))


@query("q_url_parts", """
SELECT page_id, url,
       regexp_extract(url, '([^/\\\\]*)$', 1) AS base,
       lower(regexp_extract(regexp_extract(url, '([^/\\\\]*)$', 1), '^\\.*[^.].*(\\.[^.]*)$', 1)) AS ext
FROM pages""")
def q_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Base name and extension of a path."""
    from ..functions.text import file_basename, file_extension
    views(spark, sf, "pages")
    p = spark.table("pages")
    return p.select("page_id", "url", file_basename("url").alias("base"), file_extension("url").alias("ext"))


_EXTRACT_IN = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE l_partkey % 6
            WHEN 0 THEN 'Hello, a student sent an application to ' || s_name || ' through the portal.'
            WHEN 1 THEN 'application to   ' || s_name || '   through x, application to B through y'
            WHEN 2 THEN 'Your application to  through the site'
            WHEN 3 THEN 'application to ' || s_name || chr(10) || ' through'
            WHEN 4 THEN 'no employer here'
            ELSE 'Re: application to ' || s_name || ' (' || cast(s_nationkey AS string) || ') through us' END AS body
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


@query("q_employer_extract", cte(src=_EXTRACT_IN) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(nullif(trim(regexp_extract(body, 'application to ([^\\n]*?) through', 1)), ''),
                'Unknown_Employer') AS employer
FROM src""")
def q_employer_extract(spark: SparkSession, sf: str) -> DataFrame:
    """J13 + A6: employer named in each message body."""
    from ..functions.text import extract_employer
    src = derive(spark, sf, _EXTRACT_IN, ("lineitem", "supplier"))
    return src.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      extract_employer("body").alias("employer"))


# --------------------------------------------------------------------------- schema resolution

@query("q_schema_resolve", """
SELECT c_custkey AS _ordinal, c_name AS email, c_mktsegment AS firstName, CAST(NULL AS VARCHAR) AS lastName,
       CAST(c_acctbal AS VARCHAR) AS studentScaleSemester, CAST(c_nationkey AS VARCHAR) AS defenseExperienceRaw
FROM customer""")
def q_schema_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Headers found by exact key, substring and Excel letter."""
    from ..operators.schema import FieldSpec, standardize
    from ..plans.scorecard import STUDENT_SPEC
    views(spark, sf, "customer")
    c = spark.table("customer")
    # 30 columns so that the fallback letter AD (index 29) exists.
    cols = [F.col("c_custkey").alias("_ordinal"), F.col("c_name").alias(" E-MAIL "),
            F.col("c_mktsegment").alias("First_Name"),
            F.col("c_nationkey").cast("string").alias("Defense Experience?")]
    cols += [F.lit(None).cast("string").alias(f"pad{i}") for i in range(25)]
    cols += [F.col("c_acctbal").cast("string").alias("Term Of Entry")]
    wide = c.select(*cols)
    spec = list(STUDENT_SPEC)
    assert isinstance(spec[0], FieldSpec)
    return standardize(wide, spec, keep=["_ordinal"])


# Written in every shape from one date, so that the oracle needs no parser.
_DATE_TEXT_IN = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 13 AS shape, {shapes} AS text FROM orders"""
_DATE_SHAPES_SPARK = """CASE o_orderkey % 13
  WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'M/d/yyyy')
  WHEN 2 THEN date_format(o_orderdate, 'MM-dd-yyyy') WHEN 3 THEN date_format(o_orderdate, 'd-MMM-yyyy')
  WHEN 4 THEN date_format(o_orderdate, 'M/d/yyyy') || ' 0:00' WHEN 5 THEN date_format(o_orderdate, 'MMMM d yyyy')
  WHEN 6 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 7 THEN date_format(o_orderdate, 'M/d/yy')
  WHEN 8 THEN '  ' || date_format(o_orderdate, 'yyyy/M/d') || ' 13:05:09 ' WHEN 9 THEN date_format(o_orderdate, 'MMM d, yyyy')
  WHEN 10 THEN '13/13/2024' WHEN 11 THEN 'soon' ELSE NULL END"""


@query("q_date_text", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 < 10 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def q_date_text(spark: SparkSession, sf: str) -> DataFrame:
    """The common shapes of date text, from known dates."""
    from ..functions.dates import parse_date_text
    src = derive(spark, sf, _DATE_TEXT_IN.format(shapes=_DATE_SHAPES_SPARK), ("orders",))
    return src.select("o_orderkey", parse_date_text("text").alias("day"))


_DATE_WORDS_SPARK = """CASE o_orderkey % 12
  WHEN 0 THEN replace(date_format(o_orderdate, 'MMM d, yyyy'), 'Sep', 'Sept') WHEN 1 THEN date_format(o_orderdate, 'MM.dd.yyyy')
  WHEN 2 THEN date_format(o_orderdate, 'MMM-yyyy') WHEN 3 THEN date_format(o_orderdate, 'MMM. d, yyyy')
  WHEN 4 THEN date_format(o_orderdate, 'E, d MMM yyyy') WHEN 5 THEN date_format(o_orderdate, 'EEEE MMMM d yyyy')
  WHEN 6 THEN date_format(o_orderdate, 'yyyy.MM.dd') WHEN 7 THEN date_format(o_orderdate, 'MMMM-yyyy')
  WHEN 8 THEN regexp_replace(date_format(o_orderdate, 'MMMM d, yyyy'), ',', 'th,') WHEN 9 THEN date_format(o_orderdate, 'M.d.yy')
  WHEN 10 THEN upper(date_format(o_orderdate, 'MMM, yyyy')) ELSE date_format(o_orderdate, 'd.M.yyyy') || ' or so' END"""


@query("q_date_words", """
SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 11 THEN NULL WHEN o_orderkey % 12 IN (2, 7, 10) THEN date_trunc('month', o_orderdate)::DATE
                        ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def q_date_words(spark: SparkSession, sf: str) -> DataFrame:
    """Month names in other spellings, dotted dates, weekdays, months alone."""
    from ..functions.dates import parse_date_text
    src = derive(spark, sf, _DATE_TEXT_IN.format(shapes=_DATE_WORDS_SPARK), ("orders",))
    return src.select("o_orderkey", parse_date_text("text").alias("day"))
