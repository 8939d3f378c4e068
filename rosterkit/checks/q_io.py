"""Check queries for links, sinks and workbook sources. Writes go to a
fresh folder under the shared checkpoint folder and are read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqlx as X
from .catalog import query, views

FILE_BASE = "https://files.example.org/r/"
SHARE_BASE = "https://share.example.org/:f:/s/team/Abc123"
FOLDER_BASE = "https://example.org/resumes/"
LOCAL_DIR = "/srv/Student Resumes"

_LINK_IN = """
SELECT c_custkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '  ' || split_part(c_name, '#', 1) || ' ' END AS first,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment || ' ' || split_part(c_name, '#', 2) END AS last,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_name) || '@Example.org ' END AS email,
       CASE c_custkey % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '' ELSE '.doc' END AS ext
FROM customer"""


def _links_sql() -> str:
    full = "regexp_replace(trim(coalesce(first, '')) || '_' || trim(coalesce(last, '')), '^_+|_+$', '', 'g')"
    safe = (f"coalesce(nullif(regexp_replace(trim(regexp_replace(regexp_replace(coalesce(nullif({full}, ''), "
            f"'Unknown_Student'), '[<>:\"/\\\\|?*]', '_', 'g'), '\\s+', ' ', 'g')), '\\.+$', ''), ''), "
            f"'Unknown_Employer')")
    target = f"replace({safe}, ' ', '_') || '_Resume' || coalesce(nullif(lower(ext), ''), '.pdf')"
    e = "nullif(trim(lower(coalesce(email, ''))), '')"
    n = "nullif(lower(trim(trim(coalesce(first, '')) || ' ' || trim(coalesce(last, '')))), '')"
    return f"""WITH src AS ({_LINK_IN}), t AS (SELECT *, {target} AS target FROM src)
SELECT c_custkey, coalesce('email:' || {e}, 'name:' || {n}) AS person_key, target,
       {X.lit(FILE_BASE.rstrip('/') + '/')} || url_encode(target) || '?web=1' AS url_file,
       {X.lit(SHARE_BASE + '#file=')} || url_encode(target) AS url_share,
       {X.lit(FOLDER_BASE.rstrip('/') + '/')} || url_encode(target) AS url_folder,
       {X.lit('file:///' + LOCAL_DIR + '/')} || target AS url_local,
       '=HYPERLINK("' || replace({X.lit(FILE_BASE.rstrip('/') + '/')} || url_encode(target) || '?web=1', '"', '""')
         || '","View Resume")' AS link
FROM t"""


@query("q_links", _links_sql())
def q_links(spark: SparkSession, sf: str) -> DataFrame:
    """J9 J10 J11 (all four URL branches) J12."""
    from ..functions.text import hyperlink_formula, person_key, resume_filename, resume_url
    from .catalog import derive
    src = derive(spark, sf, _LINK_IN, ("customer",))
    t = src.withColumn("target", resume_filename("first", "last", "ext"))
    tg = F.col("target")
    return t.select(
        "c_custkey", person_key("first", "last", "email").alias("person_key"), "target",
        resume_url(tg, file_base_url=FILE_BASE).alias("url_file"),
        resume_url(tg, folder_base_url=SHARE_BASE).alias("url_share"),
        resume_url(tg, folder_base_url=FOLDER_BASE).alias("url_folder"),
        resume_url(tg, local_dir=LOCAL_DIR).alias("url_local"),
        hyperlink_formula(resume_url(tg, file_base_url=FILE_BASE)).alias("link"),
    )


def _partition_sql() -> str:
    from .q_reports import _report_cte
    from .sqlx import mdy
    return _report_cte() + f"""
SELECT {mdy('d')} AS "Date of Confirmed Application", first_name AS "First Name",
       last_name AS "Last Name", email AS "Email", uploaded AS "Date Database Uploaded", major AS "Major",
       CASE WHEN link = '' THEN '' ELSE '=HYPERLINK("' || replace(link, '"', '""') || '","View Resume")' END
         AS "Resume Link",
       employer
FROM kept"""


def _multi_sql() -> str:
    from .catalog import _score_cte
    return _score_cte() + """
SELECT table_name, n_rows FROM (
  SELECT 'Candidates' AS table_name, CAST(count_if(meetsAllCriteria) AS BIGINT) AS n_rows FROM scored
  UNION ALL SELECT 'AllStudentsEvaluated', CAST(count(*) AS BIGINT) FROM scored
  UNION ALL SELECT 'Summary', CAST(5 AS BIGINT))"""


@query("q_partition_write", _partition_sql())
def q_partition_write(spark: SparkSession, sf: str) -> DataFrame:
    """All employer reports in ONE partitioned write, read back."""
    from ..session import shared_path
    from ..sources.sinks import write_reports
    from .q_reports import q_employer_report
    base = shared_path(spark, "employer_reports")
    write_reports(q_employer_report(spark, sf), base)
    return spark.read.option("basePath", base).parquet(base) \
        .withColumn("employer", F.col("employer").cast("string"))


@query("q_multi_write", _multi_sql())
def q_multi_write(spark: SparkSession, sf: str) -> DataFrame:
    """B1/B2: the scorecard's three tables written as one report set, read
    back and counted per table."""
    from ..plans.scorecard import ScorecardParams, candidates, score_summary, scorecard
    from ..session import materialize, shared_path
    from ..sources.sinks import write_tables
    from .catalog import _score_inputs
    p = ScorecardParams()
    scored = materialize(scorecard(*_score_inputs(spark, sf), p, keep_order=True), "scored")     # several tables read it
    tables = {"Candidates": candidates(scored, p), "AllStudentsEvaluated": scored.drop(p.order_column),
              "Summary": score_summary(scored, p)}
    base = shared_path(spark, "scorecard_report")
    write_tables(tables, base, require_rows="AllStudentsEvaluated")
    parts = [spark.read.parquet(f"{base}/{n}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in tables]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _multi_contents_sql() -> str:
    from .catalog import _SCORE_COLS, _score_cte
    return _score_cte() + f"""
SELECT {_SCORE_COLS}, meetsAllCriteria AS in_candidates, (SELECT CAST(count(*) AS DOUBLE) FROM scored) AS evaluated FROM scored"""


@query("q_multi_contents", _multi_contents_sql())
def q_multi_contents(spark: SparkSession, sf: str) -> DataFrame:
    """The report set written twice over the same place and read
    back: every row, whether it is among the candidates, one summary value."""
    from ..plans.scorecard import ScorecardParams, candidates, score_summary, scorecard
    from ..session import materialize, shared_path
    from ..sources.sinks import write_tables
    from .catalog import _score_inputs
    p = ScorecardParams()
    scored = materialize(scorecard(*_score_inputs(spark, sf), p, keep_order=True), "scored")     # several tables read it
    base = shared_path(spark, "scorecard_report")
    everyone = scored.drop(p.order_column)
    write_tables({"AllStudentsEvaluated": everyone.limit(3), "Candidates": candidates(scored, p)}, base)
    write_tables({"Candidates": candidates(scored, p), "AllStudentsEvaluated": everyone, "Summary": score_summary(scored, p)}, base)
    read = lambda n: spark.read.parquet(f"{base}/{n}")
    hits = read("Candidates").select("email", F.lit(True).alias("hit"))
    n = read("Summary").where("metric = 'students_evaluated'").first()["value"]
    return read("AllStudentsEvaluated").join(hits, "email", "left").select(
        *everyone.columns, F.coalesce("hit", F.lit(False)).alias("in_candidates"), F.lit(n).alias("evaluated"))


def customer_workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table as a table of workbook files (path, time, bytes),
    500 keys to a file, with two sheets and headers that drift from file
    to file. Later keys are in later files."""
    from ..session import materialize
    from . import mailbox
    views(spark, sf, "customer")
    c = spark.table("customer").withColumn("book", F.expr("c_custkey div 500"))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        book = int(key[0])
        pdf = pdf.sort_values("c_custkey")
        head = ["Cust Key", ("Name", "NAME", "name")[book % 3], "Nation" if book % 2 else "NATION ", "Balance", "Segment"]
        data = [head] + [[int(r.c_custkey), r.c_name, int(r.c_nationkey), float(r.c_acctbal), r.c_mktsegment]
                         for r in pdf.itertuples(index=False)]
        content = mailbox.write_xlsx({"Notes": [["x"]], "Students Export": data})
        return pd.DataFrame({"path": [f"Student_Export_{book:06d}.xlsx"],
                             "modificationTime": [pd.Timestamp("2024-01-01") + pd.Timedelta(hours=book)], "content": [content]})

    mailbox.ship(spark)
    files = c.groupBy("book").applyInPandas(build, "path string, modificationTime timestamp, content binary")
    return materialize(files, "workbooks")


_CUSTOMER_CELLS = '''CAST(c_custkey AS VARCHAR) AS "Cust Key", c_name AS "Name",
       CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR)
            ELSE CAST(c_acctbal AS VARCHAR) END AS "Balance",
       c_mktsegment AS "Segment" '''


@query("q_workbook_scan", f"""
SELECT {_CUSTOMER_CELLS}, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def q_workbook_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks made from the customer table, read
    by sheet name candidates, headers that drift unioned by name."""
    from ..sources.workbook import read_workbooks
    wide = read_workbooks(spark, customer_workbooks(spark, sf), candidates=["students", "student"], glob="Student_Export*.xlsx")
    nation = [F.col(f"`{c}`") for c in wide.columns if c.strip().lower() == "nation"]
    return wide.select("Cust Key", "Name", "Balance", "Segment", F.coalesce(*nation).alias("nation"))


@query("q_latest_snapshot", f"""
SELECT {_CUSTOMER_CELLS} FROM customer WHERE c_custkey // 500 = (SELECT max(c_custkey // 500) FROM customer)""")
def q_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A3/A4/T4: the newest matching workbook, read by sheet name."""
    from ..sources.workbook import load_system_export
    df = load_system_export(spark, folder=customer_workbooks(spark, sf), pattern="Student_Export*.xlsx", sheet="Students Export")
    return df.select("Cust Key", "Name", "Balance", "Segment")


def _import_set_sql() -> str:
    from .catalog import _RECON_CTE
    return _RECON_CTE + """
SELECT table_name, n_rows FROM (
  SELECT 'Users' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM new_rows
  UNION ALL SELECT 'WorkExperience', CAST(0 AS BIGINT)
  UNION ALL SELECT 'Degrees', CAST(count(*) AS BIGINT) FROM new_rows WHERE email IS NOT NULL AND email <> ''
  UNION ALL SELECT 'Mentoring', CAST(0 AS BIGINT))"""


@query("q_import_set", _import_set_sql())
def q_import_set(spark: SparkSession, sf: str) -> DataFrame:
    """B2 + A9: the four import tables (two are header-only templates)
    written as one set, read back and counted per table."""
    from ..plans.reconcile import reconcile, write_import_set
    from ..session import shared_path
    from .catalog import _recon_inputs, _recon_params
    p = _recon_params()
    base = shared_path(spark, "import_set")
    write_import_set(spark, reconcile(*_recon_inputs(spark, sf), p).new_rows, base, p)
    names = ("Users", "WorkExperience", "Degrees", "Mentoring")
    parts = [spark.read.parquet(f"{base}/{n}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _import_contents_sql() -> str:
    from .catalog import _template_sql
    return _template_sql()


@query("q_import_contents", _import_contents_sql())
def q_import_contents(spark: SparkSession, sf: str) -> DataFrame:
    """B2: the Users table of the written import set, every cell."""
    from ..plans.reconcile import reconcile, write_import_set
    from ..session import shared_path
    from .catalog import _recon_inputs, _recon_params
    p = _recon_params()
    base = shared_path(spark, "import_set")
    write_import_set(spark, reconcile(*_recon_inputs(spark, sf), p).new_rows, base, p)
    return spark.read.parquet(f"{base}/Users")


@query("q_sheet_resolve", f"""
SELECT {_CUSTOMER_CELLS}, k AS sheet_of FROM customer, (SELECT unnest(['people', 'export']) AS k)""")
def q_sheet_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Several tables of the same workbooks, each sheet picked
    by its candidates (contained either way) among 'Notes' and
    'Students Export'."""
    from ..sources.workbook import read_workbook_tables
    tables = read_workbook_tables(spark, customer_workbooks(spark, sf), {"people": ["students", "student"], "export": ["the students export list"]})
    parts = [df.select("Cust Key", "Name", "Balance", "Segment", F.lit(k).alias("sheet_of")) for k, df in tables.items()]
    return parts[0].unionByName(parts[1])
