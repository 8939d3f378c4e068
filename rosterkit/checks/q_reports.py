"""Check queries for the employer-report job and its as-of lookups."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import discard, ensure_checkpoint_dir, materialize, shuffles_for
from . import inputs as I
from . import sqlx as X
from .catalog import cte, derive, query, views


def _sized(spark: SparkSession, sf: str):
    """Shuffles for the report job over ``lineitem``: a row for each."""
    views(spark, sf, "lineitem")
    return shuffles_for(spark, spark.table("lineitem").count())


_PASS_ROWS = 60_000_000
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
                 "l_linestatus", "p_name", "p_size", "p_type")


def _report_base(spark: SparkSession, sf: str, name: str, more: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The rows of ``I.REPORT_BASE``, written; ``more`` is applied to all of
    an order's rows together. Over many rows Spark would shuffle each line
    for every large table in one plan, wider each time, and hold all of
    these shuffles at once. There the orders get their nations first, and
    lines meet parts, then orders, in passes of about ``_PASS_ROWS`` by key:
    disk holds the written rows and the shuffles of one pass. What the
    second passes read lies in files of their own."""
    views(spark, sf, *I.REPORT_TABLES)
    lines = spark.table("lineitem")
    passes = -(-lines.count() // _PASS_ROWS)
    if passes <= 1:
        return materialize(more(derive(spark, sf, I.REPORT_BASE, I.REPORT_TABLES)), name)
    turn = lambda key: F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(passes)).cast("int")
    share = lambda df, key, i: df.where(turn(key) == i)
    every = functools.partial(functools.reduce, DataFrame.unionByName)
    orders = materialize(spark.sql("""SELECT o_orderkey, o_orderdate, n_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""), f"{name}_orders")
    parts = spark.table("part")
    wide = every([materialize(share(lines, "l_partkey", i).join(share(parts, "p_partkey", i), F.col("l_partkey") == F.col("p_partkey"))
                              .select(*_LINE_COLUMNS, turn("l_orderkey").alias("_pass")), f"{name}_lines", ("_pass",)) for i in range(passes)])
    columns, _, _ = I.REPORT_BASE.partition("FROM lineitem ")
    made = []
    for i in range(passes):
        wide.where(F.col("_pass") == i).join(share(orders, "o_orderkey", i), F.col("l_orderkey") == F.col("o_orderkey")).createOrReplaceTempView("report_lines")
        made.append(materialize(more(spark.sql(f"{columns} FROM report_lines")), name))
    discard(wide)
    discard(orders)
    return every(made)


def _report_frames(spark: SparkSession, sf: str):
    from ..functions.text import extract_employer, file_extension
    from ..plans.reports import pack_rows
    # The job reads decoded rows from a written table; the derived
    # stand-in (with the per-file upload-date fill the decoder does) is
    # built once and written the same way.
    ensure_checkpoint_dir(spark)
    # The decoder fills the upload date per file; here a second window over
    # the derivation's own partitioning (by order = message) does it, so no
    # further exchange is needed.
    u = F.when(F.trim("uploaded") != "", F.col("uploaded"))
    w = Window.partitionBy("l_orderkey").orderBy("_ordinal") \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = _report_base(spark, sf, "report_base", lambda df: df.withColumn("uploaded", F.coalesce(u, F.first(u, ignorenulls=True).over(w))))
    base.createOrReplaceTempView("report_base")
    rows = spark.sql(I.REPORT_ROWS_FROM.format(base="report_base")).withColumnsRenamed(I.REPORT_HEADERS)
    rows = pack_rows(rows.withColumn("employer", extract_employer("body")), tuple(I.REPORT_HEADERS.values()))
    atts = spark.sql(I.REPORT_ATTS_FROM.format(base="report_base"))
    return rows, atts.withColumn("ext", file_extension("att_name"))


def _events(rows: DataFrame, atts: DataFrame, params) -> DataFrame:
    """Link events of stored rows, written; then the derived base, which
    only attachments were still read from, goes."""
    from ..plans.reports import resume_events
    events = materialize(resume_events(rows, atts, params)[0], "events")
    discard(rows.sparkSession.table("report_base"))
    return events


def _wide(reports: DataFrame) -> DataFrame:
    """The check inputs give every employer the same columns."""
    cell = lambda h: F.col("cells")[h.lower()].alias(h)
    return reports.select("Date of Confirmed Application", cell("First Name"), cell("Last Name"), cell("Email"),
                          cell("Date Database Uploaded"), cell("Major"), "Resume Link", "employer", "report_name")


def _report_params():
    from ..plans.reports import ReportParams
    return ReportParams(resume_file_base_url=I.REPORT_FILE_BASE)


def _pkey(first: str, last: str, email: str) -> str:
    e = f"nullif(trim(lower(coalesce({email}, ''))), '')"
    n = (f"nullif(lower(trim(trim(coalesce({first}, '')) || ' ' || trim(coalesce({last}, '')))), '')")
    return f"coalesce('email:' || {e}, 'name:' || {n})"


def _nb(x: str) -> str:
    return f"nullif(trim({x}), '')"


def _safe(x: str, default: str) -> str:
    s = (f"regexp_replace(trim(regexp_replace(regexp_replace({x}, '[<>:\"/\\\\|?*]', '_', 'g'), "
         f"'\\s+', ' ', 'g')), '\\.+$', '')")
    return f"coalesce(nullif({s}, ''), {X.lit(default)})"


def _as_of(rows: str, key: str, events: str, by: str, ordinal: str = "_ordinal", at: str = "2147483647") -> str:
    """(message_id, att_pos, _ordinal, url) of ``rows``: the url of the latest
    event of the same key whose (received, message, place) is not after the
    row's: one sorted pass over rows and events together."""
    return f"""
  SELECT message_id, att_pos, _ordinal, url FROM (
    SELECT message_id, att_pos, _ordinal, side,
           last_value(url IGNORE NULLS) OVER (PARTITION BY key ORDER BY received, message_id, place, side
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS url
    FROM (SELECT {by} AS key, received, message_id, CAST(att_pos AS BIGINT) AS place, 0 AS side, url, NULL AS att_pos, NULL AS _ordinal FROM {events}
          UNION ALL
          SELECT {key}, received, message_id, CAST({at} AS BIGINT), 1, NULL, att_pos, {ordinal} FROM {rows} WHERE {key} IS NOT NULL))
  WHERE side = 1"""


def _report_cte_text() -> str:
    full = (f"regexp_replace(trim(coalesce(first, '')) || '_' || trim(coalesce(last, '')), '^_+|_+$', '', 'g')")
    fname = (f"replace({_safe(f'nullif({full}, chr(39) || chr(39))', 'Unknown_Student')}, ' ', '_') "
             f"|| '_Resume' || coalesce(nullif(lower(ext), ''), '.pdf')")
    url = f"'{I.REPORT_FILE_BASE}/' || url_encode({fname}) || '?web=1'"
    return cte(rows0=I.REPORT_ROWS, atts0=I.REPORT_ATTS) + f""",
rows AS MATERIALIZED (
  SELECT message_id, att_pos, _ordinal, received,
         coalesce(nullif(trim(regexp_extract(body, 'application to ([^\\n]*?) through', 1)), ''),
                  'Unknown_Employer') AS employer,
         first_name, last_name, email, resume_file_name,
         coalesce(CASE WHEN trim(uploaded) = '' THEN NULL ELSE uploaded END,
                  first_value(CASE WHEN trim(uploaded) = '' THEN NULL ELSE uploaded END IGNORE NULLS)
                  OVER (PARTITION BY message_id, att_pos ORDER BY _ordinal
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS uploaded,
         major,
         {_pkey(_nb('first_name'), _nb('last_name'), _nb('email'))} AS row_person,
         lower({_nb('resume_file_name')}) AS nk
  FROM rows0),
atts AS MATERIALIZED (
  SELECT *, lower(regexp_extract(regexp_extract(att_name, '([^/\\\\]*)$', 1), '^\\.*[^.].*(\\.[^.]*)$', 1)) AS ext
  FROM atts0),
names AS MATERIALIZED (
  SELECT message_id, att_pos AS data_pos, nk AS name_key, arg_max(row_person, _ordinal) AS person_key,
         arg_max(trim(coalesce(first_name, '')), _ordinal) AS first,
         arg_max(trim(coalesce(last_name, '')), _ordinal) AS last
  FROM rows WHERE nk IS NOT NULL AND row_person IS NOT NULL GROUP BY 1, 2, 3),
ev AS MATERIALIZED (
  SELECT a.message_id, a.att_pos, a.received, a.att_name, a.ext, n.data_pos, n.name_key, n.person_key, n.first, n.last,
         row_number() OVER (PARTITION BY n.person_key, a.received ORDER BY a.message_id, n.data_pos, a.att_pos) = 1 AS is_save
  FROM atts a JOIN names n ON n.message_id = a.message_id AND n.name_key = lower(trim(a.att_name))
  WHERE a.ext IN ('.pdf', '.doc', '.docx')),
saves AS MATERIALIZED (SELECT person_key, received, message_id, att_pos, {url} AS url FROM ev WHERE is_save),
bn AS (SELECT message_id, name_key, arg_max(person_key, struct_pack(d := data_pos, p := att_pos)) AS name_person FROM ev GROUP BY 1, 2),
r2 AS MATERIALIZED (SELECT rows.*, bn.name_person FROM rows LEFT JOIN bn ON bn.message_id = rows.message_id AND bn.name_key = rows.nk),
__BY_NAME__
by_person AS MATERIALIZED ({_as_of("r2", "row_person", "saves", "person_key")}),
linked AS MATERIALIZED (
  SELECT r2.*, CAST(received AS DATE) AS d, coalesce(bn1.url, bp.url, '') AS link
  FROM r2 LEFT JOIN by_name bn1
         ON bn1.message_id = r2.message_id AND bn1.att_pos = r2.att_pos AND bn1._ordinal = r2._ordinal
       LEFT JOIN by_person bp
         ON bp.message_id = r2.message_id AND bp.att_pos = r2.att_pos AND bp._ordinal = r2._ordinal
  WHERE coalesce({_nb('first_name')}, {_nb('last_name')}, {_nb('email')}) IS NOT NULL),
kept AS MATERIALIZED (
  SELECT * FROM linked WHERE nullif(lower(trim(email)), '') IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY employer, nullif(lower(trim(email)), '')
                             ORDER BY d DESC, received DESC, message_id DESC, att_pos DESC, _ordinal DESC) = 1
  UNION ALL SELECT * FROM linked WHERE nullif(lower(trim(email)), '') IS NULL)"""


def _report_cte(scope: str = "message") -> str:
    text = _report_cte_text()
    return text.replace("__BY_NAME__", _GLOBAL_BY_NAME if scope == "global" else _MESSAGE_BY_NAME)


_MESSAGE_BY_NAME = f"""by_name AS MATERIALIZED ({_as_of("r2", "name_person", "saves", "person_key")}),"""
_GLOBAL_BY_NAME = f"""evl AS MATERIALIZED (
  SELECT e.message_id, e.att_pos, e.received, e.name_key, l.url
  FROM ev e LEFT JOIN ({_as_of("ev", "person_key", "saves", "person_key", "data_pos", "att_pos")}) l
    ON l.message_id = e.message_id AND l.att_pos = e.att_pos AND l._ordinal = e.data_pos),
by_name AS MATERIALIZED ({_as_of("r2", "nk", "evl", "name_key")}),"""


_REPORT_SELECT = f"""
SELECT {X.mdy('d')} AS "Date of Confirmed Application", first_name AS "First Name",
       last_name AS "Last Name", email AS "Email", uploaded AS "Date Database Uploaded", major AS "Major",
       CASE WHEN link = '' THEN '' ELSE '=HYPERLINK("' || replace(link, '"', '""') || '","View Resume")' END
         AS "Resume Link",
       employer, {_safe('employer', 'Unknown_Employer')} || '_Student_Application_Report' AS report_name
FROM kept"""


@query("q_employer_report", _report_cte() + _REPORT_SELECT)
def q_employer_report(spark: SparkSession, sf: str) -> DataFrame:
    """M5: per-employer report rows (keep-latest per email, links, redaction)."""
    from ..plans.reports import employer_reports, stored_rows
    p = _report_params()
    with _sized(spark, sf):
        rows, atts = _report_frames(spark, sf)
        rows = stored_rows(rows)
        return _wide(employer_reports(rows, _events(rows, atts, p), p))


def _manifest_sql() -> str:
    full = "regexp_replace(trim(coalesce(first, '')) || '_' || trim(coalesce(last, '')), '^_+|_+$', '', 'g')"
    target = (f"replace({_safe(f'nullif({full}, chr(39) || chr(39))', 'Unknown_Student')}, ' ', '_') "
              f"|| '_Resume' || coalesce(nullif(lower(ext), ''), '.pdf')")
    url = f"'{I.REPORT_FILE_BASE}/' || url_encode({target}) || '?web=1'"
    return _report_cte() + f"""
SELECT person_key, received, message_id, CAST(att_pos AS INTEGER) AS att_pos, {target} AS target_name, {url} AS url
FROM ev WHERE is_save
QUALIFY row_number() OVER (PARTITION BY person_key ORDER BY received DESC, message_id DESC, att_pos DESC) = 1"""


@query("q_resume_manifest", _manifest_sql())
def q_resume_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Per person the latest saved résumé, its file name and link."""
    from ..plans.reports import resume_events, resume_manifest, stored_rows
    with _sized(spark, sf):
        rows, atts = _report_frames(spark, sf)
        rows = stored_rows(rows)
        events, _ = resume_events(rows, atts, _report_params())
        return materialize(resume_manifest(events).select("person_key", "received", "message_id", "att_pos",
                                                          "target_name", "url"), "manifest")


@query("q_report_counts", _report_cte() + """
SELECT metric, value FROM (
  SELECT 'messages_scanned' AS metric, CAST(count(DISTINCT message_id) AS BIGINT) AS value FROM rows
  UNION ALL SELECT 'messages_with_attachments', CAST(count(DISTINCT message_id) AS BIGINT) FROM rows
  UNION ALL SELECT 'data_attachments_found', CAST(count(DISTINCT message_id) AS BIGINT) FROM rows
  UNION ALL SELECT 'data_attachments_processed', CAST(count(DISTINCT message_id) AS BIGINT) FROM rows
  UNION ALL SELECT 'attachment_read_failures', CAST(0 AS BIGINT)
  UNION ALL SELECT 'employers_with_data', CAST(count(DISTINCT employer) AS BIGINT) FROM rows
  UNION ALL SELECT 'reports_exported', CAST(count(DISTINCT employer) AS BIGINT) FROM rows
  UNION ALL SELECT 'report_name_collisions', CAST(0 AS BIGINT)
  UNION ALL SELECT 'resume_links_available', CAST(count(DISTINCT name_key) AS BIGINT) FROM ev
  UNION ALL SELECT 'unique_resumes_saved', CAST(count(DISTINCT person_key) AS BIGINT) FROM ev
  UNION ALL SELECT 'resume_mappings_updated',
        CAST((SELECT count(*) FROM (SELECT DISTINCT person_key, received FROM ev) g) - count(DISTINCT person_key) AS BIGINT) FROM ev
  UNION ALL SELECT 'resume_mappings_reused', CAST(count_if(NOT is_save) AS BIGINT) FROM ev)""")
def q_report_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The diagnostics of a whole run."""
    from ..plans.reports import run_reports
    with _sized(spark, sf):
        return run_reports(_mailbox(spark, sf), _report_params()).diagnostics


@query("q_unmatched_names", _report_cte() + """
SELECT DISTINCT att_name FROM atts
WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.message_id = atts.message_id AND ev.att_pos = atts.att_pos)""")
def q_unmatched_names(spark: SparkSession, sf: str) -> DataFrame:
    """F7/T5 + A7: attachment names that no data file names."""
    from ..plans.reports import run_reports
    with _sized(spark, sf):
        return run_reports(_mailbox(spark, sf), _report_params()).unmatched_names


_ASOF_IN = """
SELECT event_id, ts, user_id, event_type, value FROM events"""


@query("q_asof_link", """
WITH r AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'),
     s AS (SELECT event_id AS signup_id, ts AS s_ts, user_id, value AS signup_value FROM events
           WHERE event_type = 'signup')
SELECT r.event_id, r.ts, r.user_id, r.value, s.signup_id, s.signup_value
FROM r ASOF LEFT JOIN s ON s.user_id = r.user_id
 AND struct_pack(t := r.ts, i := r.event_id) >= struct_pack(t := s.s_ts, i := s.signup_id)""")
def q_asof_link(spark: SparkSession, sf: str) -> DataFrame:
    """JN6: latest signup of the same user at or before each purchase."""
    from ..operators.asof import asof_join
    views(spark, sf, "events")
    e = spark.table("events")
    rows = e.where(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "value")
    ev = e.where(F.col("event_type") == "signup").select(
        "user_id", "ts", "event_id", F.col("event_id").alias("signup_id"),
        F.col("value").alias("signup_value"))
    return asof_join(rows, ev, ["user_id"], ["ts", "event_id"], ["signup_id", "signup_value"])


@query("q_asof_sliced", """
WITH r AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'),
     s AS (SELECT event_id AS signup_id, ts AS s_ts, user_id, value AS signup_value FROM events
           WHERE event_type = 'signup')
SELECT r.event_id, r.ts, r.user_id, r.value, s.signup_id, s.signup_value
FROM r ASOF LEFT JOIN s ON s.user_id = r.user_id
 AND struct_pack(t := r.ts, i := r.event_id) >= struct_pack(t := s.s_ts, i := s.signup_id)""")
def q_asof_sliced(spark: SparkSession, sf: str) -> DataFrame:
    """JN6, skew-safe form: the per-user sort is split by day and the value
    carried across days from a per-(user, day) table."""
    from ..operators.asof import asof_join
    views(spark, sf, "events")
    e = spark.table("events").withColumn("day", F.to_date("ts"))
    rows = e.where(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "value", "day")
    ev = e.where(F.col("event_type") == "signup").select(
        "user_id", "ts", "event_id", "day", F.col("event_id").alias("signup_id"),
        F.col("value").alias("signup_value"))
    return asof_join(rows, ev, ["user_id"], ["ts", "event_id"], ["signup_id", "signup_value"],
                     slice_by="day").drop("day")


@query("q_resume_lookup", """
SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_id, struct_pack(ts := ts, e := event_id)) AS event_id,
       arg_max(value, struct_pack(ts := ts, e := event_id)) AS value
FROM events GROUP BY 1, 2""")
def q_resume_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """JN5: per (user, day) the values of the last event (later overwrites)."""
    from ..operators.asof import last_wins_lookup
    views(spark, sf, "events")
    e = spark.table("events").withColumn("day", F.to_date("ts"))
    return last_wins_lookup(e, ["user_id", "day"], ["ts", "event_id"], ["event_id", "value"])


@query("q_resume_counts", _report_cte() + """
SELECT metric, value FROM (
  SELECT 'unique_resumes_saved' AS metric, CAST(count(DISTINCT person_key) AS BIGINT) AS value FROM ev
  UNION ALL SELECT 'resume_mappings_updated',
    CAST((SELECT count(*) FROM (SELECT DISTINCT person_key, received FROM ev) g) - count(DISTINCT person_key) AS BIGINT) FROM ev
  UNION ALL SELECT 'resume_mappings_reused',
    CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT person_key, received FROM ev) g) AS BIGINT) FROM ev)""")
def q_resume_counts(spark: SparkSession, sf: str) -> DataFrame:
    """saved = persons, updated = groups - persons, reused = events -
    groups, counted over the library's own link events."""
    from ..plans.reports import resume_events, stored_rows
    with _sized(spark, sf):
        rows, atts = _report_frames(spark, sf)
        rows = stored_rows(rows)
        ev = materialize(resume_events(rows, atts, _report_params())[0].select("person_key", "is_save"), "events")
    a = ev.agg(F.count_distinct("person_key").alias("p"), F.count_if("is_save").alias("g"), F.count(F.lit(1)).alias("n"))
    return a.select(F.inline(F.array(
        F.struct(F.lit("unique_resumes_saved").alias("metric"), F.col("p").cast("long").alias("value")),
        F.struct(F.lit("resume_mappings_updated").alias("metric"), (F.col("g") - F.col("p")).cast("long").alias("value")),
        F.struct(F.lit("resume_mappings_reused").alias("metric"), (F.col("n") - F.col("g")).cast("long").alias("value")),
    )))


def _mailbox(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with real workbook attachments, derived from the tables."""
    from .mailbox import build_messages_from_rows
    from ..session import materialize
    ensure_checkpoint_dir(spark)
    base = _report_base(spark, sf, "mailbox_base")
    base.createOrReplaceTempView("report_base")
    rows = spark.sql(I.REPORT_ROWS_FROM.format(base="report_base")).withColumnsRenamed(I.REPORT_HEADERS)
    msgs = rows.groupBy("message_id").agg(F.first("received").alias("received"), F.first("body").alias("body")) \
        .select("message_id", F.lit("Archive").alias("folder"), F.lit("alerts@example.org").alias("sender"),
                "received", "body")
    rows = rows.drop("att_pos", "received", "body")
    atts = spark.sql(I.REPORT_ATTS_FROM.format(base="report_base")) \
        .select("message_id", "att_pos", "att_name", F.encode(F.col("att_name"), "UTF-8").alias("content"))
    mailbox = materialize(build_messages_from_rows(rows, atts, msgs), "mailbox")
    discard(base)
    return mailbox


@query("q_mailbox_reports", _report_cte() + _REPORT_SELECT)
def q_mailbox_reports(spark: SparkSession, sf: str) -> DataFrame:
    """M5 end to end: messages carrying real .xlsx attachments built from
    the tables are decoded on the executors (A5-A8), unioned by header
    (C11) and reported."""
    from ..plans.reports import run_reports
    with _sized(spark, sf):
        return _wide(run_reports(_mailbox(spark, sf), _report_params()).reports)


@query("q_mailbox_stream", _report_cte() + _REPORT_SELECT)
def q_mailbox_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same reports from the incremental form: the messages folder is
    read as a stream, each micro-batch decoded into the store."""
    from ..plans.reports import MESSAGE_SCHEMA
    from ..session import shared_path
    from ..streaming import reports_from_store, start_decoding
    with _sized(spark, sf):
        mailbox = _mailbox(spark, sf)
        inbox = shared_path(spark, "inbox")
        mailbox.write.parquet(inbox)
        stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(inbox)
        store = shared_path(spark, "report_store")
        q = start_decoding(stream, store, shared_path(spark, "stream_ckpt"), _report_params())
        q.awaitTermination()
        return _wide(reports_from_store(spark, store, _report_params()).reports)


@query("q_employer_report_global", _report_cte("global") + _REPORT_SELECT)
def q_employer_report_global(spark: SparkSession, sf: str) -> DataFrame:
    """M5 with D7's global résumé-name scope: a name keeps the link its
    latest event gave it, from any message."""
    from ..plans.reports import ReportParams, employer_reports, stored_rows
    p = ReportParams(resume_file_base_url=I.REPORT_FILE_BASE, name_scope="global")
    with _sized(spark, sf):
        rows, atts = _report_frames(spark, sf)
        rows = stored_rows(rows)
        return _wide(employer_reports(rows, _events(rows, atts, p), p))


# --------------------------------------------------------------------------- headers that drift

_DRIFT_IN = """
SELECT o_orderkey AS k, 'm' || lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0') AS message_id, o_custkey % 40 AS emp,
       o_orderkey % 4 AS kind, o_orderdate AS received, 'Clerk' || (o_orderkey % 997) AS first,
       CASE o_orderkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN '' ELSE 'p' || (o_orderkey % 300) || '@x.org' END AS mail,
       CASE o_orderkey % 3 WHEN 0 THEN 'null' ELSE o_orderpriority END AS note
FROM orders"""
# Per kind of file: its headers, and which of the values stands under each.
_DRIFT_KINDS = (
    (("First Name", "Email", "Employer", "Note"), ("first", "mail", "note", "note")),
    (("First Name", "EMAIL", "note", "note"), ("first", "mail", "note", "first")),
    (("FIRST NAME", "", "message_id", "Received"), ("first", "note", "note", "note")),
    (("First Name", "Note", "Note", "Note.1"), ("first", "note", "first", "note")),
)
_DRIFT_KEYS = (("first name", "email", "employer", "note"), ("first name", "email", "note", "note.1"),
               ("first name", "unnamed: 1", "message_id", "received"), ("first name", "note", "note.1", "note.1.1"))


def _drift_oracle() -> str:
    cells = " ".join(f"WHEN kind = {i} THEN [" + ", ".join(f"{{'key': '{k}', 'value': {v}}}" for k, v in zip(keys, vals)) + "]"
                     for i, (keys, (_, vals)) in enumerate(zip(_DRIFT_KEYS, _DRIFT_KINDS)))
    return f"""
WITH src AS ({_DRIFT_IN}),
clean AS (SELECT k, emp + 10 * (CASE WHEN kind = 0 THEN 100 WHEN kind = 1 THEN 100 ELSE 300 END) AS emp, kind, received,
                 first, CASE WHEN mail IN ('N/A', '') THEN NULL ELSE mail END AS mail, CASE WHEN note = 'null' THEN NULL ELSE note END AS note, message_id FROM src),
dated AS (SELECT *, CAST(received AS DATE) AS d, 'Firm ' || emp AS employer, CASE {cells} END AS cells FROM clean),
kept AS (
  SELECT k, employer, d, cells FROM dated WHERE kind < 2 AND mail IS NULL
  UNION ALL SELECT k, employer, d, cells FROM dated WHERE kind < 2 AND mail IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY employer, mail ORDER BY d DESC, received DESC, message_id DESC) = 1
  UNION ALL SELECT min(k), employer, d, cells FROM dated WHERE kind >= 2 GROUP BY employer, d, cells)
SELECT employer, strftime(d, '%-m/%-d/%Y') AS day, c.key AS key, c.value AS value, count(*) AS n
FROM (SELECT employer, d, unnest(cells) AS c FROM kept) GROUP BY ALL"""


def _drift_mailbox(spark: SparkSession, sf: str) -> DataFrame:
    """One message per order; its workbook's headers drift by order key.
    Employers whose files have no email column are apart."""
    from . import mailbox
    mailbox.ship(spark)
    src = mailbox.spread(derive(spark, sf, _DRIFT_IN, ("orders",)), "k")
    kinds = _DRIFT_KINDS

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            books = []
            for r in pdf.itertuples(index=False):
                heads, vals = kinds[r.kind]
                books.append(mailbox.write_xlsx({"S": [list(heads), [getattr(r, v) for v in vals]]}))
            yield pdf[["message_id", "emp", "kind", "received"]].assign(content=books)

    made = src.withColumn("received", F.col("received").cast("timestamp")).mapInPandas(
        build, "message_id string, emp long, kind long, received timestamp, content binary")
    firm = F.col("emp") + 10 * F.when(F.col("kind") < 2, 100).otherwise(300)
    body = F.concat(F.lit("application to Firm "), firm.cast("string"), F.lit(" through us"))
    return materialize(made.select("message_id", F.lit("Archive").alias("folder"), F.lit("a@example.org").alias("sender"), "received", body.alias("body"),
                                   F.array(F.struct(F.lit("student_data.xlsx").alias("name"), "content")).alias("attachments")), "mailbox")


@query("q_header_drift", _drift_oracle())
def q_header_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Files with ``Email``/``EMAIL``, headers named like
    the job's own columns, repeated and blank headers, missing-value
    texts, employers with and without an email column; every cell of
    every report, counted."""
    from ..plans.reports import run_reports
    reports = run_reports(_drift_mailbox(spark, sf), _report_params()).reports
    cells = reports.select("employer", F.col("`Date of Confirmed Application`").alias("day"), F.explode("cells").alias("key", "value"))
    return cells.groupBy("employer", "day", "key", "value").agg(F.count("*").alias("n"))
