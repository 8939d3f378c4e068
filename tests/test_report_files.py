"""Report files, unreadable files, observed counters, layouts of folders,
ranged as-of joins and places."""

import csv
import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from rosterkit.checks.mailbox import write_xlsx
from rosterkit.operators import asof as A
from rosterkit.operators import dedupe as D
from rosterkit.operators.schema import FieldSpec
from rosterkit.plans import reports as P
from rosterkit.sources import layouts as L
from rosterkit.sources import sinks
from rosterkit.sources.workbook import read_workbook_cells

NAME = "student_data.xlsx"


def _mail(spark, files):
    """files: (message, received day, employer, [(name, rows or bytes)])."""
    return spark.createDataFrame([
        (m, "Archive", "s", dt.datetime(2024, 1, d), f"application to {e} through", [(n, write_xlsx({"S": c}) if isinstance(c, list) else c) for n, c in atts])
        for m, d, e, atts in files], P.MESSAGE_SCHEMA)


def _files(base, employer):
    """The parsed files of one employer, by part."""
    out = []
    for path in sorted(glob.glob(f"{base}/employer={employer}/part=*/*.txt")):
        with open(path, newline="") as fh:
            out.append(list(csv.reader(fh)))
    return out


def test_every_report_file_has_its_own_header(spark, tmp_path):
    odd = 'say "hi", you\nthere'
    run = P.run_reports(_mail(spark, [
        ("m1", 1, "A/B", [(NAME, [["First Name", "Email", "Citizenship", "Note"], *[[f"n{i}", f"{i}@x", "yes", odd if i == 3 else None] for i in range(40)]])]),
        ("m2", 2, "C", [(NAME, [["Zip, code", "First Name", "Resume File Name"], ["9", "Di", "di.pdf"]]), ("di.pdf", b"1")]),
        ("m3", 3, "D", [(NAME, [["First Name", "Security  Clearance "], [None, "x"]])]),          # its only row has no identity
    ]), P.ReportParams(resume_file_base_url="https://f/r"))
    base = str(tmp_path / "out")
    P.write_report_files(run, base, rows_per_file=15)
    parts = _files(base, "A%2FB")
    assert len(parts) == 3 and all(p[0] == ["Date of Confirmed Application", "First Name", "Email", "Note"] for p in parts)
    rows = sorted(r for p in parts for r in p[1:])
    assert rows == sorted(["1/1/2024", f"n{i}", f"{i}@x", odd if i == 3 else ""] for i in range(40)) and all(len(p) > 4 for p in parts)
    assert _files(base, "C") == [[["Date of Confirmed Application", "Zip, code", "First Name", "Resume Link"],
                                  ["1/2/2024", "9", "Di", '=HYPERLINK("https://f/r/Di_Resume.pdf?web=1","View Resume")']]]
    assert _files(base, "D") == [[["Date of Confirmed Application", "First Name"]]]               # a report, though empty
    P.write_report_files(P.ReportRun(run.reports.where("employer = 'C'"), run.columns.where("employer = 'C'"), None, None, None), base)
    assert sorted(os.listdir(base))[-1] == "employer=C" and not _files(base, "D")                 # B4: stale reports go
    with pytest.raises(ValueError, match="maps"):
        sinks.write_reports(run.reports, str(tmp_path / "no"), fmt="csv")


def test_report_files_of_nothing(spark, tmp_path):
    run = P.run_reports(_mail(spark, [("m1", 1, "A", [("x.pdf", b"1")])]))
    P.write_report_files(run, str(tmp_path / "out"))
    assert not glob.glob(f"{tmp_path}/out/employer=*") and run.errors.collect() == []
    assert {r.metric: r.value for r in run.diagnostics.collect()}["messages_scanned"] == 1


def test_csv_line(spark):
    rows = [(["a", None, 'q"t', "x,y", "l\nm", "", "c\rd"],)]
    [r] = spark.createDataFrame(rows, "c array<string>").select(sinks.csv_line(F.col("c")).alias("l")).collect()
    assert next(csv.reader([r.l], strict=True))[:4] == ["a", "", 'q"t', "x,y"] and r.l.endswith('"l\nm",,"c\rd"')


def test_rows_and_failures_leave_one_write(spark):
    good = [["First Name"], ["Ann"]]
    run = P.run_reports(_mail(spark, [
        ("m1", 1, "A", [(NAME, good), (NAME, b"broken"), (NAME, b""), (NAME, None), (NAME, b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 99)]),
        ("m2", 2, "B", [("x.pdf", b"1"), (NAME, b"PK\x05\x06" + b"\0" * 18)]), ("m3", 3, "C", [])]))
    got = {(r.message_id, r.att_pos): (r.employer, r.reason) for r in run.errors.collect()}
    assert got[("m1", 1)] == ("A", "BadZipFile: File is not a zip file") and got[("m1", 2)] == got[("m1", 3)] == ("A", "empty file")
    assert got[("m1", 4)] == ("A", "old binary workbook format") and got[("m2", 1)][1].startswith("KeyError") and len(got) == 5
    diag = {r.metric: r.value for r in run.diagnostics.collect()}
    assert (diag["messages_scanned"], diag["messages_with_attachments"], diag["data_attachments_found"]) == (3, 2, 6)
    assert (diag["data_attachments_processed"], diag["attachment_read_failures"], diag["employers_with_data"]) == (1, 5, 1)
    plan = run.diagnostics._jdf.queryExecution().executedPlan().toString()
    assert "attachments#" not in plan                             # messages are counted while they are decoded, not again
    assert "PartitionFilters" in run.errors._jdf.queryExecution().executedPlan().toString()


def test_store_counts_a_message_once(spark, tmp_path):
    from rosterkit.streaming import reports_from_store, start_decoding
    msgs = _mail(spark, [("m1", 1, "A", [(NAME, [["First Name"], ["Ann"]])]), ("m2", 1, "A", [(NAME, b"no")])])
    inbox, store, ckpt = (str(tmp_path / n) for n in ("inbox", "store", "ckpt"))
    for df in (msgs.union(msgs), msgs):                           # twice in one batch, then again in a later one
        df.coalesce(1).write.mode("append").parquet(inbox)
        start_decoding(spark.readStream.schema(P.MESSAGE_SCHEMA).parquet(inbox), store, ckpt).awaitTermination()
    run = reports_from_store(spark, store)
    diag = {r.metric: r.value for r in run.diagnostics.collect()}
    assert (diag["messages_scanned"], diag["data_attachments_processed"], diag["attachment_read_failures"]) == (2, 1, 1)
    assert run.reports.count() == 1 and [r.message_id for r in run.errors.collect()] == ["m2"]


# ------------------------------------------------------------------ layouts

def _cells(spark, books):
    rows = [(f"/x/{n}", dt.datetime(2024, 1, 1), write_xlsx({"S": b}) if isinstance(b, list) else b) for n, b in books.items()]
    return read_workbook_cells(spark, spark.createDataFrame(rows, "path string, modificationTime timestamp, content binary"), glob="*")


def test_layouts_are_resolved_once_each(spark):
    books = {f"a{i}.xlsx": [["Email", "First Name"], [f"{i}@x", f"n{i}"]] for i in range(4)}
    books |= {"b.xlsx": [["FIRST-NAME", "x", "E-Mail address", "Email"], ["Bo", "1", "long", "bo@x"], ["Cy", None, None, None]],
              "c.xlsx": [["Name, first name", "Remark"], ["Di", "r"]], "d.xlsx": [["Email", "First Name"]], "bad.xlsx": b"no"}
    cells = _cells(spark, books).cache()
    found = {tuple(r.headers): (r.n_files, r.first_file) for r in L.layouts(cells).collect()}
    assert found[("Email", "First Name")] == (5, "/x/a0.xlsx") and len(found) == 3
    spec = [FieldSpec("mail", ("email",)), FieldSpec("first", ("first name",), required=True)]
    out = L.standardize_files(cells, ["mail", "first"], L.by_candidates(spec))
    assert sorted((r.first, r.mail) for r in out.collect()) == [("Bo", "bo@x"), ("Cy", None), ("Di", None), *[(f"n{i}", f"{i}@x") for i in range(4)]]
    assert out.columns == ["_file", "_sheet", "_ordinal", "mail", "first"]
    strict = L.by_candidates([FieldSpec("mail", ("email",), required=True)])
    with pytest.raises(ValueError, match=r"/x/c.xlsx \(and 0 more.*'mail' matches any of \['email'\]; the headers are \['Name, first name', 'Remark'\]"):
        L.standardize_files(cells, ["mail"], strict)
    assert [(r.n_files, r.first_file) for r in L.missing_fields(cells, strict).collect()] == [(1, "/x/c.xlsx")]
    assert L.standardize_files(cells, ["mail"], strict, on_missing="skip").count() == 6
    people = L.standardize_files(cells, ["first_name", "email"], L.by_patterns({"first_name": ("first",), "email": ("mail",)}))
    assert sorted(r.first_name for r in people.collect()) == ["Bo", "Cy", "Di", "n0", "n1", "n2", "n3"]
    letters = L.by_candidates([FieldSpec("second", ("nothing",), fallback_letter="B")])
    assert {r.second for r in L.standardize_files(cells, ["second"], letters).collect()} == {"n0", "n1", "n2", "n3", "1", None, "r"}
    assert L.standardize_files(cells.where("1 = 0"), ["mail"], strict).collect() == []


# ------------------------------------------------------------------ hot slices, places

def test_ranged_asof_equals_a_loop(spark):
    rng = random.Random(4)
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    key = lambda: rng.choice([None, "a", "b", *["hot"] * 12])
    events = [(key(), t(rng.randrange(300)), i, rng.choice([None, f"v{i}"])) for i in range(300)]
    rows = [(key(), t(rng.randrange(300)), rng.randrange(300), f"r{i}") for i in range(500)]
    want = []
    for k, ts, n, r in rows:
        past = [e for e in events if k is not None and e[0] == k and e[1:3] <= (ts, n)]
        want.append((r, max(past, key=lambda e: e[1:3])[3] if past else None))
    df = spark.createDataFrame(rows, "k string, ts timestamp, n int, r string").repartition(3)
    ev = spark.createDataFrame(events, "k string, ts timestamp, n int, v string").repartition(3)
    for parts in (1, 7, 200):
        got = A.asof_join_ranged(df, ev, ["k"], ["ts", "n"], ["v"], parts=parts, prefix="last_")
        assert got.columns == ["k", "ts", "n", "r", "last_v"]
        assert sorted((r.r, r.last_v) for r in got.collect()) == sorted(want)
    assert A.asof_join_ranged(df.limit(0), ev, ["k"], ["ts"], ["v"], parts=3).collect() == []
    assert [r.v for r in A.asof_join_ranged(df.limit(2), ev.limit(0), ["k"], ["ts"], ["v"], parts=3).collect()] == [None, None]


def test_ranged_asof_deals_a_hot_day_evenly(spark):
    """Nine tenths of the rows have one key and day: parts of like size."""
    base = spark.range(40_000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 7919 % 1000).alias("ts"), "id")
    written = []
    import rosterkit.session as S
    whole = S.materialize

    def keep(df, name, *a, **b):
        out = whole(df, name, *a, **b)
        written.append((name, out))
        return out

    try:
        S.materialize = keep
        A.asof_join_ranged(base.where("id % 3 > 0"), base.where("id % 3 = 0").withColumn("v", F.col("id")), ["k"], ["ts"], ["v"], parts=32).count()
    finally:
        S.materialize = whole
    [sizes] = [sorted(r["count"] for r in out.groupBy("__part").count().collect()) for name, out in written if name == "asof-placed"]
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_places_outlive_a_write(spark, tmp_path, parts):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, *range(20)]), rng.random()) for i in range(700)]
    df = spark.createDataFrame(rows, "i int, a int, b double").repartition(6)
    got = D.ranked(df, [F.col("a").desc_nulls_last(), F.col("b")], parts=parts)
    got.repartition(4, "b").write.parquet(str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p")).orderBy("place").collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
    assert [r.place for r in back] == list(range(1, 701)) and [r.i for r in back] == [r[0] for r in want]
    assert D.ranked(df.limit(0), [F.col("a")], parts=parts).collect() == []


# ------------------------------------------------------------------ stored keys, hot lists

def test_stored_keys_are_not_shuffled_again(spark, tmp_path):
    from rosterkit.operators import match as M
    keys = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 900).cast("string")).alias("key")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    stored = M.store_keys(keys, "kept_keys", 4, str(tmp_path / "keys"))
    rows = spark.range(1200).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = M.flag_membership(rows, F.col("r"), stored, "hit")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert {r.id for r in found.where("hit").collect()} == {i for i in range(900) if i % 7}
        assert stored.count() == 900 and found.count() == 1200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sql("DROP TABLE kept_keys")


def test_lists_of_a_hot_key_are_distinct_first(spark):
    from rosterkit.plans.scorecard import degrees_summary
    rows = [("a@x.org", t, "2024-05-01") for t in ("bs", "MS", " ms ", "PhD", None, "") for _ in range(50)] + [("b@x.org", None, None)]
    df = spark.createDataFrame(rows, "email string, degreeType string, graduationDate string")
    out = degrees_summary(df)
    assert "ObjectHashAggregate(keys=[_email_key#" in out._jdf.queryExecution().executedPlan().toString()
    got = {r._email_key: (r.totalDegrees, r.degreeTypes) for r in out.collect()}
    assert got["a@x.org"] == (300, "BS, MS, PHD") and got["b@x.org"] == (1, "")
    below = out._jdf.queryExecution().executedPlan().toString().split("ObjectHashAggregate")[-1]
    assert "HashAggregate(keys=[_email_key#" in below and "_type#" in below          # the lists are made of counted types
