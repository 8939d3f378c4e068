"""Work that must not repeat: batches per file, tables computed again."""

import datetime as dt

import pytest

from rosterkit.checks.mailbox import spread, write_xlsx

SF = "/root/testdata/sf0.001"


def test_rows_of_small_files_share_batches():
    import pyarrow as pa

    from rosterkit.sources import xlsx_rows
    books = [write_xlsx({"S": [["First Name", "Email"], [f"n{i}", "x"]]}) for i in range(300)] + [b"broken", None]
    n = len(books)
    batch = pa.RecordBatch.from_pydict({"message_id": [f"m{i}" for i in range(n)], "att_pos": [0] * n, "employer": [None] + ["e"] * (n - 1),
                                        "received": [dt.datetime(2024, 1, 1)] * n, "content": books})
    out = list(xlsx_rows.decode_batches([batch]))
    assert len(out) == 1
    rows = out[0].to_pylist()
    assert [r["_ordinal"] for r in rows] == [-1, 0] * 300 + [-1, -1] and rows[0]["employer"] is None
    assert rows[599]["message_id"] == "m299" and rows[599]["cells"] == [{"k": "First Name", "pos": 0, "v": "n299"}, {"k": "Email", "pos": 1, "v": "x"}]
    assert rows[600]["_error"].startswith("BadZipFile") and rows[601]["_error"] == "empty file"


def test_large_file_leaves_in_parts():
    import pyarrow as pa

    from rosterkit.sources import xlsx_rows
    book = write_xlsx({"S": [["a", "b"]] + [[i, "x"] for i in range(9000)]})
    out = list(xlsx_rows.decode_files([pa.RecordBatch.from_pydict({"path": ["p"], "content": [book]})]))
    assert len(out) == 3 and [r["_ordinal"] for b in out for r in b.to_pylist()] == list(range(-1, 9000))


def test_books_are_built_by_many_tasks(spark):
    assert spread(spark.range(10), "id").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread(spark.range(100), "id", rows=5).rdd.getNumPartitions() == 20


def test_drifting_mailbox_is_stored_once(spark):
    from rosterkit.checks import q_files, q_reports
    assert q_reports._drift_mailbox(spark, SF).inputFiles()[0].count("/mailbox-") == 1
    assert "MapInPandas" not in q_files._files_mailbox(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q_employer_report", "q_employer_report_global", "q_resume_manifest", "q_resume_counts", "q_partition_write"])
def test_report_shuffles_follow_the_rows(spark, monkeypatch, name):
    from rosterkit.checks import q_reports
    from rosterkit.checks.registry import QUERIES
    from rosterkit.session import materialize, shuffles_for
    seen, key = [], "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    monkeypatch.setattr(q_reports, "shuffles_for", lambda s, rows: shuffles_for(s, rows, rows // 40))
    monkeypatch.setattr(q_reports, "materialize", lambda *a: (seen.append(int(spark.conf.get(key))), materialize(*a))[1])
    QUERIES[name](spark, SF)
    assert len(seen) > 1 and min(seen) >= 40 and spark.conf.get(key) == before


def test_stored_rows_are_asked_without_their_cells(spark):
    """Filters and keys read plain columns: over unwritten rows each mention
    of a cell built the row's map again. Odd cells give the same rows."""
    from pyspark.sql import functions as F

    from rosterkit.plans import reports as P
    heads = ("First Name", "Last Name", "Email", "Resume File Name", "Note")
    cells = [("Ann", " B ", " A@X.org ", "a.PDF", "1"), (None, " ", "", "b.pdf", "2"), (" ", "Lee", None, " B.pdf", None),
             (None, None, "a@x.ORG", None, "3"), ("İda", "", "\t", "c.docx ", ""), ("Ann", "B", "A@x.org", "A.pdf", "4"), (None, None, None, " ", "5")]
    wide = spark.createDataFrame([(f"m{i % 2}", 0, i, dt.datetime(2024, 1, 1 + i % 2), "E") + c for i, c in enumerate(cells * 2)],
                                 "message_id string, att_pos int, _ordinal int, received timestamp, employer string, " + ", ".join(f"`{h}` string" for h in heads))
    rows = P.pack_rows(wide, heads)
    atts = spark.createDataFrame([(m, 100 + i, dt.datetime(2024, 1, 1 + int(m[1])), n, "." + n.strip().lower().split(".")[1])
                                  for m in ("m0", "m1") for i, n in enumerate(("A.pdf", "b.PDF", "C.docx", "x.pdf"))],
                                 "message_id string, att_pos int, received timestamp, att_name string, ext string")
    stored = P.stored_rows(rows)
    plan = P.resume_events(stored, atts)[0]._jdf.queryExecution().executedPlan().toString()
    assert "cells" not in plan and "map_from_arrays" not in plan
    got, want = (P.resume_events(r, atts)[0] for r in (stored, rows))
    assert want.count() > 4 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    people = [r._person for r in stored.orderBy("_ordinal").limit(7).collect()]
    assert people == ["email:a@x.org", None, "name:lee", "email:a@x.org", "name:" + "İda".lower(), "email:a@x.org", None]
    reports = [P.employer_reports(r, want).withColumn("cells", F.to_json("cells")).collect() for r in (stored, rows)]
    assert reports[0] and sorted(map(str, reports[0])) == sorted(map(str, reports[1]))


def test_books_of_messages_that_span_batches(spark):
    """Workbooks are built from Arrow batches; their bytes never pass an
    aggregate with the other attachments."""
    import pyarrow as pa

    from rosterkit.checks.mailbox import books_of, build_messages_from_rows
    from rosterkit.sources.xlsx_rows import Workbook
    batch = lambda ids, vals: pa.RecordBatch.from_pydict({"message_id": ids, "First Name": vals})
    out = list(books_of(["First Name"])([batch(["a", "a"], ["1", None]), batch(["a", "b"], ["3", "4"]), batch([], []), batch(["b"], ["5"]), batch(["c"], ["6"])]))
    got = {r["message_id"]: Workbook(r["content"]).rows() for b in out for r in b.to_pylist()}
    assert got == {"a": [["First Name"], ["1"], ["3"]], "b": [["First Name"], ["4"], ["5"]], "c": [["First Name"], ["6"]]}
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y")], "message_id string, _ordinal int, `First Name` string")
    atts = spark.createDataFrame([("a", 2, "q.pdf", b"2"), ("a", 1, "p.pdf", b"1"), ("b", 1, "r.pdf", b"3")], "message_id string, att_pos int, att_name string, content binary")
    msgs = spark.createDataFrame([(m, "f", "s", dt.datetime(2024, 1, 1), "t") for m in "abc"], "message_id string, folder string, sender string, received timestamp, body string")
    made = build_messages_from_rows(rows, atts, msgs)
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    found = {r.message_id: [(a.name, bytes(a.content)) for a in r.attachments] for r in made.collect()}
    assert Workbook(found["a"][0][1]).rows() == [["First Name"], ["y"], ["x"]]
    assert [n for n, _ in found["a"]] == ["student_data.xlsx", "p.pdf", "q.pdf"] and found["b"] == [("r.pdf", b"3")] and found["c"] == []


def test_parts_are_read_without_reader_objects(monkeypatch):
    import io
    import zipfile

    from rosterkit.sources.xlsx_rows import Workbook
    book = write_xlsx({"S": [["a", "b"], ["x", 1]]})
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        assert z.testzip() is None and len(z.namelist()) == 4
        at = z.getinfo("xl/worksheets/sheet1.xml")
    spoiled = bytearray(book)
    spoiled[at.header_offset + 14] ^= 1                                                           # in the header: not looked at
    spoiled[at.header_offset + 30 + len(at.filename) + at.compress_size // 2] ^= 255
    with pytest.raises(Exception) as old:
        zipfile.ZipFile(io.BytesIO(bytes(spoiled))).read(at.filename)
    with pytest.raises(type(old.value)) as new:
        Workbook(bytes(spoiled)).rows()
    assert str(new.value) == str(old.value)                                                       # what is wrong is told as before
    monkeypatch.setattr(zipfile.ZipFile, "open", None)
    assert Workbook(book).rows() == Workbook(b"before" + book).rows() == [["a", "b"], ["x", "1"]]


@pytest.mark.parametrize("name", ["q_mailbox_reports", "q_report_counts", "q_unmatched_names"])
def test_mailbox_shuffles_follow_the_rows(spark, monkeypatch, name):
    from rosterkit.checks import q_reports
    from rosterkit.checks.registry import QUERIES
    from rosterkit.session import materialize, shuffles_for
    seen, key = [], "spark.sql.shuffle.partitions"
    monkeypatch.setattr(q_reports, "shuffles_for", lambda s, rows: shuffles_for(s, rows, rows // 10))
    monkeypatch.setattr(q_reports, "materialize", lambda *a: (seen.append(int(spark.conf.get(key))), materialize(*a))[1])
    QUERIES[name](spark, SF)
    assert seen and min(seen) >= 10


def test_only_repeated_messages_are_sorted(spark, tmp_path):
    from pyspark.sql import functions as F

    from rosterkit.streaming import incremental as S
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)], "message_id string, v int")
    single, again = S._once(batch, batch.groupBy("message_id").count().where("count > 1"))
    assert sorted(r.v for r in single.collect()) == [1, 6]
    assert sorted((r.message_id or "", r.v in (2, 3, 4, 5)) for r in again.collect()) == [("", True), ("b", True)]
    rows = [(0, "a", 1), (0, "a", 2), (1, "a", 3), (1, "b", 4), (2, None, 5), (3, None, 6), (10, "b", 7), (2, "c", 8)]
    store = spark.createDataFrame(rows, "batch int, message_id string, v int")
    first = S.first_delivery(store)
    assert first.columns == ["message_id", "v"] and sorted(r.v for r in first.collect()) == [1, 2, 4, 5, 8]
    assert "Window" not in first._jdf.queryExecution().executedPlan().toString()
    assert S.first_delivery(store.where("batch = 0")).agg(F.count("*")).first()[0] == 2


def test_written_tables_leave_no_shuffles(spark):
    from rosterkit.session import materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in (disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size()))}
    before, was = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = materialize(spark.range(1000).repartition(5).groupBy("id").count(), "grouped")
    assert not [f for f in files() - before if f.startswith("shuffle_") and f.endswith(".data")]
    assert out.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was


def test_base_in_passes_has_the_rows_of_its_sql(spark, monkeypatch):
    from rosterkit.checks import inputs as I
    from rosterkit.checks import q_reports
    from rosterkit.checks.catalog import derive
    want = derive(spark, SF, I.REPORT_BASE, I.REPORT_TABLES)
    monkeypatch.setattr(q_reports, "_PASS_ROWS", -(-spark.table("lineitem").count() // 3))
    names = []
    real = q_reports.materialize
    monkeypatch.setattr(q_reports, "materialize", lambda df, name, *a: (names.append(name), real(df, name, *a))[1])
    got = q_reports._report_base(spark, SF, "base")
    assert names == ["base_orders"] + ["base_lines"] * 3 + ["base"] * 3
    assert got.dtypes == want.dtypes
    assert want.count() > 1000 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", ["q_employer_report", "q_report_files_links"])
def test_base_goes_when_the_events_are_written(spark, name):
    import os

    from rosterkit.checks.registry import QUERIES
    df = QUERIES[name](spark, SF)
    base = spark.table("report_base").inputFiles()
    assert base and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in base)
    assert df.count() > 0
