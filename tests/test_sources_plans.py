"""Workbook sources, sinks, plan shapes of every check query, and the
driver contract."""

import os
import time

import pytest

from rosterkit.sources import workbook as W
from rosterkit.sources.sinks import write_tables
from rosterkit.checks.mailbox import write_xlsx
from rosterkit.sources.xlsx_rows import Workbook, table

SF = "/root/testdata/sf0.001"


def test_xlsx_reader_types_and_headers():
    data = write_xlsx({"A": [["id", None, "id", "flag"], [1, "x", 2.5, True], [None, None, None, None],
                             [3, None, None, False, "extra"]]})
    wb = Workbook(data)
    assert wb.sheet_names == ["A"]
    headers, rows = table(wb.rows())
    assert headers == ["id", "Unnamed: 1", "id.1", "flag", "Unnamed: 4"]
    assert table([["a", "A", "a.1", "a"], ["1", "2", "3", "N/A"]]) == (["a", "A.1", "a.1.1", "a.2"], [["1", "2", "3", None]])
    assert rows == [["1", "x", "2.5", "True", None], ["3", None, None, "False", "extra"]]


def _write_books(folder):
    os.makedirs(folder, exist_ok=True)
    a = write_xlsx({"Intro": [["x"]], "Students": [["Email", "First Name"], ["a@x", "Ann"], ["b@x", "Bob"]]})
    b = write_xlsx({"student list": [["Email", "Last Name"], ["c@x", "Lee"]]})
    with open(os.path.join(folder, "Student_Export_1.xlsx"), "wb") as fh:
        fh.write(a)
    time.sleep(0.05)
    with open(os.path.join(folder, "Student_Export_2.xlsx"), "wb") as fh:
        fh.write(b)
    with open(os.path.join(folder, "other.xlsx"), "wb") as fh:
        fh.write(b"not a workbook")


def test_read_workbooks_union_and_latest(spark, tmp_path):
    folder = str(tmp_path / "books")
    _write_books(folder)
    wide = W.read_workbooks(spark, folder, candidates=["students", "student"], glob="Student_Export*.xlsx")
    assert wide.columns[:3] == ["_file", "_sheet", "_ordinal"]
    assert set(wide.columns[3:]) == {"Email", "First Name", "Last Name"}
    got = sorted((r.Email, r["First Name"], r["Last Name"]) for r in wide.collect())
    assert got == [("a@x", "Ann", None), ("b@x", "Bob", None), ("c@x", None, "Lee")]
    latest = W.latest_snapshot(spark, folder, "Student_Export*.xlsx")
    assert latest.endswith("Student_Export_2.xlsx")
    cells = W.read_workbook_cells(spark, folder, glob="other.xlsx").collect()
    assert len(cells) == 1 and cells[0]._error is not None       # a bad file is reported, not fatal


def test_load_system_export(spark, tmp_path):
    folder = str(tmp_path / "exports")
    _write_books(folder)
    explicit = os.path.join(folder, "Student_Export_1.xlsx")
    got = W.load_system_export(spark, file=explicit, folder=folder, sheet="Students")
    assert sorted(r.Email for r in got.collect()) == ["a@x", "b@x"]          # explicit file wins
    latest = W.load_system_export(spark, folder=folder, pattern="Student_Export*.xlsx", sheet="student list")
    assert [r.Email for r in latest.collect()] == ["c@x"]                    # newest file
    with pytest.raises(ValueError):
        W.load_system_export(spark, folder=folder, pattern="Student_Export*.xlsx", sheet="nope")


def test_workbook_headers_and_errors(spark):
    import datetime as dt
    def files(**books):
        rows = [(f"/x/{n}.xlsx", dt.datetime(2024, 1, 1), write_xlsx({"S": b}) if isinstance(b, list) else b) for n, b in books.items()]
        return spark.createDataFrame(rows, "path string, modificationTime timestamp, content binary")
    wide = W.read_workbooks(spark, files(a=[["Email", "_file", "x"], ["1", "2", "NA"]], b=[["EMAIL", "X", "x"], ["3", "4", "#N/A"]]))
    assert wide.columns == ["_file", "_sheet", "_ordinal", "Email", "_file.1", "x", "x.1"]
    assert sorted(tuple(r)[3:] for r in wide.collect()) == [("1", "2", None, None), ("3", None, "4", None)]
    with pytest.raises(ValueError, match="2 file"):
        W.read_workbooks(spark, files(a=b"no", b=b"no", c=[["x"], ["1"]]))
    long_name = "h" * 700
    cells = W.read_workbook_cells(spark, files(a=[["x"]]), sheet=long_name)
    assert long_name in cells.first()._error                     # whole error text
    assert W.unreadable_files(cells).count() == 1


def test_write_tables_guard(spark, tmp_path):
    full = spark.createDataFrame([(1,)], "a int")
    empty = spark.createDataFrame([], "a int")
    base = str(tmp_path / "out")
    assert write_tables({"Users": empty, "Other": full}, base, require_rows="Users") == []
    written = write_tables({"Users": full, "Other": full}, base, fmt="csv", require_rows="Users")
    assert len(written) == 2 and spark.read.option("header", "true").csv(written[0]).count() == 1


# ------------------------------------------------------------------ plan shapes

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
SKIP_PLAN = {"q_partition_write", "q_multi_write", "q_workbook_scan", "q_latest_snapshot", "q_sheet_resolve",
             "q_import_set",
             "q_mailbox_reports", "q_mailbox_stream", "q_report_counts", "q_unmatched_names", "q_header_drift",
             "q_multi_contents", "q_import_contents"}


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_check_query_plans(spark):
    """Plan shapes of every check query, and its column types equal its oracle's."""
    import duckdb

    import __spark_entry__ as E
    from rosterkit.checks.catalog import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    oracles = E.oracle_sql()
    from rosterkit.checks.registry import QUERIES
    for name, fn in QUERIES.items():
        if name in SKIP_PLAN:
            continue
        df = fn(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, f"{name} plans {bad}"
        if name in ("q_dedupe_first", "q_dedupe_latest", "q_students_base"):
            assert "WindowGroupLimit" in plan, name
        if name in oracles:
            rel = con.sql(oracles[name])
            duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                    for f in df.schema.fields}
            assert ours == duck, name


def test_message_filter_pushed_down(spark, tmp_path):
    import datetime as dt

    from rosterkit.plans.reports import MESSAGE_SCHEMA, ReportParams, scan_messages
    path = str(tmp_path / "msgs")
    spark.createDataFrame([("m", "Archive", "a", dt.datetime(2024, 1, 1), "b", [])], MESSAGE_SCHEMA) \
        .write.parquet(path)
    df = scan_messages(spark.read.parquet(path), ReportParams(sender="a"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(folder,Archive)" in plan and "EqualTo(sender,a)" in plan


# ------------------------------------------------------------------ driver contract

def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 20
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", ["q_scorecard", "q_new_rows", "q_dedupe_latest", "q_asof_link",
                                  "q_term_dates", "q_code_flags", "q_employer_extract"])
def test_oracles_agree_small(spark, name):
    """Spark result equals the DuckDB oracle on the sf0.001 tables."""
    import duckdb

    import __spark_entry__ as E
    from rosterkit.checks.catalog import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)

    def norm(rows, names):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else repr(r[i]) for i in order)
                      for r in rows)
    assert norm(res.fetchall(), cols) == norm([tuple(r) for r in df.collect()], df.columns)


def test_xlsx_shared_strings_and_dates():
    """Spreadsheet-app style files: shared strings, a date number format, rich text."""
    import io
    import zipfile
    buf = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/'
                   'officeDocument/2006/relationships"><sheets><sheet name="Data" sheetId="1" r:id="rId1"/>'
                   '</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/'
                   'package/2006/relationships"><Relationship Id="rId1" Target="worksheets/s1.xml" '
                   'Type="x"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>Name</t></si><si><t>Uploaded</t></si>'
                   '<si><r><t>Ann </t></r><r><t>Lee</t></r></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="m/d/yyyy"/>'
                   '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="22"/></cellXfs>'
                   '</styleSheet>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {ns}><sheetData>'
                   '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
                   '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2" s="1"><v>45292</v></c></row>'
                   '<row r="3"><c r="B3" s="2"><v>45292.5</v></c><c r="C3"><v>7</v></c></row>'
                   '</sheetData></worksheet>')
    headers, rows = table(Workbook(buf.getvalue()).rows())
    assert headers == ["Name", "Uploaded", "Unnamed: 2"]
    assert rows == [["Ann Lee", "2024-01-01", None], [None, "2024-01-01 12:00:00", "7"]]
