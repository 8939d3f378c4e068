"""Operators: header resolution, dedupe, membership, as-of."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterkit.operators import asof as A
from rosterkit.operators import dedupe as Dd
from rosterkit.operators import match as M
from rosterkit.operators import schema as S


# ------------------------------------------------------------------ schema

def test_excel_letters():
    assert [S.excel_letter_index(x) for x in ("A", "Z", "AA", "AD", "CE", "a1", "")] == \
        [0, 25, 26, 29, 82, None, None]


def test_resolve_name_order():
    cols = ["Email Address", "email", "Student Email"]
    # exact normalised match in candidate order wins over column order
    assert S.resolve_name(cols, ["studentEmail", "email"]) == "Student Email"
    # duplicate normalised headers: the first one wins
    assert S.resolve_name(["E-mail", "email"], ["email"]) == "E-mail"
    # substring either way, in column order
    assert S.resolve_name(["Student Entry Semester (term)"], ["entry semester"]) == \
        "Student Entry Semester (term)"
    # letter fallback, then error
    cols30 = [f"c{i}" for i in range(30)]
    assert S.resolve_name(cols30, ["nothing"], fallback_letter="AD") == "c29"
    with pytest.raises(ValueError, match="headers"):
        S.resolve_name(["a"], ["nothing"], required=True)
    # An all-punctuation header has an empty key and never matches
    assert S.resolve_name(["???", "x"], ["email"]) is None


def test_detect_columns_first_match_and_override():
    cols = ["First Generation?", "First Name", "Last Name", "Educational Status", "Status"]
    m = S.detect_columns(cols)
    assert m["first_name"] == "First Generation?"   # D10 misfire kept
    assert m["status"] == "Educational Status"
    m2 = S.detect_columns(cols, overrides={"first_name": "First Name"})
    assert m2["first_name"] == "First Name"
    with pytest.raises(ValueError):
        S.detect_columns(cols, overrides={"first_name": "missing"})


def test_standardize_and_redact(spark):
    df = spark.createDataFrame([("a@x", "1", "s", "x")], ["E-MAIL", "Security  Clearance", "Total Percentage", "Keep"])
    out = S.standardize(df, [S.FieldSpec("email", ("email",), required=True),
                             S.FieldSpec("missing", ("zzz",))])
    assert out.columns == ["email", "missing"] and out.first()["missing"] is None
    with pytest.raises(ValueError):
        S.standardize(df, [S.FieldSpec("x", ("zzz",), required=True)])
    assert S.redact(df, ["security clearance", "TOTAL PERCENTAGE"]).columns == ["E-MAIL", "Keep"]
    assert S.move_first(df, "Keep").columns[0] == "Keep"
    e = S.empty_frame(spark, "a string, b int")
    assert e.count() == 0 and e.columns == ["a", "b"]


# ------------------------------------------------------------------ dedupe

def test_keep_first_and_latest(spark):
    rows = [(1, "k", 3), (2, "k", 1), (3, "j", 5), (4, None, 9), (5, None, 9)]
    df = spark.createDataFrame(rows, "id int, k string, v int")
    first = {r.k: r.id for r in Dd.keep_first(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    assert first == {"k": 2, "j": 3, None: 4}
    latest = Dd.keep_latest(df, F.col("k"), [F.col("v"), F.col("id")], row_id=F.col("id"))
    assert sorted(r.id for r in latest.collect()) == [1, 3, 4, 5]   # blank keys all kept
    split = Dd.keep_latest(df, F.col("k"), [F.col("v"), F.col("id")])
    assert sorted(r.id for r in split.collect()) == [1, 3, 4, 5]


def test_keep_latest_plans_window_group_limit(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).cast("string").alias("k"))
    out = Dd.keep_latest(df, F.col("k"), [F.col("id")], row_id=F.col("id"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)), min_size=1, max_size=30))
def test_keep_latest_properties(spark, data):
    rows = [(i, k, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "id int, k string, v int")
    out = Dd.keep_latest(df, F.col("k"), [F.col("v"), F.col("id")], row_id=F.col("id")).collect()
    keyed = [r for r in out if r.k is not None]
    assert len({r.k for r in keyed}) == len(keyed)                       # one row per key
    assert sum(1 for r in out if r.k is None) == sum(1 for _, k, _ in rows if k is None)
    for r in keyed:                                                     # it is the greatest
        assert (r.v, r.id) == max((v, i) for i, k, v in rows if k == r.k)
    # idempotent and independent of input order / partitioning
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df2 = spark.createDataFrame(shuffled, "id int, k string, v int").repartition(3)
    out2 = Dd.keep_latest(df2, F.col("k"), [F.col("v"), F.col("id")], row_id=F.col("id")).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, out2))


def test_fill_from_first(spark):
    rows = [("f1", 2, None), ("f1", 1, "  "), ("f1", 3, "2024-01-02"), ("f1", 4, "2024-09-09"),
            ("f2", 1, None)]
    df = spark.createDataFrame(rows, "f string, o int, v string")
    got = {(r.f, r.o): r.v for r in Dd.fill_from_first(df, "v", ["f"], [F.col("o")]).collect()}
    assert got == {("f1", 1): "2024-01-02", ("f1", 2): "2024-01-02", ("f1", 3): "2024-01-02",
                   ("f1", 4): "2024-09-09", ("f2", 1): None}


# ------------------------------------------------------------------ membership

def test_flag_membership_bag_semantics(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    out = sorted((r.k or "", r.hit) for r in M.flag_membership(df, F.col("k"), keys, "hit").collect())
    assert out == [("", False), ("a", True), ("a", True), ("b", False)]
    assert M.anti_join(df, F.col("k"), keys).count() == 2   # NULL key kept (not NOT IN semantics)
    assert M.semi_join(df, F.col("k"), keys).count() == 2


def test_name_key_rules(spark):
    df = spark.createDataFrame([("  ANN ", "lee", None), ("", " ", dt.date(2000, 1, 2))],
                               "f string, l string, d date")
    r = df.select(M.name_key(F.col("f"), F.col("l"), F.col("d")).alias("k"),
                  M.name_key(F.col("f"), F.col("l"), F.col("d"), blank_names_match=True).alias("k2")).collect()
    assert r[0].k == "ann|lee|None" and r[1].k is None and r[1].k2 == "||2000-01-02"


def test_no_or_join_in_membership_plan(spark):
    df = spark.createDataFrame([("a", "x")], "k string, e string")
    keys = spark.createDataFrame([("a",)], "k string")
    out = M.flag_membership(M.flag_membership(df, F.col("k"), keys, "a"), F.col("e"), keys, "b")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


# ------------------------------------------------------------------ as-of

def _brute_asof(rows, events):
    out = {}
    for rid, key, t in rows:
        best = None
        for eid, ek, et, val in events:
            if ek == key and key is not None and (et, eid) <= (t, rid):
                if best is None or (et, eid) > best[0]:
                    best = ((et, eid), val)
        out[rid] = best[1] if best else None
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u", "v", None]), st.integers(0, 6)), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from(["u", "v", None]), st.integers(0, 6)), max_size=25))
def test_asof_matches_brute_force(spark, rs, es):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, k, t) for i, (k, t) in enumerate(rs)]
    events = [(100 + i, k, t, f"val{i}") for i, (k, t) in enumerate(es)]
    rdf = spark.createDataFrame([(i, k, base + dt.timedelta(hours=t * 7), (base + dt.timedelta(hours=t * 7)).date())
                                 for i, k, t in rows], "id int, key string, ts timestamp, day date")
    edf = spark.createDataFrame([(i, k, base + dt.timedelta(hours=t * 7), (base + dt.timedelta(hours=t * 7)).date(), v)
                                 for i, k, t, v in events] or [(0, "zz", base, base.date(), "x")],
                                "id int, key string, ts timestamp, day date, val string")
    want = _brute_asof(rows, events)
    for slice_by in (None, "day"):
        got = {r.id: r.val for r in A.asof_join(rdf, edf, ["key"], ["ts", "id"], ["val"],
                                                slice_by=slice_by).collect()}
        assert got == want


def test_last_wins_lookup(spark):
    df = spark.createDataFrame([("f", "a.pdf", 1, "p1"), ("f", "a.pdf", 3, "p3"), ("f", "b.pdf", 2, "p2")],
                               "file string, name string, o int, person string")
    got = {r.name: r.person for r in A.last_wins_lookup(df, ["file", "name"], ["o"], ["person"]).collect()}
    assert got == {"a.pdf": "p3", "b.pdf": "p2"}
