"""Schemas found by names and values, and sources inspected as a whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog, columns


def roles(spark, rows, schema):
    return columns.detect_schema(spark.createDataFrame(rows, schema))


def test_names_are_claimed_in_order(spark):
    got = roles(spark, [(1, 2, 3, 4.0, 5.0, "x", "y")], "`bar time` int, `Open Interest` int, v int, close double, `Adj Close` double, pred_label string, Label string")
    assert got == {"timestamp": "bar time", "open_interest": "Open Interest", "volume": "v", "close": "close", "predicted": "pred_label", "target": "Label"}
    only = roles(spark, [("a",)], "predicted_label string")
    assert only == {"predicted": "predicted_label"}  # which holds the word label too
    assert roles(spark, [("a", 1)], "label string, target int") == {"target": "target"}
    assert columns.named_like(["volume", "o"], ("open", "o"), []) == ["o"] and columns.named_like(["volume"], ("o",), []) == []


def test_measures_and_fractions_are_no_labels(spark):
    rows = [(k / 50, float(k % 3), k / 7, "a") for k in range(100)]
    got = roles(spark, rows, "pred_confidence double, pred double, actual double, truth string")
    assert got == {"predicted": "pred"}
    assert roles(spark, rows[:20], "pred_confidence double, pred double, actual double, truth string") == {"predicted": "pred", "target": "actual"}


def test_a_text_that_mostly_reads_as_a_time_is_the_timestamp(spark):
    rows = [(str(k), "2024-01-02 03:04:05" if k % 10 else "none", float(k)) for k in range(50)]
    assert roles(spark, rows, "code string, ends string, close double") == {"timestamp": "ends", "close": "close"}
    few = [(c, "2024-01-02" if k % 2 else "x", f) for k, (c, _, f) in enumerate(rows)]
    assert "timestamp" not in roles(spark, few, "code string, ends string, close double")
    assert roles(spark, [(1.0, dt.datetime(2024, 1, 1))], "x double, ends timestamp_ntz") == {"timestamp": "ends"}
    assert columns.detect_schema(spark.createDataFrame([], "a string, b int")) == {}


def test_first_source_wins_and_unlisted_ones_come_last(spark):
    c = spark.createDataFrame([("x", "a", 1), ("y", "a", 2), ("z", "a", 3), ("z", "b", 4), ("w", "c", 5), ("v", "c", 6)], "source string, column string, n int")
    order = spark.createDataFrame([("y", 1), ("x", 2)], "source string, place int")
    for o in (["y", "x"], order):
        assert {(r.column, r.source, r.n) for r in columns.first_by_source(c, o).collect()} == {("a", "y", 2), ("b", "z", 4), ("c", "v", 6)}


def test_selection_refuses_what_it_lacks(spark):
    c = spark.createDataFrame([("g1", "n1"), ("g2", "n2")], "group string, name string")
    assert catalog.selection(c).count() == 2 and catalog.selection(c, ["g1"], ["n2"]).count() == 2
    with pytest.raises(ValueError, match="g3, n9"):
        catalog.selection(c, ["g1", "g3"], ["n9"])


def test_sources_are_inspected(spark):
    t0 = dt.datetime(2024, 1, 1, 9, 15)
    rows = [(1, t0 + dt.timedelta(minutes=m), float((m * 7919) % 101), m // 15 * 1.0, "ab"[m // 5 % 2], "2024-01-01", 1.0, "s") for m in range(300)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, fast double, quarter double, kind string, session string, label_int double, state_class string")
    r = catalog.inspected(df, "src", ["k"]).first()
    assert r.banned == {"session": "calendar", "label_int": "named after the answer"} and set(r.suspect) == {"state_class"} and r.columns == ["fast", "quarter", "kind", "state_class"]
    assert r.clocks == {"fast": 1, "quarter": 15, "kind": 5, "state_class": 60} and r.clock == 60 and not r.pre_aligned
    assert set(r.unsure) == {"quarter", "state_class"} and r.categorical == ["kind", "state_class"] and r.rows == 300
    assert catalog.inspected(df, "src", ["k"], allow=("session",)).first().banned == {"label_int": "named after the answer"}
    merged = df.select("k", "ts", *(F.col(c).alias(f"vwap_{c}") for c in ("fast", "quarter", "kind")))
    r = catalog.inspected(merged, "src", ["k"], sources=("vwap",)).first()
    assert r.pre_aligned and r.clock == 1 and r.clocks is None
    with pytest.raises(ValueError, match="every column"):
        catalog.inspected(df.select("k", "ts", "session", "label_int"), "src", ["k"])
