"""Scans in levels, ranks and cuts without an order over all rows, and rules on names, against plain loops."""

import datetime as dt
import random
from itertools import groupby

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import attribution, clocks, order, quality, scan, splits, windows


@pytest.fixture(scope="module")
def runs_of():
    """Series with runs over many chunks, runs that end where a chunk does, nulls, and chunks of one row."""
    rng, rows = random.Random(4), []
    for key in ("a", "b", None):
        at = 0
        for _ in range(60):
            value = rng.choice([True, True, False, None])
            for _ in range(rng.choice([1, 2, 7, 40])):
                rows.append((key, at // rng.choice([10]), at, value))
                at += 1
    rows += [("one chunk", 0, k, k % 3 > 0) for k in range(9)] + [("one run", k // 2, k, True) for k in range(20)]
    return rows


def test_runs_are_merged_over_chunks(spark, runs_of):
    df = spark.createDataFrame(runs_of, "k string, chunk int, at int, v boolean").repartition(4)
    want, streaks = {}, []
    for key, rows in groupby(runs_of, key=lambda r: r[0]):
        for value, run in groupby(rows, key=lambda r: r[3]):
            ats = [r[2] for r in run]
            want |= {(key, at): ats[0] for at in ats}
            if value:
                streaks.append((key, len(ats), ats[0], ats[-1]))
    got = windows.onset(df, ["k"], ["at"], "v", "at", "chunk").collect()
    assert {(r.k, r.at): r.onset for r in got} == want and len(got) == len(runs_of)
    found = windows.losing_streaks(df, ["k"], "at", "v", "chunk").collect()
    assert sorted(((r.k, r.length, r.first, r["last"]) for r in found), key=repr) == sorted(streaks, key=repr)
    for key in {r.k for r in found}:
        own = sorted((r for r in found if r.k == key), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(own) + 1))
        assert own == sorted(own, key=lambda r: (-r.length, r.first))
    assert windows.losing_streaks(df.limit(0), ["k"], "at", "v", "chunk").count() == 0


def test_cells_are_supported_as_in_a_loop(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice("xxxxxxy"), rng.choice("xxxxxyyz"), k // 9) for k in range(400)]
    df = spark.createDataFrame(rows, "at int, t0 string, p0 string, chunk int")
    pairs = spark.createDataFrame([(a, b) for a in "xyz" for b in "xyz"], "t string, p string")
    got = {(r.t, r.p): r for r in windows.support_table(windows.cell_streams(df, pairs, "t0", "p0"), "at", "chunk").collect()}
    for t, p in {(r[1], x) for r in rows for x in "xyz"}:
        wrong = [b != t for _, a, b, _ in rows if a == t and (t == p or b in (t, p))]
        if not wrong:
            assert (t, p) not in got
            continue
        streaks = [len(list(g)) for w, g in groupby(wrong) if w]
        score = peak = 0
        falls = {}  # of each peak: depth, place of its first row
        for k, w in enumerate(wrong):
            score += -1 if w else 1
            if score < peak:
                falls[peak] = (max(falls.get(peak, (0, k))[0], peak - score), falls.get(peak, (0, k))[1])
            peak = max(peak, score)
        r = got[t, p]
        assert (r.n, r.n_wrong, r.final_score, r.n_streaks, r.longest) == (len(wrong), sum(wrong), score, len(streaks), max(streaks, default=0))
        assert (r.n_drawdowns, r.deepest) == (len(falls), max((d for d, _ in falls.values()), default=0))
        if falls:
            assert r.recovered == (min(falls, key=lambda x: (-falls[x][0], falls[x][1])) < peak)


@pytest.mark.parametrize("fan", [4, 256])
def test_affine_maps_are_a_loop(spark, monkeypatch, fan):
    monkeypatch.setattr(scan, "FAN", fan)
    rng, rows, want = random.Random(fan), [], {}
    for key, n in (("a", 1), ("b", 4), ("c", 5), ("d", 333), (None, 64)):
        y = 0.0
        for k in range(n):
            a, b = rng.choice([0.0, 0.9, -0.5, 1.0]), rng.random()
            y = a * y + b
            want[key, k] = y
            rows.append((key, k, a, b))
    df = spark.createDataFrame(rows, "k string, i int, a double, b double").repartition(3)
    got = {(r.k, r.i): r.y for r in scan.affine(df, ["k"], "i", "a", "b", "y").collect()}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-12) for x in want)
    assert scan.affine(df.limit(0), ["k"], "i", "a", "b", "y").count() == 0


def test_chunks_and_windows_give_one_atr(spark):
    rng = random.Random(9)
    rows = [(k, j, j // 5, 10 + rng.random(), 9 - rng.random(), 9.5 + rng.random() / 3) for k in ("a", "b") for j in range(90)] + [("short", j, 0, 2.0, 1.0, 1.5) for j in range(13)]
    df = spark.createDataFrame(rows, "k string, at int, chunk int, high double, low double, close double")
    whole, parted = ({(r.k, r.at): r.atr for r in windows.wilder_atr(df, ["k"], "at", chunk=c).collect()} for c in (None, "chunk"))
    assert whole.keys() == parted.keys() and len(whole) == len(rows)
    assert all((whole[x] is None) == (parted[x] is None) == (x[0] == "short" or x[1] < 13) and (whole[x] is None or whole[x] == pytest.approx(parted[x])) for x in whole)


def test_ranks_of_ties_are_their_mean(spark):
    rng = np.random.default_rng(2)
    values = [None if rng.random() < 0.1 else float(x) for x in np.where(rng.random(600) < 0.4, 7.0, rng.integers(-50, 50, 600))]
    frame = pd.DataFrame({"k": [None if k % 3 == 0 else f"k{k % 2}" for k in range(600)], "i": range(600), "v": values})
    df = spark.createDataFrame([tuple(None if x != x else x for x in r) for r in frame.itertuples(index=False)], "k string, i int, v double")
    got = {r.i: (r["rank"], r.rank_of) for r in order.average_ranks(df, ["k"], "v", "rank").collect()}
    want = frame.groupby(frame.k.fillna("-")).v.rank()
    assert len(got) == 600
    for i in range(600):
        assert got[i][0] is None if values[i] is None else got[i][0] == want[i]


def test_drift_of_all_columns_at_once(spark):
    rng = np.random.default_rng(5)
    test = rng.random(900) < 0.3
    columns = {"ties": rng.integers(0, 4, 900).astype(float), "moved": rng.normal(0, 1, 900) + test * 0.5, "gaps": np.where(rng.random(900) < 0.5, np.nan, rng.random(900)), "train_only": np.where(test, np.nan, 1.0)}
    rows = [(bool(test[k]), *(None if np.isnan(c[k]) else float(c[k]) for c in columns.values())) for k in range(900)]
    df = spark.createDataFrame(rows, "test boolean, " + ", ".join(f"{c} double" for c in columns))
    got = {r.column: r for r in quality.drift(df, list(columns), F.col("test")).collect()}
    for name, c in columns.items():
        a, b = (np.sort(c[m & ~np.isnan(c)]) for m in (~test, test))
        r = got[name]
        assert (r.n_train, r.n_test) == (len(a), len(b))
        if not len(b):
            assert r.ks is None and r.psi is None and r.drifted is None
            continue
        at = np.unique(np.concatenate([a, b]))
        ks = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
        limit = np.sqrt(-np.log(0.025) / 2 * (len(a) + len(b)) / (len(a) * len(b)))
        bins = lambda x: np.minimum(9, 10 * np.searchsorted(a, x, "left") // len(a))
        p, q = ((np.bincount(bins(x), minlength=10) + 0.5) / (len(x) + 0.5) for x in (a, b))
        used = np.bincount(bins(at), minlength=10) > 0
        assert r.ks == pytest.approx(ks, abs=1e-6) and r.ks_limit == pytest.approx(limit, abs=1e-6) and r.drifted == (ks > limit)
        assert r.psi == pytest.approx(((q - p) * np.log(q / p))[used].sum(), abs=1e-5)
    assert got["moved"].drifted and not got["ties"].drifted


def test_rows_seen_before(spark):
    train = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "x int, y string")
    test = spark.createDataFrame([(1, "a")] * 3 + [(None, "b"), (2, "a"), (None, None)], "x int, y string")
    r = quality.row_overlap(train, test, ["x", "y"]).first()
    assert (r.n_test, r.n_seen, r.n_seen_distinct, r.share) == (6, 4, 2, 0.666667)
    empty = quality.row_overlap(train, test.limit(0), ["x", "y"]).first()
    assert (empty.n_test, empty.n_seen, empty.share) == (0, 0, None)


def test_places_are_found_by_counting(spark):
    rng = random.Random(8)
    values = [rng.choice([5, 5, -(1 << 40), 1 << 40, rng.randrange(10**6)]) for _ in range(500)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "i long, v long")
    ordered = sorted(values)
    for place in (0, 100, 250, 499):
        value, below, equal = order.order_statistic(df, "v", place)
        assert value == ordered[place] and below == sum(x < value for x in values) and equal == values.count(value)
    assert order.order_statistic(df, "v", 500) is None and order.order_statistic(df, "v", -1) is None
    for n in (0, 1, 137, 499, 500, 501):
        got = {r.i for r in df.where(order.first_rows(df, n, "v", "i")).collect()}
        assert got == {i for _, i in sorted((v, i) for i, v in enumerate(values))[:n]}


def test_samples_are_of_the_size_that_was_asked_for(spark):
    rows = [(k, f"f{j}", float((k * 7 + j * 3) % 11 - 5)) for k in range(101) for j in range(3)]
    attr = spark.createDataFrame(rows, "row_id long, feature string, value double")
    ids = attr.select("row_id").distinct()
    factors = [attribution.sample_factor(b) for b in range(4)]
    assert all(f % 2 for f in factors) and len(set(factors)) == 4
    hashes = {f"h{b}": splits.times_modulo(F.col("row_id"), f) for b, f in enumerate(factors)} | {"flat": F.pmod("row_id", F.lit(3))}
    for name, own in order.least_hashed(ids, hashes, "row_id", 71).items():
        got = {r.row_id for r in ids.where(own).collect()}
        key = (lambda x: (x % 3, x)) if name == "flat" else (lambda x, f=factors[int(name[1:])]: (x * f % (1 << 32), x))
        assert got == set(sorted(range(101), key=key)[:71])
    shares = {r.feature: r for r in attribution.stable_shares(attr, 4, 0.7, 0).collect()}
    for j in range(3):
        by_boot = []
        for f in factors:
            drawn = set(sorted(range(101), key=lambda x: x * f % (1 << 32))[:71])
            means = [np.mean([abs(v) for k, n, v in rows if k in drawn and n == f"f{i}"]) for i in range(3)]
            by_boot.append(100 * means[j] / sum(means))
        assert shares[f"f{j}"]["mean"] == pytest.approx(np.mean(by_boot)) and shares[f"f{j}"].std == pytest.approx(np.std(by_boot, ddof=1))


def test_parts_have_exact_sizes_and_need_no_order(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(minutes=7 * k)) for k in range(3000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    candles = sorted({t.replace(minute=t.minute // 15 * 15) for _, t in rows if t})
    drawn = splits.bundle_random(df, 0.15, 0.25, 3)
    timed = splits.bundle_time(df, 0.15, 0.25, 0)
    for made in (drawn, timed):
        got = made.groupBy("split").agg(F.count_distinct(F.window(F.col("ts").cast("timestamp"), "15 minutes")).alias("n")).collect()
        n = len(candles)
        test, val = round(n * 0.25), round(n * 0.15)
        sizes = {r.split: r.n for r in got}
        assert sum(sizes.values()) == n and abs(sizes["test"] - test) <= 1 and abs(sizes["val"] - val) <= 1
        assert made.count() == 3000
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_hashes_of_any_id(spark):
    ids = [0, 1, -1, 2**31, 2**32 + 5, 2**62 + 12345, -(2**63)]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", splits.hash_rank(F.col("i"), 7).alias("h")).collect()
    assert {r.i: r.h for r in got} == {i: (i * 2654435761 + 7 * 40503) % 2**32 for i in ids}


def test_text_clocks_and_medians_of_sizes(spark):
    t0 = dt.datetime(2024, 1, 1, 9, 15)
    rows = [(1, t0 + dt.timedelta(minutes=m), "ab"[m // 15 % 2] if m % 4 else None, m // 30 % 2 == 0, (1 if m % 2 else -1) * 1e6 if m // 60 else 1e6 + m % 5 * 1e-3, None) for m in range(240)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, text string, flag boolean, jitter double, none string")
    got = {r.column: r.clock for r in clocks.column_clocks(df, ["k"], ["text", "flag", "jitter"]).collect()}
    assert got == {"text": 15, "flag": 30, "jitter": 1}
    assert {(r.column, r.period) for r in clocks.bar_constancy(df, ["k"], ["text", "none"]).collect()} == {("text", p) for p in clocks.PERIODS}
    wide = df.select("k", "ts", *(F.col("text").alias(f"t{j}") for j in range(70)))
    assert {r.clock for r in clocks.column_clocks(wide, ["k"], wide.columns[2:]).collect()} == {15}


@pytest.mark.parametrize("n, large, still", [(4000, 2000, True), (4000, 2001, True), (4000, 1999, False), (4001, 2001, True), (4001, 2000, False)])
def test_a_movement_is_set_against_the_exact_median(spark, n, large, still):
    """One bar moves by 0.5, which a median size of 500,000 bears: the mean of 1.5 and 1,000,000 does."""
    seconds = F.when(F.col("id") == n - 1, (n - 2) * 3600 + 60).otherwise(F.col("id") * 3600)
    x = F.when(F.col("id") == n - 1, 1.5).when(F.col("id") < large, 1e6).otherwise(1.0)
    df = spark.range(n).select(F.lit(1).alias("k"), F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("ts"), x.alias("x"))
    assert [tuple(r) for r in clocks.bar_constancy(df, ["k"], ["x"], (3,)).collect()] == [("x", 3, n - 1, still)]


@pytest.mark.parametrize("verdict, names", [
    ("banned", "label_int label_int_3 label target target_5 y y_up y.up outcome outcome_2 primary_label weight weight_raw dir_at_label is_label is_label_3 label_dir signed_ret signed_ret_5 fut_ret_5 future_ret fwd_ret_1 x_fwd ret_ahead next_close ahead_2 lead_1 x_lead5 close_future session date datetime day t5 ts src__session src__label_int vwap_session"),
    ("suspect", "label_combined Flow_State_Label my_target_zone up_class labels"),
    ("ok", "Future_option_Diff fut_spot_spread fut_oi_chg1 leading weights year minute_of_day yield today headline close classes daily"),
])
def test_names_are_judged_as_leaks_are_named(verdict, names):
    for name in names.split():
        assert quality.name_verdict(name, "double", sources=("vwap", "vwap_micro"))[0] == verdict, name
    assert quality.own_name("vwap_micro_session", ("vwap", "vwap_micro")) == "session"
    assert quality.name_verdict("label_int", "double", ("label_int",)) == ("ok", "allowed") and quality.name_verdict("x", "timestamp_ntz")[0] == "banned"


def test_measures_over_few_rows_say_nothing(spark):
    rng = np.random.default_rng(1)
    price = 100 * np.exp(np.cumsum(rng.normal(0, 1e-2, 1500)))
    peek = np.append(price[1:] / price[:-1] - 1, 0.0)
    for n, verdict in ((900, "ok"), (1500, "banned")):
        df = spark.createDataFrame(pd.DataFrame({"k": 1, "i": range(n), "close": price[:n], "peek": peek[:n], "up": peek[:n] > 0}))
        got = {r.column: r.verdict for r in quality.leak_screen(df, ["k"], "close", ["peek", "up"], ["i"]).collect()}
        assert got == {"peek": verdict, "up": verdict}
