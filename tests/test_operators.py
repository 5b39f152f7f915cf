"""Properties that no single query shows: nothing peeks, loops agree with windows, planted leaks are found, lies are refused."""

import pandas as pd
import numpy as np
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import timebars as B
from tidemark.operators import asof, catalog, clocks, columns, evaluate, missing, quality, scan, splits, trades, windows
from tidemark.sources import readers

START = dt.datetime(2024, 1, 1, 9, 15)


def minute(k):
    return START + dt.timedelta(minutes=k)


def series(spark, n=400, seed=1, key="a"):
    rng = random.Random(seed)
    return spark.createDataFrame([(key, minute(k), float(rng.randint(50, 150)), rng.choice(["buy", "sell", "hold", None])) for k in range(n)], "k string, ts timestamp_ntz, x double, sig string")


@pytest.mark.parametrize("bar", [1, 3, 5, 15, 30, 60])
def test_no_row_sees_an_open_bar(spark, bar):
    """Values say when their bar began, so a served value can be decoded and its close compared."""
    feature = spark.createDataFrame([("a", minute(k)) for k in range(300)], "k string, ts timestamp_ntz").withColumn("v", F.unix_seconds(B.bar_start(F.col("ts"), bar).cast("timestamp")) / 60)
    out = asof.align_to_bars(feature.select("k", "ts"), feature, ["k"], ["v"], bar, 3)
    served = out.where("v is not null")
    now = F.unix_seconds(F.col("ts").cast("timestamp")) / 60
    assert served.count() > 100
    assert served.where(F.col("v") + bar > now).count() == 0
    assert served.where(F.col("v") + bar * 4 < now).count() == 0
    assert asof.no_peek(out).first().n_violations == 0


def test_asof_equals_a_loop(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", "b", None]), minute(rng.randint(0, 9000))) for i in range(300)]
    right = sorted({(rng.choice(["a", "b"]), minute(rng.randint(0, 9000))) for _ in range(80)})
    got = asof.asof_backward(spark.createDataFrame(left, "id long, k string, ts timestamp_ntz"), spark.createDataFrame([(k, t, float(i)) for i, (k, t) in enumerate(right)], "k string, at timestamp_ntz, v double"), ["k"], "at", ["v"], 2000)
    found = {r.id: r.v for r in got.collect()}
    for i, k, t in left:
        fits = [(at, j) for j, (k2, at) in enumerate(right) if k2 == k and at <= t <= at + dt.timedelta(minutes=2000)]
        assert found[i] == (float(max(fits)[1]) if fits else None)


def test_two_levels_equal_one_window(spark):
    df = series(spark, 500).withColumn("chunk", (F.minute("ts") / 7).cast("int") + F.hour("ts") * 10)
    for ahead in (False, True):
        values = {"total": ("sum", "x"), "top": ("max", "x"), "n": ("count", "sig"), "known": ("first" if ahead else "last", "sig")}
        got = scan.running(df, ["k"], "chunk", ["ts"], values, ahead=ahead).orderBy("ts").collect()
        rows = sorted(df.collect(), key=lambda r: r.ts, reverse=ahead)
        total, top, n, known, want = 0, None, 0, None, []
        for r in rows:
            total, top, n, known = total + r.x, max(top or r.x, r.x), n + (r.sig is not None), r.sig or known
            want.append((r.ts, total, top, n, known))
        assert [(r.ts, r.total, r.top, r.n, r.known) for r in got] == sorted(want, key=lambda w: w[0])


def test_atr_equals_the_recurrence(spark):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        o, c = rng.uniform(90, 110), rng.uniform(90, 110)
        rows.append(("a", minute(k), o, max(o, c) + rng.random(), min(o, c) - rng.random(), c))
    got = windows.wilder_atr(spark.createDataFrame(rows, "k string, ts timestamp_ntz, open double, high double, low double, close double"), ["k"], "ts").orderBy("ts").collect()
    before, ranges, atr = rows[0][5], [], None
    for r, (_, _, _, h, lo, c) in zip(got, rows, strict=True):
        ranges.append(max(h - lo, abs(h - before), abs(lo - before)))
        before = c
        atr = sum(ranges) / 14 if len(ranges) == 14 else (atr * 13 + ranges[-1]) / 14 if atr else None
        assert (r.atr is None) == (atr is None) and (atr is None or abs(r.atr - atr) < 1e-8)


@pytest.mark.parametrize("seed", range(3))
def test_trades_equal_a_bar_by_bar_loop(spark, seed):
    rng = random.Random(seed)
    bars = [("a", minute(k), rng.uniform(90, 110), 0.0, 0.0, rng.uniform(90, 110), rng.choice(["buy", "sell", "hold", None, None])) for k in range(250)]
    bars = [(k, t, o, max(o, c) + 1, min(o, c) - 1, c, s) for k, t, o, _, _, c, s in bars]
    df = spark.createDataFrame(bars, "k string, ts timestamp_ntz, open double, high double, low double, close double, sig string")
    made = trades.pair_trades(trades.bar_events(df, ["k"], trades.strategies(spark, [("V", "buy", ["sell"])])), ["k"], 0.5)
    made = trades.excursions(made, df, ["k"])
    known, held, want = None, [], []
    for n, (_, t, o, h, lo, c, s) in enumerate(bars):
        fire = s is not None and s != known
        known = s or known
        if fire and n + 1 < len(bars):
            fill = (bars[n + 1][1], bars[n + 1][2])
            if s == "buy":
                held.append(fill)
            elif s == "sell":
                want += [(*e, *fill, "exit") for e in held]
                held = []
    want += [(*e, bars[-1][1], bars[-1][5], "end_of_data") for e in held]
    got = made.collect()
    assert sorted((r.entry_ts, r.entry_price, r.exit_ts, r.exit_price, r.reason) for r in got) == sorted(want)
    assert all(-r.mae - 1e-9 <= r.points <= r.mfe + 1e-9 for r in got)
    last = trades.equity_curve(df.select("k", "ts", "close"), made, ["k"], trades.strategies(spark, [("V", "buy", ["sell"])])).orderBy(F.desc("ts")).first()
    assert last.lots == 0 and abs(last.gross - sum(r.points for r in got)) < 1e-6


def test_score_drawdowns_equal_a_loop(spark):
    rng = random.Random(9)
    flags = [rng.random() < 0.5 for _ in range(300)]
    df = spark.createDataFrame([("a", k, f) for k, f in enumerate(flags)], "k string, at int, wrong boolean")
    score = peak = 0
    open_, want = None, []
    for k, f in enumerate(flags):
        score += -1 if f else 1
        if score > peak:
            if open_:
                want.append((*open_, True))
            peak, open_ = score, None
        elif score < peak:
            open_ = (max(open_[0], peak - score), open_[1], k) if open_ else (peak - score, k, k)
    if open_:
        want.append((*open_, False))
    got = windows.score_drawdowns(df, ["k"], "at", "wrong").collect()
    assert sorted((r.depth, r.first, r.last, r.recovered) for r in got) == sorted(want)


@pytest.mark.parametrize("bar", [1, 3, 5, 15, 30, 60])
def test_clock_is_the_largest_period_that_fits(spark, bar):
    base = spark.createDataFrame([("a", minute(k)) for k in range(360)], "k string, ts timestamp_ntz")
    df = base.withColumn("v", F.pmod(F.hash(B.bar_start(F.col("ts"), bar)), F.lit(1000)).cast("double") + F.rand(1) * 1e-9)
    assert clocks.column_clocks(df, ["k"], ["v"]).first().clock == bar


def test_planted_leaks_are_banned_and_honest_columns_kept(spark):
    rng = random.Random(2)
    price, rows = 100.0, []
    for k in range(3000):
        price *= 1 + rng.gauss(0, 0.01)
        rows.append(("a", minute(k), price, rng.random()))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, close double, noise double")
    df = windows.returns(df, ["k"], ["ts"], "close", (10,)).withColumn("clock", F.unix_seconds(F.col("ts").cast("timestamp")).cast("double"))
    found = {r.column: r.verdict for r in quality.leak_verdict(quality.leak_statistics(df, ["k"], "close", ["fwd_10", "past_10", "noise", "clock"], ["ts"])).collect()}
    assert found == {"fwd_10": "banned", "past_10": "ok", "noise": "ok", "clock": "banned"}
    assert quality.name_verdict("src__fwd_ret_5", "double")[0] == "banned" and quality.name_verdict("minute_of_day", "double")[0] == "ok"


def test_folds_leave_what_they_promise(spark):
    df = spark.createDataFrame([(d * 10 + k, dt.datetime(2024, 1, 1) + dt.timedelta(days=d + d // 5 * 2, hours=k)) for d in range(40) for k in range(3)], "id int, ts timestamp_ntz")
    made = splits.purged_folds(df, 4, 2, 1).cache()
    assert splits.leaks(made, 2, 1).count() == 0
    assert splits.leaks(made.withColumn("role", F.when(F.col("role") == "dropped", "train").otherwise(F.col("role"))), 2, 1).count() > 0
    assert made.where("role = 'test'").groupBy("id").count().where("count <> 1").count() == 0


def test_a_manifest_that_lies_is_refused(spark):
    df = spark.createDataFrame([(k, f"c{k % 3}", k * 1.5) for k in range(50)], "id long, label string, a__x double")
    good = catalog.manifest(df, "v1", ["a__x"], "label", "closed bars only")
    assert catalog.verify(df, good) == []
    assert "rows" in catalog.verify(df, good.withColumn("rows", F.lit(51).cast("long")))
    assert "status" in catalog.verify(df, good.withColumn("status", F.lit("draft")))
    assert "content" in catalog.verify(df.withColumn("a__x", F.col("a__x") + 1e-9), good)
    assert catalog.verify(df, good.drop("no_peek")) == ["no no_peek"]


def test_readers_refuse_what_they_should(spark, tmp_path):
    with pytest.raises(ValueError, match="time zone"):
        readers.time_keyed(spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp"))
    with pytest.raises(ValueError, match="no time"):
        readers.time_keyed(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError, match="repeated"):
        readers.clean_labels(spark.createDataFrame([("01-02-2024 09:15", "a", "1")] * 2, "t string, l string, w string"), "t", "l", "w")
    with pytest.raises(ValueError, match="1 %"):
        readers.clean_labels(spark.createDataFrame([("nonsense", "a", "1")], "t string, l string, w string"), "t", "l", "w")
    with pytest.raises(ValueError, match="no rows"):
        spark.range(0).write.parquet(f"{tmp_path}/empty.parquet")
        readers.read_table(spark, f"{tmp_path}/empty.parquet")


def test_times_by_magnitude(spark):
    want = dt.datetime(2024, 3, 1, 12)
    seconds = (want - dt.datetime(1970, 1, 1)).total_seconds()
    for value in (seconds, seconds * 1e3, seconds * 1e6, seconds * 1e9):
        assert spark.createDataFrame([(value,)], "x double").select(readers.numeric_time(F.col("x"), value)).first()[0] == want
    assert spark.createDataFrame([(20240301.0,)], "x double").select(readers.numeric_time(F.col("x"), 20240301)).first()[0] == dt.datetime(2024, 3, 1)
    assert spark.createDataFrame([(45352.5,)], "x double").select(readers.numeric_time(F.col("x"), 45352.5)).first()[0] == want


def test_names(spark):
    assert columns.bare_name("fast_src__x", ["fast", "fast_src"]) == "x"
    assert columns.next_minor("v2.9") == "v2.10" and columns.next_minor("v3") == "v3.1"
    with pytest.raises(ValueError, match="fits"):
        columns.resolve_drops(["a__x", "b__x"], ["x"])
    assert columns.schema_changes([("a", "string"), ("b", "int")], [("b", "int"), ("a", "boolean")]) == {"added": [], "removed": [], "retyped": [], "moved": ["order"]}
    assert columns.detect_roles(["open_interest", "open", "hi"], {"oi": ["open_interest"], "open": ["open"], "high": ["high", "hi"]}) == {"oi": "open_interest", "open": "open", "high": "hi"}


def test_perfect_predictions_cost_nothing_and_worse_ones_more(spark):
    df = spark.createDataFrame([("a", "a", "b"), ("b", "b", "a"), ("b", "b", "b")], "t string, good string, bad string")
    cost = lambda p: evaluate.trading_cost(evaluate.rank_mistakes(df, "t", p)).first().cost
    assert cost("good") == 0 and cost("bad") == 1.5


def test_unseen_categories_and_sentinels(spark):
    train = spark.createDataFrame([("x", 1.0), ("y", 3.0), (None, None)], "c string, v double")
    codes = missing.category_codes(train, "c")
    new = missing.encode(spark.createDataFrame([("x",), ("z",), (None,)], "c string"), "c", codes)
    assert {r.c: r.c_code for r in new.collect()} == {"x": 0, "z": -1, None: -1}
    assert missing.sentinels(train, ["v"]).first().v == -2.0


def test_quantiles_are_exact(spark):
    rng = random.Random(11)
    values = sorted([rng.randint(-(10**12), 10**12) for _ in range(500)] + [7] * 60)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for q in (0.0, 0.1, 0.37, 0.5, 0.999, 1.0):
        at = q * (len(values) - 1)
        low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
        assert abs(splits.exact_quantile(df, "v", q) - (low + (at - int(at)) * (high - low))) < 1e-3
    assert splits.exact_quantile(df.where("v is null"), "v", 0.5) is None


def test_bare_names_equal_a_loop(spark):
    rng = random.Random(7)
    names = sorted({"".join(rng.choice(["a", "b", "_", "__"]) for _ in range(rng.randint(0, 7))) for _ in range(300)})
    known = ["a", "ab", "a_b", "b", "b_", "aa__b", ""]
    got = columns.bare_names(spark.createDataFrame([(n,) for n in names * 2], "n string"), spark.createDataFrame([(k,) for k in known * 2], "s string"), "n", "s")
    assert sorted(map(tuple, got.collect())) == [(n, columns.bare_name(n, known)) for n in names]


def test_clocks_resolve_as_columns(spark):
    rows = [(5, 15, None), (15, 5, None), (5, None, None), (5, 0, None), (15, 5, 3), (5, 15, 6)]
    clock, warning = clocks.resolve_clock(F.col("m"), F.col("d"), F.col("o"))
    got = spark.createDataFrame(rows, "m int, d int, o int").select(clock, warning).collect()
    assert [r[0] for r in got] == [15, 15, 5, 5, 3, 6]
    assert [r[1] for r in got] == [None, "declared 5 is faster than measured 15", None, None, "override 3 is faster than measured 15", None]


def test_lookups_stay_on_spark(spark):
    from conftest import SF

    from tidemark.plans import lookups

    assert lookups.p04(spark, SF).inputFiles() and lookups.q05(spark, SF).inputFiles()


def test_leak_screen_takes_names_first_and_then_measures(spark):
    rng = np.random.default_rng(3)
    n = 3000
    price = 100 * np.exp(np.cumsum(rng.normal(0, 1e-3, n)))
    made = {"i": range(n), "close": price, "score": np.append(price[1:] / price[:-1] - 1, 0) + rng.normal(0, 2e-4, n), "momentum": np.append(0, price[1:] / price[:-1] - 1), "event_no": np.where(rng.random(n) < 0.5, -1, np.arange(n) // 9), "minute_of_day": np.arange(n) % 375, "fwd_ret": rng.normal(0, 1, n), "state_label": ["x"] * n, "seen_on": ["2024-01-02"] * n, "noise": rng.normal(0, 1, n)}
    df = spark.createDataFrame(pd.DataFrame(made)).withColumn("k", F.lit(1))
    got = {r.column: (r.verdict, r.reason) for r in quality.leak_screen(df, ["k"], "close", list(made)[2:], ["i"], ("fwd_ret",)).collect()}
    assert got["score"] == ("banned", "knows the future") and got["event_no"] == ("banned", "a running id") and got["seen_on"] == ("banned", "a date as text")
    assert got["fwd_ret"] == ("ok", "allowed") and got["state_label"][0] == "suspect"
    assert {got[c][0] for c in ("momentum", "minute_of_day", "noise")} == {"ok"}


def test_bars_nest_across_midnight_or_are_taken_alone(spark):
    from tidemark.operators import clocks

    rows = [(1, dt.datetime(2024, 1, 1, 23, 50) + dt.timedelta(minutes=m), float((m // 5) * 1.0), None if m % 2 else 1.0) for m in range(40)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, five double, still double")
    for periods in ((1, 5, 15), (1, 7)):
        got = {(r.column, r.period): (r.n_bars, r.constant) for r in clocks.bar_constancy(df, ["k"], ["five", "still"], periods).collect()}
        for p in periods:
            bars_ = {}
            for _, t, five, _ in rows:
                m = t.hour * 60 + t.minute
                bars_.setdefault(t - dt.timedelta(minutes=(m - 555) % p), set()).add(five)
            assert got["five", p] == (len(bars_), all(len(x) == 1 for x in bars_.values())) and got["still", p][1]


def test_changes_between_known_values_only(spark):
    from tidemark.operators import clocks

    rows = [(1, i, v) for i, v in enumerate([None, 1.0, 1.0, None, 2.0, 3.0, 3.0])]
    got = clocks.value_changes(spark.createDataFrame(rows, "k int, ts int, v double"), ["k"], ["v"]).first()
    assert (got.n_changes, got.n_rows) == (1, 7)
