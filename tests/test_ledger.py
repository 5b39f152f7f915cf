"""Books, curves, periods and costs of mistakes against a loop over the bars."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger, trades, windows

T0 = dt.datetime(2022, 11, 1, 9)
IN, OUT, IDLE = "buy", "sell", "wait"


@pytest.fixture(scope="module")
def world():
    """Bars of two series over three calendar years, with runs of truths, signals that come late or wrong, and gaps."""
    rng, rows = random.Random(12), []
    for key in ("a", "b"):
        price, truth, left = 100.0, IDLE, 0
        for k in range(240):
            if not left:
                truth, left = rng.choice([IN, OUT, IDLE, None]), rng.randrange(1, 6)
            left -= 1
            o = round(price + rng.gauss(0, 1), 2)
            price = max(20.0, round(o + rng.gauss(0, 2), 2))
            rows.append((key, T0 + dt.timedelta(days=2 * k, hours=k % 3), o, max(o, price) + 1.0, min(o, price) - 1.0, price, rng.choice([truth, truth, rng.choice([IN, OUT, IDLE]), None]), truth))
    return rows


@pytest.fixture(scope="module")
def grid(spark, world):
    df = spark.createDataFrame(world, "k string, ts timestamp_ntz, open double, high double, low double, close double, sig string, truth string").repartition(3)
    return windows.wilder_atr(df.withColumn("month", F.date_trunc("month", "ts").cast("timestamp_ntz")), ["k"], "ts", chunk="month").drop("tr").cache()


@pytest.fixture(scope="module")
def books(spark, grid):
    strategies = trades.strategies(spark, [("V", IN, [OUT])])
    made = [trades.pair_trades(trades.bar_events(grid, ["k"], strategies, c), ["k"], 0.5).cache() for c in ("sig", "truth")]
    return strategies, *made


def pairs_by_hand(bars, column):
    """(signal bar, exit's signal bar or None) of each entry."""
    fired, last = [], None
    for i, b in enumerate(bars):
        if b[column] is not None and b[column] != last:
            fired.append(i)
            last = b[column]
    found = []
    for i in fired:
        if bars[i][column] == IN and i + 1 < len(bars):
            found.append((i, next((j for j in fired if j > i and bars[j][column] == OUT and j + 1 < len(bars)), None)))
    return found


def result(bars, i, j):
    return (bars[j + 1]["open"] if j is not None else bars[-1]["close"]) - bars[i + 1]["open"]


@pytest.mark.parametrize("chunk", [None, "month"])
def test_mistakes_cost_what_a_loop_says(grid, books, chunk):
    _, own, shadow = books
    got = ledger.cost_decomposition(own, shadow, grid, ["k"], [IN], [OUT], [IDLE], 10.0, atr="atr", chunk=chunk).collect()
    assert len(got) == 1
    want = dict.fromkeys("n_false churn_cost n_flips wrong_direction_cost n_missed missed_cost missed_raw shadow_trades shadow_gross n_delayed delay_cost".split(), 0.0)
    bars_late, points, atrs = [], [], []
    for key in "ab":
        bars = [r.asDict() for r in grid.where(F.col("k") == key).orderBy("ts").collect()]
        onset = []
        for i, b in enumerate(bars):
            onset.append(onset[-1] if i and b["truth"] == bars[i - 1]["truth"] else i)
        for i, j in pairs_by_hand(bars, "sig"):
            gross = result(bars, i, j)
            want["n_false"] += bars[i]["truth"] == IDLE
            want["churn_cost"] += 5.0 * (bars[i]["truth"] == IDLE)
            flip = bars[i]["truth"] == OUT or (j is not None and bars[j]["truth"] == IN)
            want["n_flips"] += flip
            want["wrong_direction_cost"] += flip * abs(gross) * 10
            if bars[i]["truth"] == IN:
                k0 = onset[i]
                d = bars[i + 1]["open"] - bars[min(k0 + 1, len(bars) - 1)]["open"]
                bars_late.append(i - k0)
                points.append(d)
                want["n_delayed"] += i > k0
                want["delay_cost"] += d * 10
                if bars[k0]["atr"]:
                    atrs.append(d / bars[k0]["atr"])
        for i, j in pairs_by_hand(bars, "truth"):
            gross = result(bars, i, j) * 10
            want["shadow_trades"] += 1
            want["shadow_gross"] += gross
            if bars[i]["sig"] == IDLE:
                want["n_missed"] += 1
                want["missed_cost"] += max(gross, 0.0)
                want["missed_raw"] += gross
    assert min(want["n_false"], want["n_flips"], want["n_missed"], want["n_delayed"]) > 0
    for name, value in want.items():
        assert got[0][name] == pytest.approx(value), name
    for name, values in (("avg_delay_bars", bars_late), ("avg_delay_points", points), ("avg_delay_atr", atrs)):
        assert got[0][name] == pytest.approx(sum(values) / len(values)), name
    assert got[0].total_error_cost == pytest.approx(want["churn_cost"] + want["missed_cost"] + want["wrong_direction_cost"])


def test_no_trades_cost_nothing(grid, books):
    _, own, shadow = books
    assert ledger.cost_decomposition(own.limit(0), shadow.limit(0), grid, ["k"], [IN], [OUT], [IDLE]).count() == 0
    r = ledger.cost_decomposition(own.limit(0), shadow, grid, ["k"], [IN], [OUT], []).first()
    assert (r.n_false, r.churn_cost, r.n_missed, r.avg_delay_bars) == (0, 0.0, 0, None) and r.shadow_trades > 0


def test_years_start_where_the_one_before_ended(spark, grid, books):
    strategies, own, _ = books
    curve = trades.equity_curve(grid.select("k", "ts", "close", "month"), own, ["k"], strategies, chunk="month", charge=0.5).cache()
    plain = trades.equity_curve(grid.select("k", "ts", "close"), own, ["k"], strategies, charge=0.5)
    rows = lambda df: sorted((r.k, r.ts, r.lots, round(r.gross, 6), round(r.net, 6)) for r in df.collect())
    assert rows(curve) == rows(plain)
    got = {(r.k, r.period): r for r in ledger.period_curves(curve, own, ["k", "version"], 500.0, size=2.0).collect()}
    assert {p for _, p in got} == {"2022", "2023", "2024"}
    booked = own.collect()
    for key in "ab":
        before = before_gross = 0.0
        for year in ("2022", "2023", "2024"):
            own_rows = [r for r in sorted(curve.where(F.col("k") == key).collect(), key=lambda r: r.ts) if str(r.ts.year) == year]
            peak = before
            falls, shares = [], []
            for r in own_rows:
                peak = max(peak, 2 * r.net)
                falls.append(2 * r.net - peak)
                shares.append(((500 + 2 * r.net) / (500 + peak) - 1) * 100)
            closed = [t for t in booked if t.k == key and str(t.exit_ts.year) == year]
            r, end, end_gross = got[key, year], 2 * own_rows[-1].net, 2 * own_rows[-1].gross
            assert (r.sessions, r.trades, r.wins) == (len({x.ts.date() for x in own_rows}), len(closed), sum(t.net > 0 for t in closed))
            for name, value in (("net_pnl", end - before), ("gross_pnl", end_gross - before_gross), ("max_dd", min(falls)), ("max_dd_pct", min(shares)), ("charges", len(closed) * 1.0), ("return_pct", (end - before) / 5)):
                assert r[name] == pytest.approx(value, abs=1e-9), name
            before, before_gross = end, end_gross
    best = {r.k: r for r in ledger.best_and_worst(ledger.period_curves(curve, own, ["k", "version"], 500.0), ["k"]).collect()}
    for key in "ab":
        years = {p: got[key, p].net_pnl for k, p in got if k == key}
        assert best[key].best == max(sorted(years), key=years.get) and best[key].worst == min(sorted(years), key=years.get) and best[key].positive == sum(v > 0 for v in years.values())


def test_metrics_of_a_book(spark, grid, books):
    _, own, _ = books
    book = trades.excursions(own, grid, ["k"])
    m, rows = ledger.book_metrics(book, ["k"], 10.0, 1.0), book.collect()
    for r in m.collect():
        mine = [t for t in rows if t.k == r.k]
        wins, losses = [t.points * 10 for t in mine if t.points > 0], [-t.points * 10 for t in mine if t.points < 0]
        assert (r.n_trades, r.n_wins_gross, r.n_losses_gross) == (len(mine), len(wins), len(losses))
        assert r.profit_factor_gross == pytest.approx(sum(wins) / sum(losses)) and r.total_charge == pytest.approx(5.0 * len(mine)) and r.expectancy == pytest.approx(sum(t.net for t in mine) * 10 / len(mine))
        assert r.capture_pct == pytest.approx(sum(t.points for t in mine) / sum(t.mfe for t in mine) * 100) and r.edge_ratio == pytest.approx(sum(t.mfe for t in mine) / sum(t.mae for t in mine))
        assert r.pct_past_breakeven == pytest.approx(100 * sum(t.mfe > 1 for t in mine) / len(mine)) and r.avg_bars == pytest.approx(sum(t.exit_bar - t.entry_bar for t in mine if t.exit_bar) / sum(t.exit_bar is not None for t in mine))
    only = book.where("points > 0").limit(1).withColumn("net", F.lit(0.0))
    r = ledger.book_metrics(only, ["k"]).first()
    assert r.profit_factor_gross == float("inf") and r.n_breakeven == 1 and r.lost_gross == 0.0
    assert ledger.book_metrics(own.limit(0), ["k"]).count() == 0 and "avg_mfe" not in ledger.book_metrics(own, ["k"]).columns
