"""From signals to trades, without a loop: fires, fills at the next open, exits found by looking ahead, equity, costs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.scan import running
from tidemark.operators.windows import fires, wilder_atr  # noqa: F401


def strategies(spark, rows: list[tuple[str, str, list[str]]]) -> DataFrame:
    """(version, entry, exits) of (version, entry class, exit classes); a local table, whose size Spark knows."""
    version, entry, exits = map(list, zip(*rows, strict=True)) if rows else ([], [], [])
    return spark.createDataFrame(pa.table({"version": pa.array(version, pa.string()), "entry": pa.array(entry, pa.string()), "exits": pa.array(exits, pa.list_(pa.string()))}))


def dense_grid(bars: DataFrame, signals: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Bars within each series' signal span, with sig where there is one; is_gap marks the rest. Signals are unique in (keys, ts)."""
    span = signals.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    inside = bars.join(span, keys).where(F.col(ts).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    return inside.join(signals, [*keys, ts], "left").withColumn("is_gap", F.col("sig").isNull())


def grid_report(grid: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """(keys, n_bars, n_matched, coverage, first_missing): how much of the grid has signals."""
    return grid.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bars"), F.count("sig").alias("n_matched"), F.round(F.avg((~F.col("is_gap")).cast("int")), 6).alias("coverage"), F.min(F.when(F.col("is_gap"), F.col(ts))).alias("first_missing"))


def bar_events(grid: DataFrame, keys: list[str], versions: DataFrame, signal: str = "sig", ts: str = "ts", chunk: str | None = None) -> DataFrame:
    """The grid for each version, with what the bar's fire does: is_entry, is_exit, and the fill at the next bar's open.

    A fire on a series' last bar is never filled. With a chunk column, series are numbered and
    looked ahead in two levels, so that none has to fit one task.
    """
    if chunk:
        fired = fires(grid, keys, [ts], signal, chunk)
        counted = running(fired.withColumn("_one", F.lit(1)), keys, chunk, [ts], {"bar": ("sum", "_one")}).withColumn("bar", F.col("bar").cast("int"))
        ahead = running(counted.withColumn("_next", F.struct(F.col(ts).alias("ts"), F.col("open").alias("open"))), keys, chunk, [ts], {"_fill": ("first", "_next")}, ahead=True, inclusive=False)
        ends = grid.groupBy(*keys).agg(F.max_by("close", ts).alias("last_close"), F.max(ts).alias("last_ts"))
        placed = ahead.join(ends, keys).withColumns({"fill_ts": F.col("_fill.ts"), "fill_price": F.col("_fill.open")}).drop("_one", "_next", "_fill")
    else:
        over = W.partitionBy(*keys).orderBy(ts)
        fired = fires(grid, keys, [ts], signal)
        placed = fired.withColumns({"bar": F.row_number().over(over), "fill_ts": F.lead(ts).over(over), "fill_price": F.lead("open").over(over), "last_close": F.last("close").over(over.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), "last_ts": F.max(ts).over(W.partitionBy(*keys))})
    each = placed.crossJoin(versions)  # a handful of versions, made on the driver, so that Spark knows their size
    filled = F.col("fire") & F.col("fill_ts").isNotNull()
    return each.withColumns({"is_entry": filled & (F.col(signal) == F.col("entry")), "is_exit": filled & F.array_contains("exits", F.col(signal))})


def pair_trades(events: DataFrame, keys: list[str], charge: float = 0.0, ts: str = "ts", chunk: str | None = None) -> DataFrame:
    """A row for each entry: it closes at the first later exit of its version, or at the series' last close.

    Columns: keys, version, entry_bar, entry_ts, entry_price, exit_bar, exit_ts, exit_price, reason, points, net.
    With a chunk column (a session, say) exits are looked for in two levels, so no series has to fit one task.
    """
    exit_ = F.when(F.col("is_exit"), F.struct("bar", "fill_ts", "fill_price"))
    if chunk:
        seen = running(events.withColumn("_own", exit_), [*keys, "version"], chunk, [ts], {"_exit": ("first", "_own")}, ahead=True, inclusive=False)
    else:
        ahead = W.partitionBy(*keys, "version").orderBy(ts).rowsBetween(1, W.unboundedFollowing)
        seen = events.withColumn("_exit", F.first(exit_, ignorenulls=True).over(ahead))
    seen = seen.where("is_entry")
    closed = F.col("_exit").isNotNull()
    trades = seen.select(*keys, "version", (F.col("bar") + 1).alias("entry_bar"), F.col("fill_ts").alias("entry_ts"), F.col("fill_price").alias("entry_price"), (F.col("_exit.bar") + 1).alias("exit_bar"), F.when(closed, F.col("_exit.fill_ts")).otherwise(F.col("last_ts")).alias("exit_ts"), F.when(closed, F.col("_exit.fill_price")).otherwise(F.col("last_close")).alias("exit_price"), F.when(closed, "exit").otherwise("end_of_data").alias("reason"))
    points = F.col("exit_price") - F.col("entry_price")
    return trades.withColumns({"points": points, "net": points - charge})


def excursions(trades: DataFrame, bars: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """trades with mfe and mae over the bars held and the exit's fill, both at least 0.

    Whole days in between are joined as one row each; only the first and the last day's bars are looked at singly.
    """
    day = F.to_date(F.col(ts))
    daily = bars.groupBy(*keys, day.alias("_day")).agg(F.max("high").alias("_hi"), F.min("low").alias("_lo"))
    trade = [*keys, "version", "entry_bar"]  # one trade for each entry
    spans = trades.withColumns({"_from": F.to_date("entry_ts"), "_to": F.to_date("exit_ts")})
    spans = spans.select("*", F.explode(F.sequence("_from", "_to")).alias("_day"))
    edge = (F.col("_day") == F.col("_from")) | (F.col("_day") == F.col("_to"))
    inner = spans.where(~edge).join(daily, [*keys, "_day"]).select(*trade, "_hi", "_lo")
    single = bars.select(*keys, day.alias("_day"), F.col(ts).alias("_ts"), "high", "low")
    outer = spans.where(edge).join(single, [*keys, "_day"]).where((F.col("_ts") >= F.col("entry_ts")) & ((F.col("_ts") < F.col("exit_ts")) | ((F.col("reason") == "end_of_data") & (F.col("_ts") <= F.col("exit_ts")))))
    reach = inner.unionByName(outer.select(*trade, F.col("high").alias("_hi"), F.col("low").alias("_lo"))).groupBy(*trade).agg(F.max("_hi").alias("_hi"), F.min("_lo").alias("_lo"))
    own = spans.where("_day = _from").drop("_day", "_from", "_to").join(reach, trade, "left")
    high, low = F.greatest("_hi", "exit_price"), F.least("_lo", "exit_price")
    return own.withColumns({"mfe": F.greatest(high - F.col("entry_price"), F.lit(0.0)), "mae": F.greatest(F.col("entry_price") - low, F.lit(0.0))}).drop("_hi", "_lo")


def equity_curve(bars: DataFrame, trades: DataFrame, keys: list[str], versions: DataFrame, ts: str = "ts", chunk: str | None = None, charge: float | None = None) -> DataFrame:
    """(keys, version, ts, lots, gross): after each bar, open trades at its close and closed ones at their fills; for each of the strategies that trades.

    With a charge for each trade, due when it closes, also close and net. With a chunk column of
    bars, whose values ascend with ts, no series has to fit one task; it stays as a column.
    """
    versions = versions.select("version").join(trades.select("version").distinct(), "version", "left_semi")
    opened = trades.groupBy(*keys, "version", F.col("entry_ts").alias(ts)).agg(F.count(F.lit(1)).alias("_in"), F.sum("entry_price").alias("_paid"))
    closed = trades.groupBy(*keys, "version", F.col("exit_ts").alias(ts)).agg(F.count(F.lit(1)).alias("_out"), F.sum("exit_price").alias("_got"))
    rows = bars.crossJoin(versions).join(opened, [*keys, "version", ts], "left").join(closed, [*keys, "version", ts], "left").na.fill(0, ["_in", "_out"]).na.fill(0.0, ["_paid", "_got"])
    rows = rows.withColumns({"_more": F.col("_in") - F.col("_out"), "_cash": F.col("_got") - F.col("_paid")})
    sums = {"lots": "_more", "_flow": "_cash", "_done": "_out"}
    if chunk:
        rows = running(rows, [*keys, "version"], chunk, [ts], {n: ("sum", c) for n, c in sums.items()})
    else:
        over = W.partitionBy(*keys, "version").orderBy(ts).rowsBetween(W.unboundedPreceding, 0)
        rows = rows.withColumns({n: F.sum(c).over(over) for n, c in sums.items()})
    gross = F.col("close") * F.col("lots") + F.col("_flow")
    more = [] if charge is None else [F.col("close"), (gross - F.col("_done") * charge).alias("net")]
    return rows.select(*keys, "version", ts, "lots", gross.alias("gross"), *more, *([chunk] if chunk else []))


def tradebook(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Derived columns: holding minutes, capture of the favourable excursion, whether net of charges it paid, running net."""
    held = (F.unix_seconds(F.col("exit_ts").cast("timestamp")) - F.unix_seconds(F.col("entry_ts").cast("timestamp"))) / 60
    over = W.partitionBy(*keys, "version").orderBy("entry_ts", "exit_ts").rowsBetween(W.unboundedPreceding, 0)
    return trades.withColumns({"minutes": held, "capture": F.try_divide(F.col("points"), F.when(F.col("mfe") > 0, F.col("mfe"))), "paid": F.col("net") > 0, "cum_net": F.sum("net").over(over)})


def core_metrics(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, win rate, sums, averages, profit factor (infinite without losses), expectancy and best and worst trade."""
    win, loss = F.when(F.col("net") > 0, F.col("net")), F.when(F.col("net") < 0, F.col("net"))
    m = trades.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_trades"), F.count(win).alias("n_wins"), F.count(loss).alias("n_losses"), F.sum("points").alias("gross"), F.sum("net").alias("net"), F.coalesce(F.sum(win), F.lit(0.0)).alias("won"), F.coalesce(F.sum(loss), F.lit(0.0)).alias("lost"), F.avg(win).alias("avg_win"), F.avg(loss).alias("avg_loss"), F.max("net").alias("best"), F.min("net").alias("worst"), F.count(F.when(F.col("reason") == "end_of_data", 1)).alias("n_forced"))
    factor = F.when(F.col("lost") < 0, F.col("won") / -F.col("lost")).when(F.col("won") > 0, F.lit(float("inf")))
    return m.withColumns({"win_rate": F.col("n_wins") / F.col("n_trades"), "expectancy": F.col("net") / F.col("n_trades"), "profit_factor": factor})


def capital_metrics(daily: DataFrame, keys: list[str], capital: float, order: str = "day", level: str = "equity", periods: int = 252) -> DataFrame:
    """Return, largest fall in percent, Sharpe (sample deviation) and Sortino (root mean square of falls over all days)."""
    value = F.lit(float(capital)) + F.col(level)
    over = W.partitionBy(*keys).orderBy(order)
    before = F.coalesce(F.lag(value).over(over), F.lit(float(capital)))
    peak = F.greatest(F.max(value).over(over.rowsBetween(W.unboundedPreceding, 0)), F.lit(float(capital)))
    x = daily.withColumns({"_r": value / before - 1, "_fall": value / peak - 1, "_v": value})
    m = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days"), (F.max_by("_v", order) / capital - 1).alias("total_return"), F.min("_fall").alias("worst_fall"), F.avg("_r").alias("_mean"), F.stddev_samp("_r").alias("_sd"), F.sqrt(F.avg(F.pow(F.least("_r", F.lit(0.0)), 2))).alias("_down"))
    scale = periods**0.5
    return m.withColumns({"sharpe": F.try_divide(F.col("_mean"), F.col("_sd")) * scale, "sortino": F.try_divide(F.col("_mean"), F.col("_down")) * scale}).drop("_mean", "_sd", "_down")


def daily_levels(curve: DataFrame, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    """(keys, day, value): the level after each day's last row."""
    return curve.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.max_by(value, ts).alias(value))


def period_stats(trades: DataFrame, keys: list[str], period: str) -> DataFrame:
    """(keys, period, n_trades, n_wins, net) by the exit's year or month."""
    name = F.date_format("exit_ts", {"year": "yyyy", "month": "yyyy-MM"}[period])
    return trades.groupBy(*keys, name.alias("period")).agg(F.count(F.lit(1)).alias("n_trades"), F.count(F.when(F.col("net") > 0, 1)).alias("n_wins"), F.sum("net").alias("net"))


def month_grid(trades: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each year with always twelve columns, m1 to m12."""
    named = trades.select(*keys, F.year("exit_ts").alias("year"), F.concat(F.lit("m"), F.month("exit_ts")).alias("m"), "net")
    return named.groupBy(*keys, "year").pivot("m", [f"m{k}" for k in range(1, 13)]).agg(F.sum("net"))


def churn(grid: DataFrame, keys: list[str], signal: str = "sig", ts: str = "ts") -> DataFrame:
    """(keys, n_known, n_changes): known bars whose signal differs from the known one before."""
    before = F.last(signal, ignorenulls=True).over(W.partitionBy(*keys).orderBy(ts).rowsBetween(W.unboundedPreceding, -1))
    x = grid.select(*keys, F.col(signal).alias("_s"), before.alias("_b"))
    return x.groupBy(*keys).agg(F.count("_s").alias("n_known"), F.count(F.when(F.col("_s") != F.col("_b"), 1)).alias("n_changes"))


def missed_trades(shadow: DataFrame, trades: DataFrame, keys: list[str]) -> DataFrame:
    """Shadow trades (on the truth) whose entry the real book lacks, and what each was worth, floored at 0 and raw."""
    taken = trades.select(*keys, "version", "entry_ts").distinct()
    return shadow.join(taken, [*keys, "version", "entry_ts"], "left_anti").withColumns({"missed": F.greatest(F.col("net"), F.lit(0.0)), "missed_raw": F.col("net")})


def error_costs(trades: DataFrame, shadow: DataFrame, grid: DataFrame, keys: list[str], truth: str = "truth", ts: str = "ts") -> DataFrame:
    """(keys, version): what mistakes cost: entries and exits on bars of other truth (once each), missed trades, and charges."""
    at = grid.select(*keys, F.lead(ts).over(W.partitionBy(*keys).orderBy(ts)).alias("entry_ts"), F.col(truth).alias("_truth"), F.col("sig").alias("_sig"))
    judged = trades.join(at.where("entry_ts is not null"), [*keys, "entry_ts"], "left")
    wrong = judged.groupBy(*keys, "version").agg(F.count(F.when(F.col("_truth") != F.col("_sig"), 1)).alias("n_wrong_entries"), F.coalesce(-F.sum(F.when(F.col("_truth") != F.col("_sig"), F.least("net", F.lit(0.0)))), F.lit(0.0)).alias("wrong_cost"), F.sum(F.col("points") - F.col("net")).alias("charges"))
    missed = missed_trades(shadow, trades, keys).groupBy(*keys, "version").agg(F.count(F.lit(1)).alias("n_missed"), F.sum("missed").alias("missed_cost"), F.sum("missed_raw").alias("missed_raw"))
    return wrong.join(missed, [*keys, "version"], "full")


def unknown_signals(signals: DataFrame, versions: DataFrame, idle: list[str]) -> DataFrame:
    """(sig): signals that no version uses and that aren't idle."""
    used = versions.select(F.explode(F.array_append("exits", F.col("entry"))).alias("sig")).distinct()
    return signals.select("sig").where(F.col("sig").isNotNull() & ~F.col("sig").isin(*idle)).distinct().join(used, "sig", "left_anti")
