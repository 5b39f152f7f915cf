"""What a book of trades and its equity curve come to: metrics, exposure, periods with their own drawdowns, and what mistakes cost.

Trades come from trades.pair_trades (and excursions, where favourable and adverse moves are asked
for), curves from trades.equity_curve with a charge. Money is points times `size`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.order import same
from tidemark.operators.scan import running
from tidemark.operators.windows import drawdown_episodes, money_drawdown, onset


def _share(n: Column, of: Column) -> Column:
    return F.try_divide(n.cast("double"), of.cast("double"))


def _profits(value: Column, name: str) -> dict[str, Column]:
    """Of a trade's result: how often and how much it won and lost."""
    win, loss = F.when(value > 0, value), F.when(value < 0, -value)
    return {
        f"n_wins{name}": F.count(win), f"n_losses{name}": F.count(loss), f"win_rate{name}": _share(F.count(win), F.count(F.lit(1))),
        f"won{name}": F.coalesce(F.sum(win), F.lit(0.0)), f"lost{name}": F.coalesce(F.sum(loss), F.lit(0.0)),
        f"profit_factor{name}": F.when(F.sum(loss) > 0, F.coalesce(F.sum(win), F.lit(0.0)) / F.sum(loss)).when(F.count(F.lit(1)) > 0, F.lit(float("inf"))),
        f"avg_win{name}": F.coalesce(F.avg(win), F.lit(0.0)), f"avg_loss{name}": F.coalesce(F.avg(loss), F.lit(0.0)), f"expectancy{name}": F.avg(value),
    }


def book_metrics(book: DataFrame, keys: list[str], size: float = 1.0, breakeven: float = 0.0) -> DataFrame:
    """A row for each key: counts, sums, rates, profit factors (infinite without losses) and averages, net and _gross; charges and how much of the
    results they take; holding times; and, if book has mfe and mae, excursions: means and extremes, capture in percent of the favourable points,
    edge ratio (infinite without adverse moves) and the percentage of trades that were ever past `breakeven`. All in one aggregation.
    """
    net, gross = F.col("net") * size, F.col("points") * size
    charge = gross - net
    minutes = (F.unix_micros(F.col("exit_ts").cast("timestamp")) - F.unix_micros(F.col("entry_ts").cast("timestamp"))) / 60_000_000
    n, won = F.count(F.lit(1)), F.sum(F.when(gross > 0, gross))
    found = {"n_trades": n, "net_pnl": F.sum(net), "gross_pnl": F.sum(gross), "total_charge": F.sum(charge), "charge_per_trade": F.avg(charge), "gross_points": F.sum("points"), "avg_points": F.avg("points")}
    found |= _profits(net, "") | _profits(gross, "_gross")
    found |= {
        "n_breakeven": n - F.count(F.when(net > 0, 1)) - F.count(F.when(net < 0, 1)), "n_forced": F.count(F.when(F.col("reason") == "end_of_data", 1)), "best": F.max(net), "worst": F.min(net),
        "charge_pct_of_gross": F.try_divide(F.sum(charge) * 100, F.abs(F.sum(gross))), "net_to_gross_pct": F.when(F.sum(gross) > 0, F.sum(net) / F.sum(gross) * 100), "charge_pct_of_gross_wins": F.when(won > 0, F.sum(charge) / won * 100),
        "avg_minutes": F.avg(minutes), "avg_bars": F.avg(F.col("exit_bar") - F.col("entry_bar")),
    }
    if {"mfe", "mae"} <= set(book.columns):
        mfe, mae = F.avg("mfe"), F.avg("mae")
        found |= {
            "avg_mfe": mfe, "avg_mae": mae, "best_mfe": F.max("mfe"), "worst_mae": F.max("mae"), "avg_mfe_money": mfe * size, "avg_mae_money": mae * size,
            "capture_pct": F.when(F.sum("mfe") > 0, F.sum("points") / F.sum("mfe") * 100), "edge_ratio": F.when(mae > 0, mfe / mae).when(mfe > 0, F.lit(float("inf"))),
            "pct_past_breakeven": F.avg((F.col("mfe") > breakeven).cast("int")) * 100,
        }
    return book.groupBy(*keys).agg(*(c.alias(k) for k, c in found.items()))


def exposure_metrics(curve: DataFrame, keys: list[str], size: float = 1.0, single: int = 1) -> DataFrame:
    """A row for each key: lots and notional at their peak and on average while in the market, the percentage of bars in it and with more than `single` lots, bars, days and years."""
    held, notional = F.when(F.col("lots") > 0, F.col("lots")), F.col("close") * F.col("lots") * size
    days = F.floor((F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))) / 86_400_000_000)
    found = {
        "n_bars": F.count(F.lit(1)), "peak_lots": F.max("lots"), "avg_lots_in_market": F.coalesce(F.avg(held), F.lit(0.0)), "pct_bars_in_market": _share(F.count(held), F.count(F.lit(1))) * 100,
        "pct_bars_multi_lot": F.avg((F.col("lots") > single).cast("int")) * 100, "peak_notional": F.max(notional), "avg_notional_in_market": F.coalesce(F.avg(F.when(notional > 0, notional)), F.lit(0.0)),
        "n_days": F.count_distinct(F.to_date("ts")), "years": F.greatest(days / 365.25, F.lit(1e-9)),
    }
    return curve.groupBy(*keys).agg(*(c.alias(k) for k, c in found.items())).withColumn("days_per_year", F.col("n_days") / F.col("years"))


def drawdown_metrics(curve: DataFrame, keys: list[str], equity: str = "net", ts: str = "ts", chunk: str | None = None) -> DataFrame:
    """A row for each key: max_drawdown and avg_drawdown (of the episodes' troughs; at most 0), n_drawdowns and pct_time_in_dd. With a chunk column no series has to fit one task."""
    down = money_drawdown(curve, keys, ts, equity, chunk).groupBy(*keys).agg(F.min("drawdown").alias("max_drawdown"), (F.avg((F.col("drawdown") < 0).cast("int")) * 100).alias("pct_time_in_dd"))
    episodes = drawdown_episodes(curve, keys, ts, equity, chunk).groupBy(*keys).agg(F.avg("trough").alias("avg_drawdown"), F.count(F.lit(1)).alias("n_drawdowns"))
    both = down.alias("a").join(episodes.alias("b"), same("a", "b", keys), "left")
    return both.select("a.*", F.coalesce("b.avg_drawdown", F.lit(0.0)).alias("avg_drawdown"), F.coalesce("b.n_drawdowns", F.lit(0)).cast("long").alias("n_drawdowns"))


def period_curves(curve: DataFrame, trades: DataFrame, keys: list[str], capital: float, period: str = "year", size: float = 1.0, ts: str = "ts") -> DataFrame:
    """A row for each key and year (or month) that the curve has: period, sessions, trades, wins, win_rate_pct, gross_pnl, charges, net_pnl, returns
    and drawdowns in money and percent of the capital.

    A period starts from the level at which the one before ended, so that its drawdown may begin on
    its first bar. Trades count where they end. Peaks are found day by day, so that no period has to fit one task.
    """
    shape = {"year": "yyyy", "month": "yyyy-MM"}[period]
    named = curve.withColumns({"period": F.date_format(ts, shape), "_day": F.to_date(ts), "_net": F.col("net") * size, "_gross": F.col("gross") * size})
    each = [*keys, "period"]
    ends = named.groupBy(*each).agg(F.max_by("_net", ts).alias("_end"), F.max_by("_gross", ts).alias("_end_gross"), F.count_distinct("_day").alias("sessions"))
    order = W.partitionBy(*keys).orderBy("period")  # a row for each period
    ends = ends.withColumns({"_from": F.coalesce(F.lag("_end").over(order), F.lit(0.0)), "_from_gross": F.coalesce(F.lag("_end_gross").over(order), F.lit(0.0))})
    high = running(named, each, "_day", [ts], {"_high": ("max", "_net")})
    placed = high.alias("a").join(ends.alias("b"), same("a", "b", each)).select("a.*", "b._from").withColumn("_high", F.greatest("_high", "_from"))
    falls = placed.groupBy(*each).agg(F.min(F.col("_net") - F.col("_high")).alias("max_dd"), (F.min((capital + F.col("_net")) / (capital + F.col("_high")) - 1) * 100).alias("max_dd_pct"))
    counts = trades.groupBy(*keys, F.date_format("exit_ts", shape).alias("period")).agg(F.count(F.lit(1)).alias("trades"), F.count(F.when(F.col("net") > 0, 1)).alias("wins"), (F.sum(F.col("points") - F.col("net")) * size).alias("charges"))
    both = ends.alias("a").join(falls.alias("b"), same("a", "b", each)).select("a.*", "b.max_dd", "b.max_dd_pct")
    both = both.alias("a").join(counts.alias("b"), same("a", "b", each), "left").select("a.*", *(F.coalesce(f"b.{c}", F.lit(0)).alias(c) for c in ("trades", "wins", "charges")))
    pnl, gross = F.col("_end") - F.col("_from"), F.col("_end_gross") - F.col("_from_gross")
    money = {"gross_pnl": gross, "net_pnl": pnl, "gross_return_pct": gross / capital * 100, "return_pct": pnl / capital * 100, "win_rate_pct": _share(F.col("wins"), F.col("trades")) * 100}
    return both.select(*each, "sessions", "trades", "wins", "charges", "max_dd", "max_dd_pct", *(c.alias(k) for k, c in money.items()))


def best_and_worst(periods: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key: positive periods, net and gross, the best and worst (ties: the first), and the mean return in percent."""
    at = lambda f, sign: f("period", F.struct(F.col("net_pnl") * sign, "period"))
    return periods.groupBy(*keys).agg(F.count(F.when(F.col("net_pnl") > 0, 1)).alias("positive"), F.count(F.when(F.col("gross_pnl") > 0, 1)).alias("positive_gross"), at(F.min_by, -1).alias("best"), at(F.min_by, 1).alias("worst"), F.avg("return_pct").alias("avg_return_pct"))


def _labelled(grid: DataFrame, keys: list[str], truth: str, signal: str, ts: str, atr: str | None, chunk: str | None) -> DataFrame:
    """Each bar that a next one follows: keys, fill_ts, truth and sig there, and, of the run of equal truths that it is in, how many bars ago it
    began (late), the price that a fill for its first bar would have had, and the atr there."""
    here = grid.withColumns({"_next": F.struct(F.col(ts).alias("ts"), F.col("open").alias("open")), "_one": F.lit(1)})
    if chunk:
        here = running(here, keys, chunk, [ts], {"_bar": ("sum", "_one")})
        here = running(here, keys, chunk, [ts], {"_ahead": ("first", "_next")}, ahead=True, inclusive=False)
    else:
        over = W.partitionBy(*keys).orderBy(ts)
        here = here.withColumns({"_bar": F.row_number().over(over), "_ahead": F.lead("_next").over(over)})
    size = F.col(atr).cast("double") if atr else F.lit(None).cast("double")
    here = here.withColumn("_at", F.struct(F.col("_bar").alias("bar"), F.coalesce("_ahead.open", "open").alias("price"), size.alias("atr")))
    began = onset(here, keys, [ts], truth, "_at", chunk).where(F.col("_ahead").isNotNull())
    return began.select(*keys, F.col("_ahead.ts").alias("fill_ts"), F.col(truth).alias("truth"), F.col(signal).alias("sig"), (F.col("_bar") - F.col("onset.bar")).alias("late"), F.col("onset.price").alias("ideal"), F.col("onset.atr").alias("atr"))


def cost_decomposition(trades: DataFrame, shadow: DataFrame, grid: DataFrame, keys: list[str], entries: list[str], exits: list[str], idle: list[str], size: float = 1.0, truth: str = "truth", signal: str = "sig", ts: str = "ts", atr: str | None = None, chunk: str | None = None) -> DataFrame:
    """A row for each version: what its mistakes cost.

    n_false, churn_cost: trades entered where the truth was idle, and their charges. n_flips,
    wrong_direction_cost: entered where the truth said exit, or left where it said enter, each trade
    once, by the size of its gross result. n_missed, missed_cost, missed_raw: trades of the shadow
    book (on the truth) where the signal was idle, with losses as 0 and as they are; shadow_trades
    and shadow_gross are all of them. n_delayed, avg_delay_bars, avg_delay_points, avg_delay_atr,
    delay_cost: trades entered on a true entry, against a fill right after its run began. total_error_cost
    sums churn, missed and wrong direction. A version without trades has zeros and null means. With
    a chunk column, whose values ascend with ts, no series has to fit one task.
    """
    at = _labelled(grid, keys, truth, signal, ts, atr, chunk)
    entered = trades.alias("a").join(at.withColumnRenamed("fill_ts", "entry_ts").alias("b"), same("a", "b", [*keys, "entry_ts"]), "left").select("a.*", F.col("b.truth").alias("_in"), "b.late", "b.ideal", "b.atr")
    left = at.select(*keys, F.col("fill_ts").alias("exit_ts"), F.col("truth").alias("_out"))
    judged = entered.alias("a").join(left.alias("b"), same("a", "b", [*keys, "exit_ts"]) & (F.col("a.reason") == "exit"), "left").select("a.*", "b._out")
    said = lambda c, names: F.coalesce(F.col(c).isin(names), F.lit(False)) if names else F.lit(False)
    false, flip, true = said("_in", idle), said("_in", exits) | said("_out", entries), said("_in", entries)
    gross, delay = F.col("points") * size, F.col("entry_price") - F.col("ideal")
    total = lambda test, value: F.coalesce(F.sum(F.when(test, value)), F.lit(0.0))
    own = judged.groupBy("version").agg(
        F.count(F.when(false, 1)).alias("n_false"), total(false, (F.col("points") - F.col("net")) * size).alias("churn_cost"), F.count(F.when(flip, 1)).alias("n_flips"), total(flip, F.abs(gross)).alias("wrong_direction_cost"),
        F.count(F.when(true & (F.col("late") > 0), 1)).alias("n_delayed"), F.avg(F.when(true, F.col("late"))).alias("avg_delay_bars"), F.avg(F.when(true, delay)).alias("avg_delay_points"), F.avg(F.when(true & (F.col("atr") > 0), delay / F.col("atr"))).alias("avg_delay_atr"), total(true, delay * size).alias("delay_cost"),
    )
    unseen = shadow.alias("a").join(at.withColumnRenamed("fill_ts", "entry_ts").alias("b"), same("a", "b", [*keys, "entry_ts"]), "left").select("a.*", "b.sig")
    missed = unseen.groupBy("version").agg(F.count(F.lit(1)).alias("shadow_trades"), F.sum(gross).alias("shadow_gross"), F.count(F.when(said("sig", idle), 1)).alias("n_missed"), total(said("sig", idle), F.greatest(gross, F.lit(0.0))).alias("missed_cost"), total(said("sig", idle), gross).alias("missed_raw"))
    both = own.join(missed, "version", "full").na.fill(0, ["n_false", "n_flips", "n_delayed", "shadow_trades", "n_missed"]).na.fill(0.0, ["churn_cost", "wrong_direction_cost", "delay_cost", "shadow_gross", "missed_cost", "missed_raw"])
    return both.withColumn("total_error_cost", F.col("churn_cost") + F.col("missed_cost") + F.col("wrong_direction_cost"))
