"""Ordered analytics over entity series: runs, streaks, drawdowns, normalisers, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.order import average_ranks, same
from tidemark.operators.scan import affine, run_starts, running, runs


def fires(df: DataFrame, keys: list[str], order: list[str], signal: str, chunk: str | None = None) -> DataFrame:
    """df with fire: the first known row of each run of a signal. A null signal is a gap: it neither fires nor ends a run."""
    if chunk:
        seen = running(df, keys, chunk, order, {"_before": ("last", signal)}, inclusive=False)
    else:
        seen = df.withColumn("_before", F.last(signal, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)))
    return seen.withColumn("fire", F.col(signal).isNotNull() & ~F.col(signal).eqNullSafe(F.col("_before"))).drop("_before")


def onset(df: DataFrame, keys: list[str], order: list[str], value: str, place: str, chunk: str | None = None) -> DataFrame:
    """df with onset: `place` of the first row of the run of equal values that each row is in. With a chunk column no series has to fit one task."""
    if chunk:
        return run_starts(df, keys, chunk, order, value, place, "onset")
    over = W.partitionBy(*keys).orderBy(*order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(over)) | (F.row_number().over(over) == 1)
    return df.withColumn("_start", F.when(changed, F.col(place))).withColumn("onset", F.last("_start", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, 0))).drop("_start")


def losing_streaks(df: DataFrame, keys: list[str], order: str, wrong: str, chunk: str | None = None) -> DataFrame:
    """(keys, length, first, last, place): runs of rows where wrong is true, the longest first (ties: the earliest).

    A null ends a run. With a chunk column, whose values ascend with the order, no series has to fit one task.
    """
    if chunk:
        found = runs(df, keys, chunk, order, wrong).where(F.col(wrong)).withColumn("_rank", F.struct((-F.col("length")).alias("length"), F.col(chunk).alias("chunk")))
        placed = running(found, keys, "_rank", ["first"], {"place": ("count", "length")})
        return placed.select(*keys, "length", "first", "last", F.col("place").cast("int").alias("place"))
    over = W.partitionBy(*keys).orderBy(order)
    numbered = df.withColumn("_island", F.row_number().over(over) - F.sum(F.col(wrong).cast("int")).over(over))
    found = numbered.where(F.col(wrong)).groupBy(*keys, "_island").agg(F.count(F.lit(1)).alias("length"), F.min(order).alias("first"), F.max(order).alias("last")).drop("_island")
    return found.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("length"), "first")))


def score_drawdowns(df: DataFrame, keys: list[str], order: str, wrong: str, chunk: str | None = None) -> DataFrame:
    """(keys, depth, first, last, recovered): falls of the score (+1 right, -1 wrong) below its running peak.

    The peak starts at 0. An episode lasts while the peak stays what it was and closes only when
    the score exceeds it; the last of a series may be open (recovered false), so its depth is a floor.
    With a chunk column (a session, say) no series has to fit one task.
    """
    stepped = df.withColumn("_step", F.when(F.col(wrong), -1).otherwise(1))
    scored = _running(stepped, keys, order, "_score", "sum", "_step", chunk)
    peaked = _running(scored, keys, order, "_high", "max", "_score", chunk).withColumn("_peak", F.greatest("_high", F.lit(0)))
    tops = peaked.groupBy(*keys).agg(F.max("_score").alias("_top"))
    under = peaked.where("_score < _peak").groupBy(*keys, "_peak").agg(F.max(F.col("_peak") - F.col("_score")).alias("depth"), F.min(order).alias("first"), F.max(order).alias("last"))
    return under.join(tops, keys).withColumn("recovered", F.col("_top") > F.col("_peak")).drop("_peak", "_top")


def _running(df: DataFrame, keys: list[str], order: str, name: str, kind: str, column: str, chunk: str | None) -> DataFrame:
    if chunk:
        return running(df, keys, chunk, [order], {name: (kind, column)})
    over = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, {"sum": F.sum, "max": F.max}[kind](column).over(over))


def money_drawdown(df: DataFrame, keys: list[str], order: str, equity: str, chunk: str | None = None) -> DataFrame:
    """df with peak and drawdown of equity; the peak starts at 0. With a chunk column no series has to fit one task."""
    high = _running(df, keys, order, "peak", "max", equity, chunk).withColumn("peak", F.greatest("peak", F.lit(0.0)))
    return high.withColumn("drawdown", F.col(equity) - F.col("peak"))


def drawdown_episodes(df: DataFrame, keys: list[str], order: str, equity: str, chunk: str | None = None) -> DataFrame:
    """(keys, episode, trough, first, last, n_rows): maximal runs of rows below the peak. With a chunk column no series has to fit one task."""
    down = money_drawdown(df, keys, order, equity, chunk).withColumn("_up", F.when(F.col("drawdown") < 0, 0).otherwise(1))
    numbered = _running(down, keys, order, "episode", "sum", "_up", chunk).where("drawdown < 0")
    return numbered.groupBy(*keys, "episode").agg(F.min("drawdown").alias("trough"), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n_rows"))


def cell_streams(df: DataFrame, pairs: DataFrame, true: str, pred: str) -> DataFrame:
    """Rows of each (t, p) cell's stream with wrong: the true class's rows; for a mistake only those predicted t or p."""
    joined = df.join(pairs, F.col(true) == F.col("t"))
    kept = joined.where((F.col("t") == F.col("p")) | (F.col(pred) == F.col("t")) | (F.col(pred) == F.col("p")))
    return kept.withColumn("wrong", F.col(pred) != F.col("t"))


def support_table(cells: DataFrame, order: str, chunk: str) -> DataFrame:
    """A row for each (t, p) cell: n, n_wrong, rate, final_score, n_streaks, longest, n_drawdowns, deepest, recovered.

    cells come from cell_streams. A cell's score (+1 right, -1 wrong), its runs of mistakes and its
    falls are taken chunk by chunk and joined, so a cell that holds half of all rows isn't one task.
    recovered tells whether the deepest fall (ties: the first) was made good; null if there is none.
    """
    keys = ["t", "p"]
    scored = _running(cells.withColumn("_step", F.when(F.col("wrong"), -1).otherwise(1)), keys, order, "_s", "sum", "_step", chunk)
    base = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("wrong"), 1)).alias("n_wrong"), F.round(F.avg(F.col("wrong").cast("int")), 6).alias("rate"), F.max_by("_s", order).alias("final_score"))
    streaks = runs(cells, keys, chunk, order, "wrong").where("wrong").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_streaks"), F.max("length").alias("longest"))
    falls = score_drawdowns(cells, keys, order, "wrong", chunk)
    falls = falls.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_drawdowns"), F.max("depth").alias("deepest"), F.min_by("recovered", F.struct(-F.col("depth"), "first")).alias("recovered"))
    return base.join(streaks, keys, "left").join(falls, keys, "left").na.fill(0, ["n_streaks", "longest", "n_drawdowns", "deepest"])


def returns(df: DataFrame, keys: list[str], order: list[str], price: str, horizons: tuple[int, ...]) -> DataFrame:
    """df with fwd_h and past_h, relative changes over h rows ahead and behind."""
    over = W.partitionBy(*keys).orderBy(*order)
    p = F.col(price)
    return df.withColumns({f"fwd_{h}": F.try_divide(F.lead(price, h).over(over), p) - 1 for h in horizons} | {f"past_{h}": F.try_divide(p, F.lag(price, h).over(over)) - 1 for h in horizons})


def _before(df: DataFrame, keys: list[str], order: list[str], column: str, name: str, chunk: str | None) -> DataFrame:
    """df with the column's value in the row before, which may be null."""
    if not chunk:
        return df.withColumn(name, F.lag(column).over(W.partitionBy(*keys).orderBy(*order)))
    boxed = df.withColumn("_box", F.struct(F.col(column).alias("x")))
    return running(boxed, keys, chunk, order, {name: ("last", "_box")}, inclusive=False).withColumn(name, F.col(f"{name}.x")).drop("_box")


def normalised(df: DataFrame, keys: list[str], order: list[str], column: str, chunk: str | None = None) -> DataFrame:
    """df with z (population deviation), minmax (0 if constant), change (infinite: null), first100 (base > 0) and rank100 (average ranks).

    What holds for a whole series is aggregated and joined, ranks come from value ranges; only the
    row before is looked up in order, chunk by chunk if there is a chunk column.
    """
    x, at = F.col(column), F.struct(*order)
    facts = df.groupBy(*keys).agg(F.avg(x).alias("_avg"), F.stddev_pop(x).alias("_dev"), F.min(x).alias("_low"), F.max(x).alias("_high"), F.min_by(F.when(x.isNotNull(), x), F.when(x.isNotNull(), at)).alias("_base"))
    ranked = average_ranks(_before(df, keys, order, column, "_prev", chunk), keys, column, "_rank")
    both = ranked.alias("a").join(facts.alias("b"), same("a", "b", keys)).select("a.*", "b._avg", "b._dev", "b._low", "b._high", "b._base")
    found = {
        "z": F.try_divide(x - F.col("_avg"), F.col("_dev")),
        "minmax": F.when(x.isNotNull(), F.coalesce(F.try_divide(x - F.col("_low"), F.col("_high") - F.col("_low")), F.lit(0.0))),
        "change": F.try_divide(x, F.col("_prev")) - 1,
        "first100": F.when(F.col("_base") > 0, x / F.col("_base") * 100),
        "rank100": F.col("_rank") / F.col("_rank_of") * 100,
    }
    return both.withColumns(found).select(*df.columns, *found)


def true_range(df: DataFrame, keys: list[str], order: str, chunk: str | None = None) -> DataFrame:
    """df with tr; before the first row its own close counts as the previous one."""
    before = F.coalesce("_prev", "close")
    ranged = _before(df, keys, [order], "close", "_prev", chunk)
    return ranged.withColumn("tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))).drop("_prev")


def wilder_atr(df: DataFrame, keys: list[str], order: str, n: int = 14, chunk: str | None = None) -> DataFrame:
    """df with tr and atr: the mean of the first n true ranges at row n, then (atr * (n - 1) + tr) / n; null before.

    The recurrence is a chain of affine maps, the first of which forgets what was before it (see
    scan.affine). With a chunk column, whose values ascend with the order, no series has to fit one task.
    """
    ranged = true_range(df, keys, order, chunk).withColumn("_one", F.lit(1))
    counted = _running(ranged, keys, order, "_i", "sum", "_one", chunk).withColumn("_i", F.col("_i") - n)  # 0 at the seed
    seeds = counted.where("_i <= 0").groupBy(*keys).agg(F.avg("tr").alias("_seed"))
    maps = counted.where("_i >= 0").alias("a").join(seeds.alias("b"), same("a", "b", keys)).select("a.*", "b._seed")
    maps = maps.withColumns({"_a": F.when(F.col("_i") == 0, 0.0).otherwise((n - 1) / n), "_b": F.when(F.col("_i") == 0, F.col("_seed")).otherwise(F.col("tr") / n)})
    reached = affine(maps, keys, "_i", "_a", "_b", "atr")
    return counted.alias("a").join(reached.alias("b"), same("a", "b", [*keys, "_i"]), "left").select(*(F.col(f"a.`{c}`") for c in df.columns), "a.tr", "b.atr")


def keep_one(df: DataFrame, keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """The last (or first) row of each key."""
    by = [F.desc(c) if last else F.asc(c) for c in order]
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")


def sessions(df: DataFrame, ts: str = "ts") -> DataFrame:
    """(session, day): the calendar days that the data has, numbered from 0."""
    return df.select(F.to_date(ts).alias("day")).where("day is not null").distinct().select((F.row_number().over(W.orderBy("day")) - 1).alias("session"), "day")


def top_texts(df: DataFrame, keys: list[str], order: list[Column], text: Column, k: int, name: str) -> DataFrame:
    """(keys, name_1 ... name_k): the texts of each key's first k rows."""
    ranked = df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k)
    return ranked.groupBy(*keys).agg(*(F.max(F.when(F.col("_n") == i, text)).alias(f"{name}_{i}") for i in range(1, k + 1)))


def thin(df: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """At most about `most` rows of each key, evenly spaced, the last always among them."""
    over = W.partitionBy(*keys).orderBy(*order)
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    step = F.greatest(F.lit(1), F.ceil(n / most))
    placed = df.withColumns({"_i": F.row_number().over(over) - 1, "_n": n, "_step": step})
    return placed.where("_i % _step = 0 or _i = _n - 1").drop("_i", "_n", "_step")


def evenly_spaced(df: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """Rows at the `most` evenly spaced places from the first to the last."""
    over = W.partitionBy(*keys).orderBy(*order)
    placed = df.withColumns({"_i": F.row_number().over(over) - 1, "_n": F.count(F.lit(1)).over(W.partitionBy(*keys))})
    slot = F.floor(F.ceil(F.col("_i") * (most - 1) / (F.col("_n") - 1)))
    at = F.floor(slot * (F.col("_n") - 1) / (most - 1))
    return placed.where((F.col("_n") <= most) | (at == F.col("_i"))).drop("_i", "_n")
