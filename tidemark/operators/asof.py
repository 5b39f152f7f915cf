"""Point-in-time joins: the last value that could be known at each row of a spine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.timebars import bar_close, epoch_micros, minutes

DAY = 24 * 60


def _bucket(ts: Column, width: int) -> Column:
    return F.floor(epoch_micros(ts) / (width * 60_000_000)).cast("long")


def asof_backward(spine: DataFrame, source: DataFrame, keys: list[str], at: str, values: list[str], tolerance: int, ts: str = "ts") -> DataFrame:
    """spine with `values` and `at` of the last source row at or before ts, no older than `tolerance` minutes (inclusive).

    Rows are dealt by (keys, span of time), a span being no shorter than the tolerance; each source row also
    stands in the next span, so no series has to fit one task and no value has to be carried. `source` must be
    unique in (keys, at); null keys and times match nothing, and their spine rows stay.
    """
    width = max(DAY, tolerance)
    left = spine.withColumns({"_bucket": _bucket(F.col(ts), width), "_at": F.col(ts), "_side": F.lit(1)})
    right = source.where(F.col(at).isNotNull()).select(*keys, F.struct(F.col(at).alias("_from"), *values).alias("_value"), F.col(at).alias("_at"), F.lit(0).alias("_side"), F.explode(F.array(_bucket(F.col(at), width), _bucket(F.col(at), width) + 1)).alias("_bucket"))
    rows = left.unionByName(right, allowMissingColumns=True)
    over = W.partitionBy(*keys, "_bucket").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = rows.withColumn("_value", F.last("_value", ignorenulls=True).over(over)).where("_side = 1")
    fresh = (F.col("_value._from") + minutes(tolerance) >= F.col(ts)) & reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys), F.lit(True))
    out = {v: F.when(fresh, F.col(f"_value.{v}")) for v in values} | {at: F.when(fresh, F.col("_value._from"))}
    return seen.withColumns(out).drop("_bucket", "_at", "_side", "_value")


def align_to_bars(spine: DataFrame, feature: DataFrame, keys: list[str], values: list[str], bar: int, tolerance_bars: int = 3, ts: str = "ts", close: str = "close_ts") -> DataFrame:
    """spine with the values of the last feature bar that had closed at ts, at most tolerance_bars old.

    Of several rows in a bar the last one counts. `close` is the served bar's close, so close <= ts
    can be verified (see no_peek).
    """
    if bar < 1:
        raise ValueError("a bar has at least one minute")
    closed = feature.withColumn(close, bar_close(F.col(ts), bar))
    last = closed.groupBy(*keys, close).agg(F.max_by(F.struct(*values), F.col(ts)).alias("_v")).select(*keys, close, *(F.col(f"_v.{v}").alias(v) for v in values))
    return asof_backward(spine, last, keys, close, values, bar * tolerance_bars, ts)


def align_by_clock(spine: DataFrame, feature: DataFrame, keys: list[str], clocks: dict[str, int], tolerance_bars: int = 3, ts: str = "ts", row_id: str = "row_id") -> DataFrame:
    """spine with every column of `clocks` aligned by its own bar; columns of one clock share a pass. row_id is unique in spine."""
    out = spine
    for bar in sorted(set(clocks.values())):
        own = [c for c, n in clocks.items() if n == bar]
        piece = align_to_bars(spine.select(row_id, *keys, ts), feature.select(*keys, ts, *own), keys, own, bar, tolerance_bars, ts)
        out = out.join(piece.select(row_id, *own), row_id)
    return out


def align_to_price(price: DataFrame, other: DataFrame, keys: list[str], value: str, direction: str, tolerance: int, ts: str = "ts") -> DataFrame:
    """price with `value` of other: exact, or the nearest in time backward, forward or either way (ties: backward)."""
    if direction == "exact":
        return price.join(other.select(*keys, ts, value), [*keys, ts], "left")
    width = max(DAY, tolerance)
    left = price.withColumns({"_bucket": _bucket(F.col(ts), width), "_side": F.lit(1)})
    own = _bucket(F.col(ts), width)
    right = other.where(F.col(ts).isNotNull()).select(*keys, ts, F.struct(F.col(ts).alias("_from"), value).alias("_value"), F.lit(0).alias("_side"), F.explode(F.array(own - 1, own, own + 1)).alias("_bucket"))
    rows = left.unionByName(right, allowMissingColumns=True)
    part = W.partitionBy(*keys, "_bucket")
    back = F.last("_value", ignorenulls=True).over(part.orderBy(F.col(ts), F.col("_side")).rowsBetween(W.unboundedPreceding, W.currentRow))
    ahead = F.last("_value", ignorenulls=True).over(part.orderBy(F.col(ts).desc(), F.col("_side")).rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = rows.withColumns({"_back": back, "_ahead": ahead}).where("_side = 1")
    gap = lambda c: F.abs(epoch_micros(F.col(ts)) - epoch_micros(F.col(f"{c}._from")))
    near = lambda c: F.when(gap(c) <= tolerance * 60_000_000, F.col(c))
    picked = {"backward": near("_back"), "forward": near("_ahead"), "nearest": F.when(near("_back").isNull() | (gap("_ahead") < gap("_back")), F.coalesce(near("_ahead"), near("_back"))).otherwise(near("_back"))}[direction]
    return seen.withColumn(value, picked[value]).drop("_bucket", "_side", "_value", "_back", "_ahead")


def no_peek(aligned: DataFrame, ts: str = "ts", close: str = "close_ts") -> DataFrame:
    """One row: rows, rows that serve a bar, and violations (bars that had not closed)."""
    return aligned.agg(F.count(F.lit(1)).alias("n_rows"), F.count(close).alias("n_served"), F.count(F.when(F.col(close) > F.col(ts), 1)).alias("n_violations"))


def drop_served_windows(spine: DataFrame, bad: DataFrame, keys: list[str], bar: int, tolerance_bars: int = 3, ts: str = "ts") -> DataFrame:
    """spine without rows that an unusable bar would have served: close <= ts < close + bar * tolerance.

    Both sides are dealt by (keys, day), and a window stands in each day it touches.
    """
    width = max(DAY, bar * tolerance_bars)
    closes = bad.select(*keys, bar_close(F.col(ts), bar).alias("_close")).distinct()
    ends = closes.withColumn("_end", F.col("_close") + minutes(bar * tolerance_bars))
    windows = ends.select(*keys, "_close", "_end", F.explode(F.sequence(_bucket(F.col("_close"), width), _bucket(F.col("_end"), width))).alias("_bucket"))
    rows = spine.withColumn("_bucket", _bucket(F.col(ts), width))
    same = reduce(lambda a, b: a & b, [rows[k] == windows[k] for k in [*keys, "_bucket"]])
    return rows.join(windows, same & (rows[ts] >= F.col("_close")) & (rows[ts] < F.col("_end")), "left_anti").drop("_bucket")


def attach_labels(bars: DataFrame, keys: list[str], labels: DataFrame | None = None, predictions: DataFrame | None = None) -> DataFrame:
    """bars with label and predicted (strings), from tables of keys and that column; null where there is none, or no table. Keys are unique in both tables."""
    out = bars
    for name, given in (("label", labels), ("predicted", predictions)):
        out = out.withColumn(name, F.lit(None).cast("string")) if given is None else out.join(given.select(*keys, F.col(name).cast("string").alias(name)), keys, "left")
    return out
