"""Splits in time with embargoes in sessions, purged folds, and splits at random by a hash that SQL can repeat."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.timebars import candle, epoch_micros
from tidemark.operators.order import first_rows, order_statistic


def times_modulo(x: Column, factor: int) -> Column:
    """x * factor modulo 2**32, in halves of 16 bits, so that no id is too large for it."""
    low = F.pmod(x.cast("long"), F.lit(1 << 32))
    upper = F.pmod(F.shiftright(low, 16) * (factor % (1 << 32)), F.lit(1 << 16)) * (1 << 16)
    return F.pmod(upper + low.bitwiseAND(0xFFFF) * (factor % (1 << 32)), F.lit(1 << 32))


def hash_rank(id_: Column, seed: int) -> Column:
    """A number below 2**32 that scatters ids the same in every engine."""
    return F.pmod(times_modulo(id_, 2654435761) + seed * 40503, F.lit(1 << 32))


def with_session(df: DataFrame, ts: str = "ts") -> DataFrame:
    """df with session: the place of its day among the days that occur, from 0.

    The days come to the driver, a row for each, and go back as a local table, whose size Spark
    knows: rows are neither dealt by day to find theirs nor read again for each use.
    """
    found = sorted(r[0] for r in df.select(F.to_date(ts).alias("_day")).where("_day is not null").distinct().collect())
    days = df.sparkSession.createDataFrame(pa.table({"_day": pa.array(found, pa.date32()), "session": pa.array(range(len(found)), pa.int32())}))
    return df.withColumn("_day", F.to_date(ts)).join(days, "_day", "left").drop("_day")


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The interpolated quantile of a whole-number column, by counting in ever finer bins: no task ever holds the values.

    Null if the column has none.
    """
    n = df.agg(F.count(F.col(column).cast("long")).alias("n")).first()["n"]
    if not n:
        return None
    place = share * (n - 1)
    value, below, equal = order_statistic(df, column, int(place))
    if place == int(place) or below + equal > int(place) + 1:
        return float(value)
    above = df.where(F.col(column) > value).agg(F.min(F.col(column).cast("long")).alias("v")).first()["v"]
    return value + (place - int(place)) * (above - value)


def three_way(df: DataFrame, val: float, test: float, embargo: int, ts: str = "ts") -> DataFrame:
    """df with split: train, val, test, or embargo for the sessions after each cut.

    Cuts are exact quantiles of time, interpolated; the rows of the cut's own session after it and
    of the next `embargo` sessions are left out of the next part.
    """
    own = with_session(df, ts)
    micros = epoch_micros(F.col(ts))
    timed = df.select(micros.alias("_m"))
    first, second = (exact_quantile(timed, "_m", q) for q in (1 - val - test, 1 - test))
    own = own.withColumns({"_a": F.lit(first), "_b": F.lit(second)})
    ends = own.agg(F.max(F.when(micros <= F.col("_a"), F.col("session"))).alias("_sa"), F.max(F.when(micros <= F.col("_b"), F.col("session"))).alias("_sb")).first()
    s = F.col("session")
    part = F.when(micros <= F.col("_a"), "train").when((micros <= F.col("_b")) & (s > F.lit(ends["_sa"]) + embargo), "val").when((micros > F.col("_b")) & (s > F.lit(ends["_sb"]) + embargo), "test").otherwise("embargo")
    return own.withColumn("split", part).drop("_a", "_b")


def bundle_time(df: DataFrame, val: float, test: float, embargo: int, minutes: int = 15, ts: str = "ts") -> DataFrame:
    """df with split by whole candles in time; the last `embargo` sessions before each boundary are left out of the earlier part.

    A part with no more than `embargo` sessions keeps them all. Rows without a time are left out.
    The candles at the cuts are found by counting, so that no task orders them; the driver gets
    counts and three rows.
    """
    own = with_session(df, ts).withColumn("_at", F.floor(epoch_micros(candle(F.col(ts), minutes)) / 60_000_000))
    candles = own.select("_at").distinct()
    n = candles.count()
    cuts = [order_statistic(candles, "_at", round(n * share) - 1) for share in (1 - val - test, 1 - test)]
    first, second = (cut[0] if cut else -(1 << 62) for cut in cuts)
    parted = own.withColumn("_p", F.when(F.col("_at") <= first, 0).when(F.col("_at") <= second, 1).otherwise(2))
    facts = {r["_p"]: r for r in parted.groupBy("_p").agg(F.max("session").alias("last"), F.count_distinct("session").alias("n")).collect()}  # three rows
    split = F.when(F.col("_at").isNotNull() & (F.col("_p") == 2), "test")
    for k, name in enumerate(("train", "val")):
        late = F.col("session") > facts[k]["last"] - embargo if k in facts and facts[k]["n"] > embargo else F.lit(False)
        split = split.when((F.col("_p") == k) & late, "embargo").when(F.col("_p") == k, name)
    return parted.where("_at is not null").withColumn("split", split).drop("_at", "_p")


def bundle_random(df: DataFrame, val: float, test: float, seed: int, minutes: int = 15, ts: str = "ts") -> DataFrame:
    """df with split by whole candles at random, of exact sizes; rows without a time are left out.

    Candles are hashed, and the hash of the last one in each part is found by counting, so that a
    row's part follows from its own candle, and no task orders them all.
    """
    own = df.withColumn("_at", F.floor(epoch_micros(candle(F.col(ts), minutes)) / 60_000_000)).where("_at is not null")
    own = own.withColumn("_h", hash_rank(F.col("_at") * 60, seed))
    candles = own.select("_at", "_h").distinct()
    n = candles.count()
    n_test, n_val = round(n * test), round(n * val)
    split = F.when(first_rows(candles, n_test, "_h", "_at"), "test").when(first_rows(candles, n_test + n_val, "_h", "_at"), "val").otherwise("train")
    return own.withColumn("split", split).drop("_at", "_h")


def random_rows(df: DataFrame, id_col: str, test: float, seed: int) -> DataFrame:
    return df.withColumn("split", F.when(hash_rank(F.col(id_col), seed) < int(test * (1 << 32)), "test").otherwise("train"))


def embargo_end(df: DataFrame, cut: Column, sessions: int, ts: str = "ts") -> DataFrame:
    """(day): the last of so many sessions after the cut's; no row if the data ends before."""
    days = df.select(F.to_date(ts).alias("day")).distinct()
    return days.where(F.col("day") > F.to_date(cut)).orderBy("day").limit(sessions).agg(F.max("day").alias("day"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") == sessions).select("day")


def purged_folds(df: DataFrame, folds: int, purge: int, embargo: int, ts: str = "ts") -> DataFrame:
    """A row of df for each fold with role: test for its block of sessions, dropped near it, else train.

    Sessions are cut into contiguous blocks, the first (sessions mod folds) of them one longer.
    Dropped are `purge` sessions before the block and purge + embargo after it.
    """
    own = with_session(df, ts)
    last = own.agg(F.max("session")).first()[0]
    base, extra = divmod(0 if last is None else last + 1, folds)
    starts = [k * base + min(k, extra) for k in range(folds + 1)]
    blocks = df.sparkSession.createDataFrame(pa.table({"fold": pa.array(range(folds), pa.int32()), "_from": pa.array(starts[:-1], pa.int64()), "_to": pa.array(starts[1:], pa.int64())}))
    s = F.col("session")
    role = F.when((s >= F.col("_from")) & (s < F.col("_to")), "test").when((s >= F.col("_from") - purge) & (s < F.col("_to") + purge + embargo), "dropped").otherwise("train")
    return own.crossJoin(blocks).withColumn("role", role).drop("_from", "_to")


def fold_report(assigned: DataFrame, ts: str = "ts") -> DataFrame:
    """(fold, n_train, n_test, n_dropped, test_from, test_to)."""
    n = lambda r: F.count(F.when(F.col("role") == r, 1)).alias(f"n_{r}")
    test = F.when(F.col("role") == "test", F.col(ts))
    return assigned.groupBy("fold").agg(n("train"), n("test"), n("dropped"), F.min(test).alias("test_from"), F.max(test).alias("test_to"))


def leaks(assigned: DataFrame, purge: int, embargo: int) -> DataFrame:
    """(fold, problem): folds whose training sessions come nearer the test block than promised; none if all is well."""
    test = assigned.where("role = 'test'").groupBy("fold").agg(F.min("session").alias("_from"), F.max("session").alias("_to"))
    near = assigned.where("role = 'train'").join(test, "fold")
    s = F.col("session")
    problem = F.when(s.between(F.col("_from"), F.col("_to")), "overlap").when((s < F.col("_from")) & (s >= F.col("_from") - purge), "purge").when((s > F.col("_to")) & (s <= F.col("_to") + purge + embargo), "embargo")
    return near.select("fold", problem.alias("problem")).where("problem is not null").distinct()


def groups_sample(df: DataFrame, id_col: str, true: str, pred: str, a: str, b: str, n: int, seed: int) -> DataFrame:
    """n rows at random of each of: a taken for b, a right, b right; with group."""
    t, p = F.col(true), F.col(pred)
    group = F.when((t == a) & (p == b), "mistake").when((t == a) & (p == a), "a_right").when((t == b) & (p == b), "b_right")
    over = W.partitionBy("group").orderBy(hash_rank(F.col(id_col), seed), id_col)
    return df.withColumn("group", group).where("group is not null").withColumn("_n", F.row_number().over(over)).where(F.col("_n") <= n).drop("_n")


def from_recipe(df: DataFrame, recipe: dict) -> DataFrame:
    """df split as a recipe says: its kind (three_way, bundle_time, candles or rows) and that kind's settings; refuses others."""
    kind, val, test = recipe.get("kind"), recipe.get("val", 0.1), recipe.get("test", 0.2)
    if kind == "three_way":
        return three_way(df, val, test, recipe.get("embargo", 0))
    if kind == "bundle_time":
        return bundle_time(df, val, test, recipe.get("embargo", 0))
    if kind == "candles":
        return bundle_random(df, val, test, recipe.get("seed", 0))
    if kind == "rows":
        return random_rows(df, recipe["id"], test, recipe.get("seed", 0))
    raise ValueError(f"no split is called {kind}")
