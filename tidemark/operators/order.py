"""Order over values that no task could hold: value ranges, sums up to a value, tie-averaged ranks, exact cuts.

Equal values are counted first, so a value that a third of all rows have is one row. Its range comes
from a sketch of the values, so ranges are of like size; sums up to a value then run in two levels,
within a range and over the ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.scan import running

RANGES = 64


def same(a: str, b: str, columns: list[str]) -> Column:
    """Rows of a and b (aliases) with equal columns, nulls being equal."""
    return reduce(lambda x, y: x & y, (F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns))


def ranged(df: DataFrame, keys: list[str], column: str, name: str = "_range", ranges: int = RANGES) -> DataFrame:
    """df with the range, of about `ranges` of each key, that a row's value lies in; equal values share one, a null has none."""
    shares = F.array(*(F.lit(k / ranges) for k in range(1, ranges)))
    bounds = df.groupBy(*keys).agg(F.array_distinct(F.percentile_approx(column, shares, 16 * ranges)).alias("_bounds"))
    both = df.alias("a").join(bounds.alias("b"), same("a", "b", keys), "left")
    place = F.size(F.filter(F.col("b._bounds"), lambda x: x <= F.col(f"a.`{column}`")))
    return both.select("a.*", F.when(F.col(f"a.`{column}`").isNotNull(), place).alias(name))


def sums_upto(counts: DataFrame, keys: list[str], column: str, values: dict[str, str]) -> DataFrame:
    """counts, one row for each (keys, column), with new columns: the sum of each named column over all values up to the row's own."""
    return running(ranged(counts, keys, column), keys, "_range", [column], {n: ("sum", c) for n, c in values.items()}).drop("_range")


def average_ranks(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """df with each row's rank from 1 within its key, ties having the mean of theirs, and name_of, the key's rows with a value. Nulls have no rank."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    upto = sums_upto(counts, keys, column, {"_upto": "_n"})
    of = counts.groupBy(*keys).agg(F.sum("_n").alias("_of"))
    placed = upto.alias("a").join(of.alias("b"), same("a", "b", keys)).select("a.*", "b._of")
    both = df.alias("a").join(placed.alias("b"), same("a", "b", [*keys, column]), "left")
    return both.select("a.*", (F.col("b._upto") - (F.col("b._n") - 1) / 2).alias(name), F.col("b._of").alias(f"{name}_of"))


def order_statistic(df: DataFrame, column: str, place: int) -> tuple[int, int, int] | None:
    """The value at a place (from 0) of a whole-number column's sorted values, how many lie below it and how many equal it, by counting in ever finer bins.

    Null if the column has no more than `place` values. At most 4097 counts come to the driver at a time.
    """
    own = df.select(F.col(column).cast("long").alias("v")).where("v is not null")
    facts = own.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not 0 <= place < facts["n"]:
        return None
    found, below = facts, 0
    while found["lo"] < found["hi"]:
        low, high = found["lo"], found["hi"]
        width = (high - low) // 4096 + 1
        bins = own.where(F.col("v").between(low, high)).groupBy(F.floor((F.col("v") - low) / width).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for found in sorted(bins.collect(), key=lambda r: r["b"]):
            if below + found["n"] > place:
                break
            below += found["n"]
    return found["lo"], below, found["n"]


def first_rows(df: DataFrame, n: int, column: str, tie: str) -> Column:
    """Whether a row is among the n least by (column, tie), both whole numbers, which together tell rows apart."""
    found = order_statistic(df, column, n - 1)
    if found is None:
        return F.lit(n > 0)  # all rows, or none
    value, below, equal = found
    if below + equal == n:
        return F.col(column) <= value
    last, _, _ = order_statistic(df.where(F.col(column) == value), tie, n - 1 - below)
    return (F.col(column) < value) | ((F.col(column) == value) & (F.col(tie) <= last))


BITS, STEP = 32, 16


def least_hashed(ids: DataFrame, hashes: dict[str, Column], id_col: str, n: int | float) -> dict[str, Column]:
    """For each named hash (below 2**32) of `ids`, whether a row is among the n least by (hash, id): samples of exactly n ids, all found at once.

    A fraction n is that share of all ids, rounded. Histograms of all hashes are counted together,
    and the bin in which the n-th row lies is cut into finer ones until it is one hash. Only those
    bins come to the driver, a row for each hash.
    """
    total = ids.count()
    n = round(n * total) if isinstance(n, float) else n
    if not 0 < n < total:
        return {name: F.lit(n > 0) for name in hashes}
    prefix, below, equal, seen = dict.fromkeys(hashes, 0), dict.fromkeys(hashes, 0), dict.fromkeys(hashes, 0), 0
    hashed = ids.select(id_col, *(c.alias(name) for name, c in hashes.items()))
    while seen < BITS:
        step = min(STEP, BITS - seen)
        shift = BITS - seen - step
        inside = F.array_compact(F.array(*(F.when(F.shiftright(name, shift + step) == prefix[name], F.struct(F.lit(name).alias("name"), F.shiftright(name, shift).alias("bin"))) for name in hashes)))
        counts = hashed.select(F.inline(inside)).groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"))
        start = F.create_map(*(F.lit(x) for pair in below.items() for x in pair))[F.col("name")]
        upto = start + F.sum("n").over(W.partitionBy("name").orderBy("bin"))  # a row for each bin, 65536 at most
        reached = counts.withColumn("upto", upto).where(F.col("upto") >= n).groupBy("name").agg(F.min(F.struct("bin", "upto", "n")).alias("b"))
        for name, b in ((r["name"], r["b"]) for r in reached.collect()):
            prefix[name], below[name], equal[name] = b["bin"], b["upto"] - b["n"], b["n"]
        seen += step
    out = {}
    for name, c in hashes.items():
        out[name] = c <= prefix[name]
        if below[name] + equal[name] > n:  # several ids have the last hash
            last, _, _ = order_statistic(hashed.where(F.col(name) == prefix[name]), id_col, n - 1 - below[name])
            out[name] = (c < prefix[name]) | ((c == prefix[name]) & (F.col(id_col) <= last))
    return out
