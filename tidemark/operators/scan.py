"""Running values over long ordered series in two levels.

A window without a small partition key sends a whole series through one task. Here each chunk of
a series (a session, say) is summarised, the summaries are scanned (a row for each chunk), and each
chunk starts from what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "last": lambda c: F.last(c, ignorenulls=True), "first": lambda c: F.first(c, ignorenulls=True)}


def _joined(kind: str, before: Column, here: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    if kind in ("max", "min"):
        return (F.greatest if kind == "max" else F.least)(before, here)
    return F.coalesce(here, before)


def running(df: DataFrame, keys: list[str], chunk: str, order: list[str], values: dict[str, tuple[str, str]], ahead: bool = False, inclusive: bool = True) -> DataFrame:
    """df with running values over (keys), in ascending (chunk, order).

    values: new column -> (kind, column); kinds are sum, count, max, min and last (non-null).
    ahead: run from the end instead, where `first` gives the next non-null. Not inclusive: without
    the row itself. A null chunk is a chunk of its own, before the others. An empty series has no rows.
    """
    within_order = [F.col(c).desc() if ahead else F.col(c).asc() for c in order]
    kinds = {n: ("last" if k in ("first", "last") else k) for n, (k, _) in values.items()}
    ordered = "max_by" if not ahead else "min_by"

    def summary(name: str) -> Column:
        kind, column = kinds[name], values[name][1]
        if kind == "last":
            place = F.struct(*order) if len(order) > 1 else F.col(order[0])
            return getattr(F, ordered)(F.when(F.col(column).isNotNull(), F.col(column)), F.when(F.col(column).isNotNull(), place))
        return _AGGREGATE[kind](column)

    sums = df.groupBy(*keys, chunk).agg(*(summary(n).alias(f"_s_{n}") for n in values))
    over = W.partitionBy(*keys).orderBy(F.col(chunk).desc() if ahead else F.col(chunk).asc()).rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select(*keys, F.col(chunk), *(_AGGREGATE["sum" if k == "count" else k](f"_s_{n}").over(over).alias(f"_c_{n}") for n, k in kinds.items()))
    within = W.partitionBy(*keys, chunk).orderBy(*within_order).rowsBetween(W.unboundedPreceding, W.currentRow if inclusive else -1)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, chunk]]
    here = df.withColumns({f"_h_{n}": _AGGREGATE[kinds[n]](c).over(within) for n, (_, c) in values.items()})
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    both = here.alias("a").join(carry.alias("b"), condition, "left")
    out = [_joined(kinds[n], F.col(f"b._c_{n}"), F.col(f"a._h_{n}")).alias(n) for n in values]
    return both.select(*(F.col(f"a.{c}") for c in df.columns if c not in values), *out)


def run_starts(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, place: str, name: str) -> DataFrame:
    """df with `place` of the first row of the run of equal values that each row is in; a null is a value.

    A chunk is summarised by its first and last value and by where its last run starts; a chunk's
    first run goes on with the one before it if the values meet, through as many chunks as it fills.
    """
    pieces, carry = _run_pieces(df, keys, chunk, order, value, place)
    both = pieces.alias("a").join(carry.alias("b"), _same([*keys, chunk]), "left")
    goes_on = (F.col("a._k") == 1) & F.col("b._goes_on")
    start = F.when(goes_on, F.col("b._carry")).otherwise(F.col("a._own"))["place"]
    return both.select(*(F.col(f"a.`{c}`") for c in df.columns if c != name), start.alias(name))


def runs(df: DataFrame, keys: list[str], chunk: str, order: str, value: str) -> DataFrame:
    """(keys, value, length, first, last, chunk of the first row) of each run of equal values: runs of a chunk, merged over chunks."""
    pieces, carry = _run_pieces(df, keys, chunk, [order], value, order)
    whole = pieces.groupBy(*keys, chunk, "_k").agg(F.first(value).alias(value), F.first("_own").alias("_own"), F.count(F.lit(1)).alias("length"), F.min(order).alias("first"), F.max(order).alias("last"))
    both = whole.alias("a").join(carry.alias("b"), _same([*keys, chunk]), "left")
    start = F.when((F.col("a._k") == 1) & F.col("b._goes_on"), F.col("b._carry")).otherwise(F.col("a._own"))
    return both.select("a.*", start.alias("_start")).groupBy(*keys, "_start").agg(F.first(value).alias(value), F.sum("length").alias("length"), F.min("first").alias("first"), F.max("last").alias("last"), F.min(chunk).alias(chunk)).drop("_start")


def _same(columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))
    return condition


def _run_pieces(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, place: str) -> tuple[DataFrame, DataFrame]:
    """Rows with _k (the number of their run in the chunk) and _own (where it starts there); and for each chunk whether its first run goes on with one before, and where that started."""
    within = W.partitionBy(*keys, chunk).orderBy(*order)
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    changed = (F.row_number().over(within) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(within))
    marked = df.withColumn("_changed", changed)
    pieces = marked.withColumns({"_k": F.sum(F.col("_changed").cast("int")).over(upto), "_own": F.last(F.when(F.col("_changed"), F.struct(F.col(place).alias("place"))), ignorenulls=True).over(upto)}).drop("_changed")
    at, boxed = F.struct(*order), F.struct(F.col(value).alias("value"))
    chunks = pieces.groupBy(*keys, chunk).agg(F.min_by(boxed, at).alias("_first"), F.max_by(boxed, at).alias("_last"), F.max_by("_own", at).alias("_start"), F.max("_k").alias("_runs"))
    over = W.partitionBy(*keys).orderBy(chunk)
    met = chunks.withColumn("_goes_on", F.coalesce(F.lag("_last").over(over).eqNullSafe(F.col("_first")) & F.lag("_last").over(over).isNotNull(), F.lit(False)))
    own = F.when((F.col("_runs") > 1) | ~F.col("_goes_on"), F.col("_start"))  # else the chunk is all one run that began before it
    return pieces, met.select(*keys, F.col(chunk), "_goes_on", F.last(own, ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1)).alias("_carry"))


FAN = 256


def affine(df: DataFrame, keys: list[str], index: str, a: str, b: str, name: str) -> DataFrame:
    """(keys, index, name): y = a * y before + b in ascending index, which counts from 0 without gaps; y before the first is 0.

    Rows are maps, and maps compose: FAN of them are one map of the next level, until a series is
    one. Then each level's maps get the y that they start from, from the top down. A task holds FAN
    rows of a series at once, and no power of a is ever divided by.
    """
    maps = df.select(*keys, F.col(index).cast("long").alias("_i"), F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b"))
    top, levels = maps.agg(F.max("_i").alias("n")).first()["n"] or 0, []
    entry = F.struct("_i", "_a", "_b")
    while True:
        groups = maps.groupBy(*keys, F.floor(F.col("_i") / FAN).alias("_g")).agg(F.array_sort(F.collect_list(entry)).alias("_m"))
        levels.append(groups)
        if top < FAN:
            break
        whole = F.aggregate("_m", F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")), lambda s, x: F.struct((x["_a"] * s["a"]).alias("a"), (x["_a"] * s["b"] + x["_b"]).alias("b")))
        maps, top = groups.select(*keys, F.col("_g").alias("_i"), whole.alias("_w")).select(*keys, "_i", F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b")), top // FAN
    starts = levels[-1].select(*keys, "_g", F.lit(0.0).alias("_y"))
    kept = F.array().cast("array<struct<_i:bigint,_before:double,_y:double>>")
    for groups in reversed(levels):
        both = groups.alias("a").join(starts.alias("b"), _same([*keys, "_g"])).select("a.*", "b._y")

        def step(s: Column, x: Column) -> Column:
            y = x["_a"] * s["y"] + x["_b"]
            return F.struct(F.array_append(s["out"], F.struct(x["_i"].alias("_i"), s["y"].alias("_before"), y.alias("_y"))).alias("out"), y.alias("y"))

        reached = F.aggregate("_m", F.struct(kept.alias("out"), F.col("_y").alias("y")), step, lambda s: s["out"])
        each = both.select(*keys, F.inline(reached))
        starts = each.select(*keys, F.col("_i").alias("_g"), F.col("_before").alias("_y"))
    return each.select(*keys, F.col("_i").alias(index), F.col("_y").alias(name))
