"""Quality of tables: coverage, price checks, breaks, drift and leaks."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.timebars import epoch_micros
from tidemark.operators.order import sums_upto

HORIZONS = (1, 5, 10)
# What a column's name says about it, in lower case. A word at the start or end is set off by _ or a dot.
CALENDAR_NAMES = ("session", "date", "datetime", "day", "t5", "ts")
FUTURE_FIRST_WORDS = ("fwd", "forward", "next", "ahead", "lead")
FUTURE_LAST_WORDS = ("fwd", "future", "ahead", r"lead\d*")
FUTURE_STARTS = ("signed_ret", "fut_ret", "future_ret")
LABEL_NAMES = ("label", "primary_label", "weight", "weight_raw", "y")
LABEL_STARTS = ("label_int", "label_dir", "target", "outcome", "is_label")
LABEL_FIRST_WORDS = ("y",)
LABEL_ENDS = ("_at_label",)
HINTS = ("label", "target")
HINT_ENDS = ("class",)
LEAST_PAIRS = 1000
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}"


def coverage(df: DataFrame, other: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: rows of df, those within other's span, and their share."""
    span = other.agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    counted = df.crossJoin(span).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(ts).between(F.col("_lo"), F.col("_hi")), 1)).alias("n_covered"))
    return counted.withColumn("share", F.round(F.try_divide(F.col("n_covered"), F.col("n_rows")), 6))


def price_checks(df: DataFrame) -> DataFrame:
    """One row of counts: missing, not positive, and the five orders that open, high, low, close must keep."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    missing = o.isNull() | h.isNull() | lo.isNull() | c.isNull()
    tests = {"n_missing": missing, "n_not_positive": F.least(o, h, lo, c) <= 0, "n_high_below_low": h < lo, "n_high_below_open": h < o, "n_high_below_close": h < c, "n_low_above_open": lo > o, "n_low_above_close": lo > c}
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(F.when(t, 1)).alias(n) for n, t in tests.items()))


def breaks(df: DataFrame, keys: list[str], interval_minutes: int, ts: str = "ts") -> DataFrame:
    """(keys, n_rows, n_breaks, longest_minutes): steps between rows that are longer than the interval."""
    before = F.lag(ts).over(W.partitionBy(*keys).orderBy(ts))
    step = (epoch_micros(F.col(ts)) - epoch_micros(before)) / 60_000_000
    stepped = df.select(*keys, step.alias("_step"))
    return stepped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("_step") > interval_minutes, 1)).alias("n_breaks"), F.round(F.max("_step"), 4).alias("longest_minutes"))


def conflicting_labels(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One row: groups of equal features, those with several rows, and those with several labels."""
    groups = df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("k"))
    return groups.agg(F.count(F.lit(1)).alias("n_groups"), F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated"), F.count(F.when(F.col("k") > 1, 1)).alias("n_conflicting"))


def stability_index(df: DataFrame, column: str, is_test: Column, edges: list[float]) -> DataFrame:
    """(psi): population stability of a column between the two parts, over fixed bins."""
    bucket = sum((F.when(F.col(column) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    counts = df.where(F.col(column).isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.when(is_test, 1)).alias("b"), F.count(F.when(~is_test, 1)).alias("a"))
    all_ = W.partitionBy()
    shares = counts.select(((F.col("a") + 0.5) / (F.sum("a").over(all_) + 0.5)).alias("p"), ((F.col("b") + 0.5) / (F.sum("b").over(all_) + 0.5)).alias("q"))
    return shares.agg(F.round(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))), 6).alias("psi"))


def drift(df: DataFrame, columns: list[str], is_test: Column, bins: int = 10, alpha: float = 0.05) -> DataFrame:
    """A row for each numeric column: n_train, n_test, ks, ks_limit, drifted, psi, of the two parts' values; nulls are left out.

    ks is the exact two-sample Kolmogorov-Smirnov distance: both parts' counts by value are summed
    up to every value, all columns at once, over value ranges. Beyond ks_limit parts of these sizes
    differ at level alpha. psi is the stability index over bins between the training part's
    quantiles, with half a row added to each count. Both are null where a part has no value.
    """
    long = unpivoted(df.withColumn("_test", is_test), ["_test"], columns).where("x is not null")
    counts = long.groupBy("column", "x").agg(F.count(F.when(~F.col("_test"), 1)).alias("_a"), F.count(F.when(F.col("_test"), 1)).alias("_b"))
    upto = sums_upto(counts, ["column"], "x", {"_ua": "_a", "_ub": "_b"})
    sizes = counts.groupBy("column").agg(F.sum("_a").alias("n_train"), F.sum("_b").alias("n_test"))
    placed = upto.join(sizes, "column")
    apart = F.abs(F.try_divide(F.col("_ua"), F.col("n_train")) - F.try_divide(F.col("_ub"), F.col("n_test")))
    before = F.floor(F.try_divide(bins * (F.col("_ua") - F.col("_a")), F.col("n_train")))
    binned = placed.groupBy("column", "n_train", "n_test", F.least(before, F.lit(bins - 1)).alias("_bin")).agg(F.max(apart).alias("_ks"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    p, q = (F.col("_a") + 0.5) / (F.col("n_train") + 0.5), (F.col("_b") + 0.5) / (F.col("n_test") + 0.5)
    both = (F.col("n_train") > 0) & (F.col("n_test") > 0)
    found = binned.groupBy("column", "n_train", "n_test").agg(F.round(F.max("_ks"), 6).alias("ks"), F.round(F.sum((q - p) * F.log(q / p)), 6).alias("_psi"))
    limit = math.sqrt(-math.log(alpha / 2) / 2) * F.sqrt((F.col("n_train") + F.col("n_test")) / (F.col("n_train") * F.col("n_test")))
    found = found.withColumn("ks_limit", F.when(both, F.round(limit, 6)))
    return found.select("column", "n_train", "n_test", "ks", "ks_limit", (F.col("ks") > F.col("ks_limit")).alias("drifted"), F.when(both, F.col("_psi")).alias("psi"))


def row_overlap(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_test, n_seen (rows of test whose columns equal a training row's; nulls are equal), n_seen_distinct and share.

    Rows meet by two hashes of together 96 bits, counted before they meet, so a row that either part repeats is one.
    """
    digest = [F.xxhash64(*columns).alias("_h"), F.hash(*columns).alias("_g")]
    known = train.select(*digest).distinct().withColumn("_seen", F.lit(True))
    asked = test.groupBy(*digest).agg(F.count(F.lit(1)).alias("n")).join(known, ["_h", "_g"], "left")
    counted = asked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_test"), F.coalesce(F.sum(F.when(F.col("_seen"), F.col("n"))), F.lit(0)).alias("n_seen"), F.count("_seen").alias("n_seen_distinct"))
    return counted.withColumn("share", F.round(F.try_divide(F.col("n_seen"), F.col("n_test")), 6))


def new_categories(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """(column, n): values of the test part that the training part never has."""
    return test.groupBy(column).agg(F.count(F.lit(1)).alias("n")).join(train.select(column).distinct(), column, "left_anti")


def _says(starts: tuple[str, ...] = (), first: tuple[str, ...] = (), last: tuple[str, ...] = (), ends: tuple[str, ...] = (), whole: tuple[str, ...] = (), within: tuple[str, ...] = ()) -> re.Pattern:
    """A pattern that finds names by how they start and end, by a first or last word, by the whole name, or by a part."""
    kinds = [(starts, "^(%s)"), (first, "^(%s)[_.]"), (last, "[_.](%s)$"), (ends, "(%s)$"), (whole, "^(%s)$"), (within, "(%s)")]
    return re.compile("|".join(shape % "|".join(words) for words, shape in kinds if words))


#: In the order in which they are asked.
NAME_RULES = (
    (_says(whole=CALENDAR_NAMES), "banned", "calendar"),
    (_says(starts=FUTURE_STARTS, first=FUTURE_FIRST_WORDS, last=FUTURE_LAST_WORDS), "banned", "named after the future"),
    (_says(starts=LABEL_STARTS, first=LABEL_FIRST_WORDS, ends=LABEL_ENDS, whole=LABEL_NAMES), "banned", "named after the answer"),
    (_says(ends=HINT_ENDS, within=HINTS), "suspect", "named after a label"),
)


def own_name(name: str, sources: tuple[str, ...] = ()) -> str:
    """A column's name without its source's: after the last __, or after the longest known source and _."""
    if "__" in name:
        return name.rpartition("__")[2]
    known = [s for s in sources if name.lower().startswith(s.lower() + "_")]
    return name[len(max(known, key=len)) + 1 :] if known else name


def name_verdict(name: str, kind: str, allow: tuple[str, ...] = (), sources: tuple[str, ...] = ()) -> tuple[str, str]:
    """(verdict, reason) of a column from its name and type alone; the name counts with its source's name and without."""
    if name in allow:
        return "ok", "allowed"
    if kind.startswith(("timestamp", "date")):
        return "banned", "a time"
    asked = {name.lower(), own_name(name, sources).lower()}
    return next(((verdict, reason) for rule, verdict, reason in NAME_RULES if any(map(rule.search, asked))), ("ok", ""))


def unpivoted(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column, x): all numeric columns in one pass."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return df.selectExpr(*keys, f"stack({len(columns)}, {pairs}) as (column, x)")


def leak_statistics(df: DataFrame, keys: list[str], price: str, columns: list[str], order: list[str], horizons: tuple[int, ...] = HORIZONS, least: int = 0) -> DataFrame:
    """A row for each column: its correlation with the row number and with returns ahead and behind, in one aggregation.

    Correlations with returns over no more than `least` rows are null.
    """
    over = W.partitionBy(*keys).orderBy(*order)
    p = F.col(price)
    ahead = {f"ahead_{h}": F.lead(price, h).over(over) / p - 1 for h in horizons}
    behind = {f"behind_{h}": p / F.lag(price, h).over(over) - 1 for h in horizons}
    returned = df.withColumns({"_rn": F.row_number().over(over), **ahead, **behind})
    long = unpivoted(returned, ["_rn", *ahead, *behind], columns)
    no_nan = lambda c: F.when(~F.isnan(c), c)
    return long.groupBy("column").agg(F.count("x").alias("n"), F.count_distinct("x").alias("n_distinct"), F.round(no_nan(F.corr("x", "_rn")), 6).alias("time_corr"), *(F.when(F.count(F.when(F.col("x").isNotNull() & F.col(n).isNotNull(), 1)) > least, F.round(no_nan(F.corr("x", n)), 6)).alias(n) for n in [*ahead, *behind]))


def leak_verdict(stats: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """column, verdict, reason by what was measured: follows time, knows the future, or knows it better than the past."""
    ahead = F.greatest(F.lit(0.0), *(F.abs(f"ahead_{h}") for h in horizons))
    behind = F.greatest(F.lit(0.0), *(F.abs(f"behind_{h}") for h in horizons))
    reason = F.when((F.col("n") > 1000) & (F.col("n_distinct") >= 20) & (F.abs("time_corr") > 0.97), "follows time").when(ahead > 0.30, "knows the future").when((ahead > 0.10) & (ahead > 2 * behind), "knows the future better than the past").when((ahead > 0.05) & (ahead > 2 * behind), "may know the future")
    verdict = F.when(reason == "may know the future", "suspect").when(reason.isNotNull(), "banned").otherwise("ok")
    return stats.select("column", verdict.alias("verdict"), F.coalesce(reason, F.lit("")).alias("reason"))


def running_id_share(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """(column, share): rows at which a column stands at its running maximum; ids and counters do almost always."""
    over = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    marked = df.select(*((F.col(c) == F.max(c).over(over)).cast("double").alias(c) for c in columns))
    return unpivoted(marked, [], columns).groupBy("column").agg(F.round(F.avg("x"), 6).alias("share"))


def running_ids(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """(column, n, n_distinct, whole, share, growth): what tells a running id from a measure.

    share: rows at the series' running maximum or least value; growth: how much of the running
    maximum's rise falls into the later half of the series.
    """
    series = W.partitionBy(*keys, "column")
    over = series.orderBy(*order)
    long = unpivoted(df, [*keys, *(o for o in order if o not in keys)], columns).where("x is not null")
    ranked = long.withColumns({"_top": F.max("x").over(over.rowsBetween(W.unboundedPreceding, 0)), "_least": F.min("x").over(series), "_at": F.row_number().over(over), "_n": F.count(F.lit(1)).over(series)})
    early = F.max(F.when(F.col("_at") <= F.floor(F.col("_n") / 2) + 1, F.col("_top")))
    each = ranked.groupBy(*keys, "column").agg(F.min("_top").alias("_first"), early.alias("_mid"), F.max("_top").alias("_last"))
    growth = each.groupBy("column").agg((F.sum(F.col("_last") - F.col("_mid")) / F.greatest(F.sum(F.col("_last") - F.col("_first")), F.lit(1.0))).alias("growth"))
    facts = ranked.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("x").alias("n_distinct"), F.bool_and(F.col("x") == F.round("x")).alias("whole"), F.avg(((F.col("x") == F.col("_top")) | (F.col("x") == F.col("_least"))).cast("int")).alias("share"))
    return facts.join(growth, "column")


def leak_screen(df: DataFrame, keys: list[str], price: str, columns: list[str], order: list[str], allow: tuple[str, ...] = (), horizons: tuple[int, ...] = HORIZONS, sources: tuple[str, ...] = (), least: int = LEAST_PAIRS) -> DataFrame:
    """(column, verdict, reason) for each column: what its name and type say comes first, then what was measured.

    In order: allowed; a time; calendar; dates written as text; named after the future; named after
    the answer; named after a label (suspect, unless the measures ban it); follows time; a running
    id; knows the future. Booleans are measured as numbers. Measures over no more than `least` rows
    say nothing. `sources` are names that column names may start with.
    """
    spark, kinds = df.sparkSession, dict(df.dtypes)
    named = {c: name_verdict(c, kinds[c], allow, sources) for c in columns}
    texts = [c for c in columns if kinds[c] == "string" and named[c][1] not in ("allowed", "calendar")]
    measured = [c for c in columns if named[c][0] != "banned" and named[c][1] != "allowed" and kinds[c] != "string"]
    said = spark.createDataFrame([(k, c, *named[c]) for k, c in enumerate(columns)], "at int, column string, said string, why string")
    found = [spark.createDataFrame([], "column string, verdict string, reason string")]
    if texts:
        shares = df.select(*(F.avg(F.col(c).rlike(DATE_TEXT).cast("int")).alias(f"_t{k}") for k, c in enumerate(texts)))
        pairs = ", ".join(f"'{c}', _t{k}" for k, c in enumerate(texts))
        found.append(shares.selectExpr(f"stack({len(texts)}, {pairs}) as (column, share)").where("share > 0.9").selectExpr("column", "'banned' as verdict", "'a date as text' as reason"))
    if measured:
        verdicts = leak_verdict(leak_statistics(df, keys, price, measured, order, horizons, least), horizons)
        whole = [c for c in measured if kinds[c].split("(")[0] not in ("float", "decimal", "boolean")]
        ids = running_ids(df, keys, whole, order).where(f"n > {least} and n_distinct >= 100 and whole and share > 0.95 and growth > 0.2") if whole else verdicts.select("column").where("false")
        is_id = ids.select("column", F.lit(True).alias("is_id"))
        first = F.col("is_id") & (F.col("reason") != "follows time")
        judged = verdicts.join(is_id, "column", "left").select("column", F.when(first, "banned").otherwise(F.col("verdict")).alias("verdict"), F.when(first, "a running id").otherwise(F.col("reason")).alias("reason"))
        found.append(judged.where("verdict <> 'ok'"))
    seen = reduce(DataFrame.unionByName, found)
    banned = (F.col("said") != "banned") & (F.col("verdict") == "banned")
    date = F.col("reason") == "a date as text"
    both = said.join(seen, "column", "left").withColumn("over", F.coalesce(banned | (date & (F.col("why") != "a time")) | ((F.col("said") == "ok") & F.col("verdict").isNotNull()), F.lit(False)))
    return both.select("column", F.when(F.col("over"), F.col("verdict")).otherwise(F.col("said")).alias("verdict"), F.when(F.col("over"), F.col("reason")).otherwise(F.col("why")).alias("reason"))
