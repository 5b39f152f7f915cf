"""Classification quality: mistakes ranked by rate and severity, confusion, per-class scores, average precision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def class_names(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(label): every class of either column."""
    return df.select(F.col(true).alias("label")).union(df.select(F.col(pred).alias("label"))).where("label is not null").distinct()


def comparable(true: str, pred: str) -> Column:
    return F.col(true).isNotNull() & F.col(pred).isNotNull()


def pair_counts(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(true_label, pred_label, n): every pair of classes, zero where it doesn't occur. Classes are few, so their product is too."""
    counts = df.where(comparable(true, pred)).groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    classes = class_names(df, true, pred)
    pairs = classes.select(F.col("label").alias("true_label")).crossJoin(classes.select(F.col("label").alias("pred_label")))
    return pairs.join(counts, ["true_label", "pred_label"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def rank_mistakes(df: DataFrame, true: str, pred: str, severity: DataFrame | None = None, default: float = 1.0) -> DataFrame:
    """(true_label, pred_label, n, n_true, rate, severity, importance) of the mistakes that occur.

    rate is of the true class's rows; importance is rate * severity, rounded half-even to 4 digits.
    `severity` is (true_label, pred_label, severity); pairs that it lacks cost `default`.
    """
    counts = df.where(comparable(true, pred)).groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("n_true", F.sum("n").over(W.partitionBy("true_label"))).where("true_label <> pred_label")
    if severity is None:
        counts = counts.withColumn("severity", F.lit(float(default)))
    else:
        counts = counts.join(severity, ["true_label", "pred_label"], "left").withColumn("severity", F.coalesce(F.col("severity").cast("double"), F.lit(float(default))))
    rate = F.col("n") / F.col("n_true")
    return counts.select("true_label", "pred_label", "n", "n_true", F.bround(rate, 6).alias("rate"), "severity", F.bround(rate * F.col("severity"), 4).alias("importance"))


def trading_cost(mistakes: DataFrame, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """The sum of the mistakes' rounded importances."""
    return mistakes.groupBy(*keys).agg(F.bround(F.coalesce(F.sum("importance"), F.lit(0.0)), 4).alias("cost"))


def worst_case(mistakes: DataFrame, least: float) -> DataFrame:
    """Mistakes of at least this severity, the severest and then the most frequent first."""
    return mistakes.where(F.col("severity") >= least).orderBy(F.desc("severity"), F.desc("n"), "true_label", "pred_label")


def confusion(df: DataFrame, true: str, pred: str, classes: list[str]) -> DataFrame:
    """A row for each true class and TOTAL, a column for each predicted class and TOTAL."""
    counted = df.where(comparable(true, pred)).cube(F.col(true).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    named = counted.select(F.when(F.col("g").isin(0, 1), F.col("t")).otherwise("TOTAL").alias("true_label"), F.when(F.col("g").isin(0, 2), F.col("p")).otherwise("TOTAL").alias("p"), "n")
    wide = named.groupBy("true_label").pivot("p", [*classes, "TOTAL"]).agg(F.sum("n"))
    return wide.select("true_label", *(F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in [*classes, "TOTAL"]))


def expand(counts: DataFrame, n: str = "n") -> DataFrame:
    """Rows again from their counts."""
    return counts.where(F.col(n) > 0).select("*", F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias("_copy")).drop("_copy", n)


def agreement(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row: rows, rows with each side, compared, matches, mismatches and accuracy (null if none compared)."""
    both, same = comparable(true, pred), F.col(true) == F.col(pred)
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(true).alias("n_true"), F.count(pred).alias("n_pred"), F.count(F.when(both, 1)).alias("n_compared"), F.count(F.when(same, 1)).alias("n_match"))
    return counts.withColumn("n_mismatch", F.col("n_compared") - F.col("n_match")).withColumn("accuracy", F.bround(F.try_divide(F.col("n_match"), F.col("n_compared")), 6))


def per_class(df: DataFrame, true: str, pred: str, zero: bool = False) -> DataFrame:
    """label, support, precision, recall, f1 for each class and their macro mean.

    What is undefined (no prediction, no support, or a zero in f1) is null and out of the mean; with
    zero=True it is 0 and in.
    """
    rows = df.where(comparable(true, pred)).select(F.col(true).alias("t"), F.col(pred).alias("p"))
    by_true = rows.groupBy(F.col("t").alias("label")).agg(F.count(F.lit(1)).alias("support"), F.count(F.when(F.col("t") == F.col("p"), 1)).alias("hit"))
    by_pred = rows.groupBy(F.col("p").alias("label")).agg(F.count(F.lit(1)).alias("claimed"))
    both = by_true.join(by_pred, "label", "full").na.fill(0, ["support", "hit", "claimed"])
    precision, recall = F.try_divide(F.col("hit"), F.col("claimed")), F.try_divide(F.col("hit"), F.col("support"))
    scored = both.select("label", "support", precision.alias("precision"), recall.alias("recall"))
    f1 = F.when((F.col("precision") > 0) & (F.col("recall") > 0), 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    scored = scored.withColumn("f1", f1)
    if zero:
        scored = scored.na.fill(0.0, ["precision", "recall", "f1"])
    macro = scored.agg(F.lit("MACRO").alias("label"), F.sum("support").alias("support"), *(F.avg(c).alias(c) for c in ("precision", "recall", "f1")))
    return scored.unionByName(macro).select("label", F.col("support").cast("long").alias("support"), *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def average_precision(df: DataFrame, score: str, positive: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """(keys, ap): sum over distinct scores, descending, of the step in recall times the precision there.

    Equal scores are one step. Counts by score are aggregated first, so the window holds distinct scores only.
    """
    steps = df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(positive).cast("int")).alias("tp"))
    over = W.partitionBy(*keys).orderBy(F.desc(score)).rowsBetween(W.unboundedPreceding, 0)
    total = F.sum("tp").over(W.partitionBy(*keys))
    parts = steps.withColumns({"part": F.try_divide(F.col("tp"), total) * F.sum("tp").over(over) / F.sum("n").over(over)})
    return parts.groupBy(*keys).agg(F.round(F.sum("part"), 6).alias("ap"))


def never_predicted(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(label): classes that occur as truth and never as a prediction."""
    return df.select(F.col(true).alias("label")).where("label is not null").distinct().join(df.select(F.col(pred).alias("label")).distinct(), "label", "left_anti")


def class_shares(df: DataFrame, label: str, weight: str) -> DataFrame:
    """label, n, share, mean weight, and the share of rows without weight."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(weight), 6).alias("mean_weight"), F.round(F.avg((F.col(weight) == 0).cast("int")), 6).alias("zero_share"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def weight_drift(df: DataFrame, label: str, weights: DataFrame, limit: float = 0.15) -> DataFrame:
    """Balanced class weights N / (K n) against configured ones (label, weight), and whether they are off by more than the limit."""
    n = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total, k = F.sum("n").over(W.partitionBy()), F.count(F.lit(1)).over(W.partitionBy())
    balanced = n.withColumn("balanced", total / (k * F.col("n"))).join(weights, "label", "left")
    drift = F.abs(F.col("weight") - F.col("balanced")) / F.col("balanced")
    return balanced.select("label", "n", F.round("balanced", 6).alias("balanced"), F.round(drift, 6).alias("drift"), F.coalesce(drift > limit, F.lit(True)).alias("flagged"))


def majority_baseline(df: DataFrame, true: str) -> DataFrame:
    """df with the most frequent true class as every row's prediction (ties: the first in order)."""
    top = df.where(F.col(true).isNotNull()).groupBy(true).agg(F.count(F.lit(1)).alias("n")).agg(F.max_by(F.col(true), F.struct("n")).alias("baseline"))
    return df.crossJoin(top)  # one row


def champions(costs: DataFrame, blind: DataFrame) -> DataFrame:
    """(model, cost, n_blind, place): models that predict every class by cost, then those that are blind to some."""
    scored = costs.join(blind, "model", "left").withColumn("n_blind", F.coalesce("n_blind", F.lit(0)).cast("long"))
    return scored.withColumn("place", F.row_number().over(W.orderBy(F.col("n_blind") > 0, "cost", "model")))


def shuffled_verdict(real: Column, shuffled: Column) -> Column:
    """How far a score lies above that of shuffled labels."""
    gap = real - shuffled
    return F.when(gap < 0.005, "no signal").when(gap < 0.02, "weak").when(gap < 0.10, "moderate").otherwise("strong")


def tiered(errors: DataFrame, tiers: list[str]) -> DataFrame:
    """Report order: errors by tier, severity and name; what has no tier last."""
    place = reduce(lambda c, kt: c.when(F.col("tier") == kt[1], kt[0]), enumerate(tiers), F.when(F.lit(False), -1))
    return errors.withColumn("place", F.row_number().over(W.orderBy(place.isNull(), place, F.desc("severity"), "true_label", "pred_label")))
