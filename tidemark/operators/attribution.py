"""What a model's signed contributions add up to; a long table of (row_id, feature, class, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.order import least_hashed
from tidemark.operators.splits import times_modulo


def shares(attr: DataFrame, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """(keys, feature, share): percent of the mean absolute contribution."""
    means = attr.groupBy(*keys, "feature").agg(F.avg(F.abs("value")).alias("_m"))
    return means.select(*keys, "feature", (100 * F.try_divide(F.col("_m"), F.sum("_m").over(W.partitionBy(*keys)))).alias("share"))


def stable_shares(attr: DataFrame, boots: int, share: float, seed: int, top: int = 5) -> DataFrame:
    """(feature, mean, std, top_hits, verdict) over samples of exactly round(share * rows) rows, drawn by hash.

    Each sample orders rows by a hash of its own, and its threshold is found from histograms of all
    hashes at once; every contribution is then read once and adds to the samples that have its row.
    solid: among the top in every sample; probable: in at least half; else noise.
    """
    rows = attr.select("row_id").distinct()
    hashes = {f"_h{b}": times_modulo(F.col("row_id"), sample_factor(b + seed)) for b in range(boots)}
    drawn = least_hashed(rows, hashes, "row_id", float(share))
    sums = attr.groupBy("feature").agg(*(x for h, own in drawn.items() for x in (F.sum(F.when(own, F.abs("value"))).alias(f"{h}_s"), F.count(F.when(own, F.col("value"))).alias(f"{h}_n"))))
    each = sums.selectExpr("feature", f"stack({boots}, {', '.join(f'{b}, _h{b}_s, _h{b}_n' for b in range(boots))}) as (boot, s, n)").where("n > 0")
    by_boot = each.select("boot", "feature", (F.col("s") / F.col("n")).alias("_m")).withColumn("share", 100 * F.try_divide(F.col("_m"), F.sum("_m").over(W.partitionBy("boot"))))
    ranked = by_boot.withColumn("_r", F.rank().over(W.partitionBy("boot").orderBy(F.desc("share"))))
    out = ranked.groupBy("feature").agg(F.avg("share").alias("mean"), F.stddev_samp("share").alias("std"), F.count(F.when(F.col("_r") <= top, 1)).alias("top_hits"))
    return out.withColumn("verdict", F.when(F.col("top_hits") == boots, "solid").when(F.col("top_hits") * 2 >= boots, "probable").otherwise("noise"))


def sample_factor(k: int) -> int:
    """The odd factor that orders rows for the k-th sample."""
    return (2654435761 * (2 * k + 1) * (2 * k + 1)) % (1 << 32)


def agreement(by_model: DataFrame, models: list[str], top: int = 5) -> DataFrame:
    """(feature, a share for each model, mean, n_models with it among their top) of (model, feature, share)."""
    ranked = by_model.withColumn("_in", F.rank().over(W.partitionBy("model").orderBy(F.desc("share"))) <= top)
    wide = ranked.groupBy("feature").pivot("model", models).agg(F.max("share"))
    return wide.join(ranked.groupBy("feature").agg(F.avg("share").alias("mean"), F.count(F.when(F.col("_in"), 1)).alias("n_models")), "feature")


def cell_table(attr: DataFrame, rows: DataFrame) -> DataFrame:
    """(true_label, pred_label, feature, value): mean contribution toward the predicted class; rows: (row_id, true_label, pred_label)."""
    toward = attr.join(rows, (attr["row_id"] == rows["row_id"]) & (attr["class"] == rows["pred_label"]))
    return toward.groupBy("true_label", "pred_label", "feature").agg(F.avg("value").alias("value"))


def margin(attr: DataFrame, rows: DataFrame, a: str, b: str) -> DataFrame:
    """(feature, margin): on rows of a taken for b, what each feature adds to b over a on average."""
    wrong = rows.where((F.col("true_label") == a) & (F.col("pred_label") == b)).select("row_id")
    sign = F.when(F.col("class") == b, F.col("value")).when(F.col("class") == a, -F.col("value"))
    by_row = attr.join(wrong, "row_id").groupBy("row_id", "feature").agg(F.sum(sign).alias("_d"))
    return by_row.groupBy("feature").agg(F.avg("_d").alias("margin"))


def row_texts(attr: DataFrame, k: int = 3) -> DataFrame:
    """(row_id, class, text): each row's k largest contributions in size, as feature=value."""
    over = W.partitionBy("row_id", "class").orderBy(F.desc(F.abs("value")), "feature")
    ranked = attr.withColumn("_n", F.row_number().over(over)).where(F.col("_n") <= k)
    listed = ranked.groupBy("row_id", "class").agg(F.array_sort(F.collect_list(F.struct("_n", "feature", "value"))).alias("_l"))
    return listed.select("row_id", "class", F.array_join(F.transform("_l", lambda x: F.concat(x["feature"], F.lit("="), F.format_string("%.3f", x["value"]))), ", ").alias("text"))


def linear_contributions(long: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Exact contributions of a linear model: coefficient * (x - mean); long: (row_id, feature, x), coefficients: (feature, class, coefficient)."""
    means = long.groupBy("feature").agg(F.avg("x").alias("_mean"))
    return long.join(means, "feature").join(coefficients, "feature").select("row_id", "feature", "class", (F.col("coefficient") * (F.col("x") - F.col("_mean"))).alias("value"))


def ignored(shares_: DataFrame, importances: DataFrame, least_share: float = 0.5, least_importance: float = 0.001) -> DataFrame:
    """(feature): below both limits."""
    return shares_.join(importances, "feature").where((F.col("share") < least_share) & (F.col("importance") < least_importance)).select("feature")
