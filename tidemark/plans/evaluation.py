"""Queries: class shares, mistakes, confusion, scores per class, baselines (A05-A14, A32, A33, A40, L, P14, P21, U08)."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators import evaluate as E
from tidemark.plans.registry import query, table

#: Truth is the event's type, the prediction is the user's next event's type; the model is a third of the ids.
PREDICTIONS = "SELECT event_id, event_id % 3 AS model, event_type AS true_label, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pred_label, value FROM events"
CLASSES = ["click", "error", "purchase", "signup", "view"]
SEVERITIES = [("purchase", "error", 90.0), ("error", "purchase", 60.0), ("view", "click", 2.0), ("click", "view", 3.0), ("signup", "error", 50.0)]
_SEV = "(VALUES " + ", ".join(f"('{a}', '{b}', {c})" for a, b, c in SEVERITIES) + ") AS s(t, p, severity)"
_WITH = f"WITH p AS ({PREDICTIONS})"
_MISTAKES = f"""{_WITH},
c AS (SELECT true_label, pred_label, count(*) AS n FROM p WHERE pred_label IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, sum(n) OVER (PARTITION BY true_label) AS n_true FROM c),
x AS (SELECT m.true_label, m.pred_label, n, CAST(n_true AS BIGINT) AS n_true, CAST(coalesce(s.severity, 1) AS DOUBLE) AS severity, n * 1.0 / n_true AS r
      FROM m LEFT JOIN {_SEV} ON s.t = m.true_label AND s.p = m.pred_label WHERE m.true_label <> m.pred_label)"""


def predictions(spark, d):
    over = W.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", (F.col("event_id") % 3).alias("model"), F.col("event_type").alias("true_label"), F.lead("event_type").over(over).alias("pred_label"), "value")


def severity(spark):
    return spark.createDataFrame(SEVERITIES, "true_label string, pred_label string, severity double")


def mistakes(spark, d):
    return E.rank_mistakes(predictions(spark, d), "true_label", "pred_label", severity(spark))


@query("a05_class_shares", "SELECT o_orderstatus AS label, count(*) AS n, round(avg(o_totalprice), 6) AS mean_weight, round(avg(CASE WHEN o_totalprice = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1")
def a05(spark, d):
    return E.class_shares(table(spark, d, "orders"), "o_orderstatus", "o_totalprice").withColumn("mean_weight", F.round("mean_weight", 6))


@query("a06_weight_drift", "WITH n AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1), b AS (SELECT *, sum(n) OVER () * 1.0 / (count(*) OVER () * n) AS balanced FROM n) SELECT label, n, round(balanced, 6) AS balanced, CASE WHEN label <> 'view' THEN round(abs(1.1 - balanced) / balanced, 6) END AS drift, CASE WHEN label = 'view' THEN true ELSE abs(1.1 - balanced) / balanced > 0.1 END AS flagged FROM b")
def a06(spark, d):
    weights = spark.createDataFrame([(c, 1.1) for c in CLASSES if c != "view"], "label string, weight double")
    return E.weight_drift(table(spark, d, "events"), "event_type", weights, 0.1)


@query("a07_rank_mistakes", _MISTAKES + " SELECT true_label, pred_label, n, n_true, round_even(r, 6) AS rate, severity, round_even(r * severity, 4) AS importance FROM x")
def a07(spark, d):
    return mistakes(spark, d)


@query("a08_trading_cost", _MISTAKES + " SELECT round_even(sum(round_even(r * severity, 4)), 4) AS cost FROM x")
def a08(spark, d):
    return E.trading_cost(mistakes(spark, d))


@query("a09_worst_case", _MISTAKES + " SELECT true_label, pred_label, n, severity FROM x WHERE severity >= 50")
def a09(spark, d):
    return E.worst_case(mistakes(spark, d), 50).select("true_label", "pred_label", "n", "severity")


_CONFUSION = ", ".join(f"count(*) FILTER (WHERE pred_label = '{c}') AS \"{c}\"" for c in CLASSES)


@query("a10_confusion", f"{_WITH}, q AS (SELECT * FROM p WHERE pred_label IS NOT NULL) SELECT true_label, {_CONFUSION}, count(*) AS \"TOTAL\" FROM q GROUP BY 1 UNION ALL SELECT 'TOTAL', {_CONFUSION}, count(*) FROM q")
def a10(spark, d):
    return E.confusion(predictions(spark, d), "true_label", "pred_label", CLASSES)


@query("a10_expand_counts", "SELECT l_returnflag, l_linestatus FROM lineitem")
def a10b(spark, d):
    return E.expand(table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")))


@query("a11_agreement", f"{_WITH} SELECT count(*) AS n_rows, count(true_label) AS n_true, count(pred_label) AS n_pred, count(pred_label) AS n_compared, count(*) FILTER (WHERE true_label = pred_label) AS n_match, count(pred_label) - count(*) FILTER (WHERE true_label = pred_label) AS n_mismatch, round_even(count(*) FILTER (WHERE true_label = pred_label) * 1.0 / count(pred_label), 6) AS accuracy FROM p")
def a11(spark, d):
    return E.agreement(predictions(spark, d), "true_label", "pred_label")


_PER_CLASS = f"""{_WITH}, q AS (SELECT * FROM p WHERE pred_label IS NOT NULL),
a AS (SELECT true_label AS label, count(*) AS support, count(*) FILTER (WHERE true_label = pred_label) AS hit FROM q GROUP BY 1),
b AS (SELECT pred_label AS label, count(*) AS claimed FROM q GROUP BY 1),
s AS (SELECT a.label, support, hit * 1.0 / claimed AS pr, hit * 1.0 / support AS re FROM a JOIN b USING (label)),
f AS (SELECT *, 2 * pr * re / (pr + re) AS f1 FROM s)
SELECT label, support, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1 FROM f
UNION ALL SELECT 'MACRO', CAST(sum(support) AS BIGINT), round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6) FROM f"""


@query("a12_per_class", _PER_CLASS)
def a12(spark, d):
    return E.per_class(predictions(spark, d), "true_label", "pred_label")


_SOME = f"""{_WITH}, q AS (SELECT true_label AS t, CASE WHEN pred_label = 'click' THEN 'none' ELSE pred_label END AS p FROM p WHERE pred_label IS NOT NULL),
k AS (SELECT t AS label FROM q UNION SELECT p FROM q),
c AS (SELECT label, (SELECT count(*) FROM q WHERE t = label) AS support, (SELECT count(*) FROM q WHERE p = label) AS claimed, (SELECT count(*) FROM q WHERE t = label AND p = label) AS hit FROM k),
s AS (SELECT label, support, hit * 1.0 / nullif(claimed, 0) AS pr, hit * 1.0 / nullif(support, 0) AS re FROM c),
f AS (SELECT *, CASE WHEN pr > 0 AND re > 0 THEN 2 * pr * re / (pr + re) END AS f1 FROM s),
"""
_ALL_CLASSES = """ SELECT label, support, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1 FROM g
UNION ALL SELECT 'MACRO', CAST(sum(support) AS BIGINT), round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6) FROM g"""


def some_unclaimed(spark, d):
    """Predictions in which one class is never predicted and one that doesn't exist is."""
    return predictions(spark, d).withColumn("pred_label", F.when(F.col("pred_label") == "click", "none").otherwise(F.col("pred_label")))


@query("a12_per_class_undefined", _SOME + "g AS (SELECT * FROM f)" + _ALL_CLASSES)
def a12u(spark, d):
    return E.per_class(some_unclaimed(spark, d), "true_label", "pred_label")


@query("a12_per_class_zero", _SOME + "g AS (SELECT label, support, coalesce(pr, 0) AS pr, coalesce(re, 0) AS re, coalesce(f1, 0) AS f1 FROM f)" + _ALL_CLASSES)
def a12z(spark, d):
    return E.per_class(some_unclaimed(spark, d), "true_label", "pred_label", zero=True)


@query("a13_average_precision", """
WITH x AS (SELECT lang, n_chars, quality FROM documents JOIN labels USING (doc_id)),
g AS (SELECT lang, n_chars, count(*) AS n, sum(quality) AS tp FROM x GROUP BY 1, 2),
w AS (SELECT *, sum(tp) OVER (PARTITION BY lang) AS total, sum(tp) OVER o AS ctp, sum(n) OVER o AS cn FROM g WINDOW o AS (PARTITION BY lang ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING))
SELECT lang, round(sum(tp * 1.0 / total * ctp / cn), 6) AS ap FROM w GROUP BY 1""")
def a13(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return E.average_precision(x, "n_chars", "quality", ["lang"])


@query("a14_never_predicted", "SELECT DISTINCT o_orderstatus AS label FROM orders WHERE o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem)")
def a14(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("t"), F.lit(None).cast("string").alias("p"))
    p = table(spark, d, "lineitem").select(F.lit(None).cast("string").alias("t"), F.col("l_linestatus").alias("p"))
    return E.never_predicted(o.union(p), "t", "p")


_COSTS = f"""{_WITH},
c AS (SELECT model, true_label, pred_label, count(*) AS n FROM p WHERE pred_label IS NOT NULL GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY model, true_label) AS n_true FROM c),
k AS (SELECT model, round_even(sum(CASE WHEN true_label <> pred_label THEN round_even(n * 1.0 / n_true * coalesce(s.severity, 1), 4) ELSE 0 END), 4) AS cost FROM m LEFT JOIN {_SEV} ON s.t = true_label AND s.p = pred_label GROUP BY 1)
SELECT model, cost, CAST(0 AS BIGINT) AS n_blind, CAST(row_number() OVER (ORDER BY cost, model) AS INTEGER) AS place FROM k"""


@query("a32_champion", _COSTS)
def a32(spark, d):
    p = predictions(spark, d)
    counts = p.where("pred_label is not null").groupBy("model", "true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"))
    rate = F.col("n") / F.sum("n").over(W.partitionBy("model", "true_label"))
    costed = counts.withColumn("rate", rate).where("true_label <> pred_label").join(severity(spark), ["true_label", "pred_label"], "left")
    costed = costed.withColumn("importance", F.bround(F.col("rate") * F.coalesce("severity", F.lit(1.0)), 4))
    truth = p.select("model", F.col("true_label").alias("label")).distinct()
    blind = truth.join(p.select("model", F.col("pred_label").alias("label")).distinct(), ["model", "label"], "left_anti").groupBy("model").agg(F.count(F.lit(1)).alias("n_blind"))
    return E.champions(E.trading_cost(costed, ["model"]), blind)


@query("a33_majority_baseline", "WITH n AS (SELECT event_type AS t, count(*) AS n FROM events GROUP BY 1), b AS (SELECT arg_max(t, n) AS baseline FROM n) SELECT baseline, count(*) AS n_rows, count(*) FILTER (WHERE event_type = baseline) AS n_match FROM events, b GROUP BY 1")
def a33(spark, d):
    x = E.majority_baseline(table(spark, d, "events"), "event_type")
    return x.groupBy("baseline").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("event_type") == F.col("baseline"), 1)).alias("n_match"))


@query("a33_shuffled_verdict", "WITH p AS (SELECT p_partkey, p_size / 200.0 AS a, (p_size % 7) / 100.0 AS b FROM part) SELECT p_partkey, CASE WHEN a - b < 0.005 THEN 'no signal' WHEN a - b < 0.02 THEN 'weak' WHEN a - b < 0.10 THEN 'moderate' ELSE 'strong' END AS verdict FROM p")
def a33v(spark, d):
    return table(spark, d, "part").select("p_partkey", E.shuffled_verdict(F.col("p_size") / 200.0, (F.col("p_size") % 7) / 100.0).alias("verdict"))


@query("a40_change_text", f"{_WITH}, n AS (SELECT true_label, pred_label, count(*) FILTER (WHERE model = 0) AS was, count(*) FILTER (WHERE model = 1) AS now FROM p WHERE pred_label IS NOT NULL GROUP BY 1, 2) SELECT true_label, pred_label, was || '-' || now AS change FROM n")
def a40(spark, d):
    n = predictions(spark, d).where("pred_label is not null").groupBy("true_label", "pred_label").agg(F.count(F.when(F.col("model") == 0, 1)).alias("was"), F.count(F.when(F.col("model") == 1, 1)).alias("now"))
    return n.select("true_label", "pred_label", F.concat_ws("-", "was", "now").alias("change"))


@query("p14_mismatches", f"{_WITH} SELECT event_id FROM p WHERE true_label <> pred_label")
def p14(spark, d):
    return predictions(spark, d).where(E.comparable("true_label", "pred_label") & (F.col("true_label") != F.col("pred_label"))).select("event_id")


@query("p21_confidence_floor", f"{_WITH} SELECT event_id, CASE WHEN value >= 5 THEN pred_label END AS pred_label, value < 5 AND pred_label IS NOT NULL AS hidden FROM p")
def p21(spark, d):
    return predictions(spark, d).select("event_id", F.when(F.col("value") >= 5, F.col("pred_label")).alias("pred_label"), ((F.col("value") < 5) & F.col("pred_label").isNotNull()).alias("hidden"))


@query("l02_top_mistakes", _MISTAKES + " SELECT true_label, pred_label, importance FROM (SELECT *, round_even(r * severity, 4) AS importance FROM x) ORDER BY importance DESC, true_label, pred_label LIMIT 5")
def l02(spark, d):
    return mistakes(spark, d).orderBy(F.desc("importance"), "true_label", "pred_label").limit(5).select("true_label", "pred_label", "importance")


@query("l03_report_order", _MISTAKES + ", t AS (SELECT *, CASE WHEN severity >= 60 THEN 'red' WHEN severity >= 3 THEN 'amber' END AS tier FROM x) SELECT true_label, pred_label, tier, CAST(row_number() OVER (ORDER BY tier IS NULL, CASE tier WHEN 'red' THEN 0 ELSE 1 END, severity DESC, true_label, pred_label) AS INTEGER) AS place FROM t")
def l03(spark, d):
    m = mistakes(spark, d).withColumn("tier", F.when(F.col("severity") >= 60, "red").when(F.col("severity") >= 3, "amber"))
    return E.tiered(m, ["red", "amber"]).select("true_label", "pred_label", "tier", "place")


@query("l04_best_and_worst", "SELECT arg_max(n_nationkey, bal) AS best, arg_min(n_nationkey, bal) AS worst FROM (SELECT c_nationkey AS n_nationkey, sum(c_acctbal) AS bal FROM customer GROUP BY 1)")
def l04(spark, d):
    n = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.sum("c_acctbal").alias("bal"))
    return n.agg(F.max_by("n", "bal").alias("best"), F.min_by("n", "bal").alias("worst"))


@query("u08_class_union", "SELECT DISTINCT o_orderstatus AS label FROM orders UNION SELECT l_linestatus FROM lineitem")
def u08(spark, d):
    a, b = table(spark, d, "orders").select(F.col("o_orderstatus").alias("t")), table(spark, d, "lineitem").select(F.col("l_linestatus").alias("p"))
    return E.class_names(a.unionByName(b, allowMissingColumns=True), "t", "p")
