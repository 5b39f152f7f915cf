"""Queries: lookups by name and pair, spans, support tables, rules on names and clocks (J09, J10, A39, P04, P20, Q05, S04, T04)."""

from pyspark.sql import functions as F

from tidemark.operators import clocks as C
from tidemark.operators import columns as N
from tidemark.operators import evaluate as E
from tidemark.operators import windows as O
from tidemark.plans import evaluation as P
from tidemark.plans import trading as T
from tidemark.plans.registry import query, table
from tidemark.sources import readers as R


@query("s04_read_by_extension", "SELECT * FROM orders")
def s04(spark, d):
    return R.read_table(spark, f"{d}/orders.parquet")


@query("p04_bare_names", "SELECT DISTINCT p_type || '__' || p_name AS \"column\", p_name AS bare FROM part")
def p04(spark, d):
    part = table(spark, d, "part")
    return N.bare_names(part.select(F.concat_ws("__", "p_type", "p_name").alias("column")), part, "column", "p_type").withColumnRenamed("name", "column")


@query("p20_schema_changes", "SELECT 'removed' AS what, 'o_extra' AS \"column\" WHERE (SELECT count(*) FROM orders) > 0 UNION ALL SELECT 'retyped', 'o_custkey' WHERE (SELECT count(*) FROM orders) > 0")
def p20(spark, d):
    o = table(spark, d, "orders")
    frozen = [(n, "string" if n == "o_custkey" else "varchar" if t == "string" else t) for n, t in o.dtypes] + [("o_extra", "double")]
    found = N.schema_changes(o.dtypes, frozen)
    return spark.createDataFrame([(k, c) for k, cs in found.items() for c in cs], "what string, column string")


_HELD = T._TRADES + " SELECT version, count(*) AS n_bars, round(sum(b.close), 2) AS close_sum FROM t JOIN b ON b.user_id = t.user_id AND b.ts >= t.entry_ts AND b.ts < t.exit_ts GROUP BY 1"


@query("j09_bars_in_spans", _HELD)
def j09(spark, d):
    """Bars inside each trade's span: both sides are dealt by (user, day), a trade standing in every day that it touches."""
    spans = T.trades(spark, d).select("user_id", "version", "entry_ts", "exit_ts", F.explode(F.sequence(F.to_date("entry_ts"), F.to_date("exit_ts"))).alias("day"))
    bars = T.bars(spark, d).withColumn("day", F.to_date("ts"))
    held = spans.join(bars, ["user_id", "day"]).where((F.col("ts") >= F.col("entry_ts")) & (F.col("ts") < F.col("exit_ts")))
    return held.groupBy("version").agg(F.count(F.lit(1)).alias("n_bars"), F.round(F.sum("close"), 2).alias("close_sum"))


@query("j10_weights_and_severities", f"WITH p AS ({P.PREDICTIONS}) SELECT event_id, CAST(CASE true_label WHEN 'click' THEN 1.5 WHEN 'purchase' THEN 4 ELSE 1 END AS DOUBLE) AS weight, CAST(CASE WHEN pred_label IS NULL THEN NULL ELSE coalesce(s.severity, 1) END AS DOUBLE) AS severity FROM p LEFT JOIN {P._SEV} ON s.t = true_label AND s.p = pred_label")
def j10(spark, d):
    weights = spark.createDataFrame([("click", 1.5), ("purchase", 4.0)], "true_label string, weight double")
    p = P.predictions(spark, d).join(weights, "true_label", "left").join(P.severity(spark), ["true_label", "pred_label"], "left")
    return p.select("event_id", F.coalesce("weight", F.lit(1.0)).alias("weight"), F.when(F.col("pred_label").isNotNull(), F.coalesce("severity", F.lit(1.0))).alias("severity"))


@query("t04_trade_profits", T._TRADES + " SELECT user_id, version, entry_ts, round(points * 10, 4) AS gross, round(points * 10 - 3, 4) AS net FROM t")
def t04(spark, d):
    gross = F.col("points") * 10
    return T.trades(spark, d).select("user_id", "version", "entry_ts", F.round(gross, 4).alias("gross"), F.round(gross - 3, 4).alias("net"))


_CELLS = f"""WITH p AS ({P.PREDICTIONS}), q AS (SELECT * FROM p WHERE pred_label IS NOT NULL), c AS (SELECT DISTINCT true_label AS c FROM q),
x AS (SELECT a.c AS t, b.c AS p, event_id, q.pred_label <> a.c AS wrong FROM c a CROSS JOIN c b JOIN q ON q.true_label = a.c AND (a.c = b.c OR q.pred_label IN (a.c, b.c))),
r AS (SELECT *, row_number() OVER o - sum(CASE WHEN wrong THEN 1 ELSE 0 END) OVER o AS g, sum(CASE WHEN wrong THEN -1 ELSE 1 END) OVER o AS s FROM x WINDOW o AS (PARTITION BY t, p ORDER BY event_id)),
k AS (SELECT t, p, count(DISTINCT g) AS n_streaks, max(n) AS longest FROM (SELECT t, p, g, count(*) AS n FROM r WHERE wrong GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT r.t, r.p, count(*) AS n, count(*) FILTER (WHERE wrong) AS n_wrong, round(avg(CASE WHEN wrong THEN 1.0 ELSE 0.0 END), 6) AS rate, CAST(arg_max(s, event_id) AS BIGINT) AS final_score, any_value(coalesce(n_streaks, 0)) AS n_streaks, any_value(coalesce(longest, 0)) AS longest
FROM r LEFT JOIN k ON k.t = r.t AND k.p = r.p GROUP BY 1, 2"""


def support(spark, d):
    rows = P.predictions(spark, d).where("pred_label is not null").withColumn("chunk", F.floor(F.col("event_id") / 500))
    classes = E.class_names(rows, "true_label", "pred_label")
    pairs = classes.select(F.col("label").alias("t")).crossJoin(classes.select(F.col("label").alias("p")))
    return O.support_table(O.cell_streams(rows, pairs, "true_label", "pred_label"), "event_id", "chunk")


@query("a39_support_table", _CELLS)
def a39(spark, d):
    return support(spark, d).select("t", "p", "n", "n_wrong", "rate", "final_score", "n_streaks", "longest")


@query("a39_cell_drawdowns", _CELLS.partition("k AS (")[0] + """h AS (SELECT *, greatest(0, max(s) OVER (PARTITION BY t, p ORDER BY event_id)) AS peak, max(s) OVER (PARTITION BY t, p) AS top FROM r),
e AS (SELECT t, p, peak, max(peak - s) AS depth, min(event_id) AS first, max(top) > peak AS recovered FROM h WHERE s < peak GROUP BY 1, 2, 3),
f AS (SELECT *, row_number() OVER (PARTITION BY t, p ORDER BY depth DESC, first) AS k FROM e)
SELECT a.t, a.p, count(peak) AS n_drawdowns, CAST(coalesce(max(depth), 0) AS BIGINT) AS deepest, bool_or(recovered) FILTER (WHERE k = 1) AS recovered FROM (SELECT DISTINCT t, p FROM r) a LEFT JOIN f ON a.t = f.t AND a.p = f.p GROUP BY 1, 2""")
def a39b(spark, d):
    return support(spark, d).select("t", "p", "n_drawdowns", "deepest", "recovered")


@query("q05_resolved_clocks", "SELECT p_partkey, CAST(greatest(p_size, 30) AS INTEGER) AS clock, p_size > 30 AS warned FROM part")
def q05(spark, d):
    clock, warning = C.resolve_clock(F.col("p_size"), F.lit(30))
    return table(spark, d, "part").select("p_partkey", clock.cast("int").alias("clock"), warning.isNotNull().alias("warned"))
