"""Queries: runs, streaks, drawdowns, normalisers, sampling (W, L01, S16, Q03, Q10, A30, A31)."""

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators import windows as O
from tidemark.operators.scan import running
from tidemark.plans.registry import query, table
from tidemark.sources import readers as R

_O = "PARTITION BY user_id ORDER BY ts, event_id"
#: The signal is the type but for errors, which are gaps.
_SIG = "CASE WHEN event_type <> 'error' THEN event_type END"
_WRONG = "event_type IN ('error', 'signup')"


def events(spark, d):
    e = table(spark, d, "events")
    return e.withColumns({"sig": F.when(F.col("event_type") != "error", F.col("event_type")), "wrong": F.col("event_type").isin("error", "signup"), "day": F.to_date("ts")})


_FIRES = f"SELECT event_id, sig IS NOT NULL AND sig IS DISTINCT FROM last_value(sig IGNORE NULLS) OVER ({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fire FROM (SELECT *, {_SIG} AS sig FROM events)"


@query("w01_fires", _FIRES)
def w01(spark, d):
    return O.fires(events(spark, d), ["user_id"], ["ts", "event_id"], "sig").select("event_id", "fire")


@query("w01_fires_two_level", _FIRES.replace("PARTITION BY user_id ", ""))
def w01b(spark, d):
    return O.fires(events(spark, d).withColumn("all", F.lit(1)), ["all"], ["ts", "event_id"], "sig", chunk="day").select("event_id", "fire")


@query("w02_onset", f"WITH x AS (SELECT *, lag(event_type) OVER ({_O}) IS DISTINCT FROM event_type AS c FROM events) SELECT event_id, last_value(CASE WHEN c THEN event_id END IGNORE NULLS) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS onset FROM x")
def w02(spark, d):
    return O.onset(events(spark, d), ["user_id"], ["ts", "event_id"], "event_type", "event_id").select("event_id", "onset")


#: All events as one series, in chunks of ids.
_ALL = "ORDER BY event_id"


def one_series(spark, d):
    return events(spark, d).withColumns({"all": F.lit(1), "chunk": F.floor(F.col("event_id") / 500)})


@query("w02_onset_two_level", f"WITH x AS (SELECT *, lag(event_type) OVER ({_ALL}) IS DISTINCT FROM event_type AS c FROM events) SELECT event_id, last_value(CASE WHEN c THEN event_id END IGNORE NULLS) OVER ({_ALL} ROWS UNBOUNDED PRECEDING) AS onset FROM x")
def w02b(spark, d):
    return O.onset(one_series(spark, d), ["all"], ["event_id"], "event_type", "event_id", "chunk").select("event_id", "onset")


_STREAKS = f"WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) - sum(CASE WHEN {_WRONG} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM events), s AS (SELECT user_id, count(*) AS length, min(ts) AS first, max(ts) AS last FROM x WHERE {_WRONG} GROUP BY user_id, g)"


@query("w03_losing_streaks", _STREAKS + " SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY length DESC, first) AS INTEGER) AS place FROM s")
def w03(spark, d):
    return O.losing_streaks(events(spark, d), ["user_id"], "ts", "wrong")


@query("w03_losing_streaks_two_level", f"WITH x AS (SELECT *, row_number() OVER ({_ALL}) - sum(CASE WHEN {_WRONG} THEN 1 ELSE 0 END) OVER ({_ALL}) AS g FROM events), s AS (SELECT count(*) AS length, min(event_id) AS first, max(event_id) AS last FROM x WHERE {_WRONG} GROUP BY g) SELECT *, CAST(row_number() OVER (ORDER BY length DESC, first) AS INTEGER) AS place FROM s")
def w03b(spark, d):
    return O.losing_streaks(one_series(spark, d), ["all"], "event_id", "wrong", "chunk").drop("all")


_SCORES = f"WITH x AS (SELECT *, sum(CASE WHEN {_WRONG} THEN -1 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM events), p AS (SELECT *, greatest(max(s) OVER (PARTITION BY user_id ORDER BY ts), 0) AS peak, max(s) OVER (PARTITION BY user_id) AS top FROM x)"


@query("w04_score_drawdowns", _SCORES + " SELECT user_id, CAST(max(peak - s) AS BIGINT) AS depth, min(ts) AS first, max(ts) AS last, max(top) > peak AS recovered FROM p WHERE s < peak GROUP BY user_id, peak")
def w04(spark, d):
    return O.score_drawdowns(events(spark, d), ["user_id"], "ts", "wrong")


@query("w04_score_drawdowns_two_level", _SCORES + " SELECT user_id, CAST(max(peak - s) AS BIGINT) AS depth, min(ts) AS first, max(ts) AS last, max(top) > peak AS recovered FROM p WHERE s < peak GROUP BY user_id, peak")
def w04b(spark, d):
    return O.score_drawdowns(events(spark, d), ["user_id"], "ts", "wrong", chunk="day")


_EQUITY = "WITH x AS (SELECT *, round(sum(CASE WHEN event_type = 'purchase' THEN value WHEN event_type = 'error' THEN -value ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts), 4) AS equity FROM events), p AS (SELECT *, greatest(max(equity) OVER (PARTITION BY user_id ORDER BY ts), 0) AS peak FROM x)"


def equity(spark, d):
    from pyspark.sql import Window as W

    gain = F.when(F.col("event_type") == "purchase", F.col("value")).when(F.col("event_type") == "error", -F.col("value")).otherwise(0.0)
    over = W.partitionBy("user_id").orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    return events(spark, d).withColumn("equity", F.round(F.sum(gain).over(over), 4))


@query("w05_money_drawdown", _EQUITY + ", q AS (SELECT *, equity - peak AS dd FROM p), r AS (SELECT *, sum(CASE WHEN dd < 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM q) SELECT user_id, round(min(dd), 3) AS trough, min(ts) AS first, max(ts) AS last, count(*) AS n_rows FROM r WHERE dd < 0 GROUP BY user_id, g")
def w05(spark, d):
    x = O.drawdown_episodes(equity(spark, d), ["user_id"], "ts", "equity")
    return x.select("user_id", F.round("trough", 3).alias("trough"), "first", "last", "n_rows")


@query("w05_money_drawdown_two_level", _EQUITY.replace("PARTITION BY user_id ORDER BY ts", _ALL) + f", q AS (SELECT *, equity - peak AS dd FROM p), r AS (SELECT *, sum(CASE WHEN dd < 0 THEN 0 ELSE 1 END) OVER ({_ALL}) AS g FROM q) SELECT round(min(dd), 3) AS trough, min(event_id) AS first, max(event_id) AS last, count(*) AS n_rows FROM r WHERE dd < 0 GROUP BY g")
def w05b(spark, d):
    gain = F.when(F.col("event_type") == "purchase", F.col("value")).when(F.col("event_type") == "error", -F.col("value")).otherwise(0.0)
    summed = running(one_series(spark, d).withColumn("gain", gain), ["all"], "chunk", ["event_id"], {"equity": ("sum", "gain")}).withColumn("equity", F.round("equity", 4))
    return O.drawdown_episodes(summed, ["all"], "event_id", "equity", "chunk").select(F.round("trough", 3).alias("trough"), "first", "last", "n_rows")


@query("w06_cell_streams", """
WITH p AS (SELECT event_id, user_id, ts, event_type AS t, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
c AS (SELECT DISTINCT event_type AS c FROM events)
SELECT a.c AS t, b.c AS p, count(*) AS n, count(*) FILTER (WHERE x.p <> x.t) AS n_wrong FROM c a CROSS JOIN c b JOIN p x ON x.t = a.c AND (a.c = b.c OR x.p IN (a.c, b.c)) WHERE x.p IS NOT NULL GROUP BY 1, 2""")
def w06(spark, d):
    from tidemark.operators.evaluate import class_names
    from tidemark.plans.evaluation import predictions

    rows = predictions(spark, d).where("pred_label is not null")
    classes = class_names(rows, "true_label", "pred_label")
    pairs = classes.select(F.col("label").alias("t")).crossJoin(classes.select(F.col("label").alias("p")))
    return O.cell_streams(rows, pairs, "true_label", "pred_label").groupBy("t", "p").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("wrong"), 1)).alias("n_wrong"))


@query("w07_returns", f"SELECT event_id, round(lead(value, 5) OVER ({_O}) / value - 1, 5) AS fwd_5, round(value / lag(value, 5) OVER ({_O}) - 1, 5) AS past_5 FROM (SELECT event_id, user_id, ts, value + 1 AS value FROM events)")
def w07(spark, d):
    x = O.returns(events(spark, d).withColumn("value", F.col("value") + 1), ["user_id"], ["ts", "event_id"], "value", (5,))
    return x.select("event_id", F.round("fwd_5", 5).alias("fwd_5"), F.round("past_5", 5).alias("past_5"))


@query("w08_running_id_share", "WITH x AS (SELECT event_id >= max(event_id) OVER (PARTITION BY user_id ORDER BY ts) AS a, value >= max(value) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events) SELECT 'event_id' AS \"column\", round(avg(CASE WHEN a THEN 1.0 ELSE 0.0 END), 6) AS share FROM x UNION ALL SELECT 'value', round(avg(CASE WHEN b THEN 1.0 ELSE 0.0 END), 6) FROM x")
def w08(spark, d):
    return Q.running_id_share(events(spark, d), ["user_id"], ["event_id", "value"], ["ts"])


@query("w09_bounded_fill", f"SELECT event_id, last_value(v IGNORE NULLS) OVER ({_O} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS v FROM (SELECT *, CASE WHEN event_type = 'click' THEN value END AS v FROM events)")
def w09(spark, d):
    from tidemark.operators.missing import fill_forward

    x = events(spark, d).withColumn("v", F.when(F.col("event_type") == "click", F.col("value")))
    return fill_forward(x, ["v"], ["user_id"], ["ts", "event_id"], 3).select("event_id", "v")


@query("w11_normalised", """
SELECT event_id, round((value - avg(value) OVER u) / stddev_pop(value) OVER u, 5) AS z, round((value - min(value) OVER u) / (max(value) OVER u - min(value) OVER u), 5) AS minmax,
 round(CASE WHEN lag(value) OVER o <> 0 THEN value / lag(value) OVER o - 1 END, 5) AS change, round(CASE WHEN first_value(value) OVER o > 0 THEN value / first_value(value) OVER o * 100 END, 5) AS first100,
 round((rank() OVER (PARTITION BY user_id ORDER BY value) + (count(*) OVER (PARTITION BY user_id, value) - 1) / 2.0) / count(*) OVER u * 100, 5) AS rank100
FROM events WINDOW u AS (PARTITION BY user_id), o AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w11(spark, d):
    x = O.normalised(events(spark, d), ["user_id"], ["ts", "event_id"], "value")
    return x.select("event_id", *(F.round(c, 5).alias(c) for c in ("z", "minmax", "change", "first100", "rank100")))


@query("w11_normalised_two_level", """
SELECT event_id, round((value - avg(value) OVER u) / stddev_pop(value) OVER u, 5) AS z, round((value - min(value) OVER u) / (max(value) OVER u - min(value) OVER u), 5) AS minmax,
 round(CASE WHEN lag(value) OVER o <> 0 THEN value / lag(value) OVER o - 1 END, 5) AS change, round(CASE WHEN first_value(value) OVER o > 0 THEN value / first_value(value) OVER o * 100 END, 5) AS first100,
 round((rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0) / count(*) OVER u * 100, 5) AS rank100
FROM events WINDOW u AS (), o AS (ORDER BY event_id)""")
def w11b(spark, d):
    x = O.normalised(one_series(spark, d), ["all"], ["event_id"], "value", "chunk")
    return x.select("event_id", *(F.round(c, 5).alias(c) for c in ("z", "minmax", "change", "first100", "rank100")))


@query("w12_row_ids", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS unique_index FROM events")
def w12(spark, d):
    return R.row_ids(events(spark, d).select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "unique_index")


@query("w14_running_sum_two_level", "SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS total, max(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS top FROM events")
def w14(spark, d):
    x = events(spark, d).withColumn("all", F.lit(1))
    return running(x, ["all"], "day", ["ts", "event_id"], {"total": ("sum", "value"), "top": ("max", "value")}).select("event_id", F.round("total", 2).alias("total"), "top")


@query("w15_keep_last", "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def w15(spark, d):
    return O.keep_one(events(spark, d), ["user_id", "event_type"], ["ts"]).select("user_id", "event_type", "event_id")


@query("w16_sessions", "SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS session, day FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)")
def w16(spark, d):
    return O.sessions(events(spark, d))


@query("w17_top_streak_texts", _STREAKS + ", r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY length DESC, first) AS n FROM s) SELECT user_id, max(CASE WHEN n = 1 THEN length || ' to ' || strftime(last, '%Y-%m-%d') END) AS streak_1, max(CASE WHEN n = 2 THEN length || ' to ' || strftime(last, '%Y-%m-%d') END) AS streak_2 FROM r GROUP BY 1")
def w17(spark, d):
    s = O.losing_streaks(events(spark, d), ["user_id"], "ts", "wrong")
    text = F.concat(F.col("length").cast("string"), F.lit(" to "), F.date_format("last", "yyyy-MM-dd"))
    return O.top_texts(s, ["user_id"], [F.desc("length"), F.col("first")], text, 2, "streak")


@query("w18_marker_places", "SELECT event_id, round(value + CASE WHEN event_type = 'purchase' THEN -1 ELSE 1 END * 0.02 * (max(value) OVER (PARTITION BY user_id) - min(value) OVER (PARTITION BY user_id)), 5) AS place FROM events")
def w18(spark, d):
    from pyspark.sql import Window as W

    u = W.partitionBy("user_id")
    pad = 0.02 * (F.max("value").over(u) - F.min("value").over(u))
    return events(spark, d).select("event_id", F.round(F.col("value") + F.when(F.col("event_type") == "purchase", -1).otherwise(1) * pad, 5).alias("place"))


@query("w19_thinned", f"WITH x AS (SELECT event_id, row_number() OVER ({_O}) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT event_id FROM x WHERE i % greatest(1, CAST(ceil(n / 20.0) AS BIGINT)) = 0 OR i = n - 1")
def w19(spark, d):
    return O.thin(events(spark, d), ["user_id"], ["ts", "event_id"], 20).select("event_id")


@query("w20_evenly_spaced", f"WITH x AS (SELECT event_id, user_id, row_number() OVER ({_O}) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), k AS (SELECT unnest(range(10)) AS k) SELECT DISTINCT event_id FROM x JOIN k ON n <= 10 OR i = CAST(floor(k * (n - 1) / 9) AS BIGINT)")
def w20(spark, d):
    return O.evenly_spaced(events(spark, d), ["user_id"], ["ts", "event_id"], 10).select("event_id")


@query("l01_unsorted_rows", "SELECT count(*) AS n FROM (SELECT l_shipdate < lag(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_shipdate) AS x FROM lineitem) WHERE x")
def l01(spark, d):
    from pyspark.sql import Window as W

    over = W.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    x = table(spark, d, "lineitem").select((F.col("l_shipdate") < F.lag("l_shipdate").over(over)).alias("x"))
    return x.where("x").agg(F.count(F.lit(1)).alias("n"))


@query("s16_most_recent", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def s16(spark, d):
    return R.most_recent(events(spark, d).select("event_id", "ts"), 100, ["ts", "event_id"])


@query("q03_dedupe_conflicts", "SELECT user_id, event_type, min(value) AS value, count(DISTINCT value) > 1 AS conflict FROM events GROUP BY 1, 2")
def q03(spark, d):
    return R.dedupe(events(spark, d), ["user_id", "event_type"], ["value"])


@query("q10_breaks", "WITH x AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 60000000.0 AS s FROM events) SELECT user_id, count(*) AS n_rows, count(*) FILTER (WHERE s > 600) AS n_breaks, round(max(s), 4) AS longest_minutes FROM x GROUP BY 1")
def q10(spark, d):
    return Q.breaks(events(spark, d), ["user_id"], 600)


@query("a30_modal_interval", "WITH x AS (SELECT user_id, floor((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 3600000000.0) AS h FROM events), c AS (SELECT user_id, h, count(*) AS n FROM x WHERE h > 0 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, h) AS k FROM c) SELECT user_id, CAST(h AS BIGINT) AS hours, n FROM r WHERE k = 1")
def a30(spark, d):
    from pyspark.sql import Window as W

    from tidemark.functions.timebars import epoch_micros

    step = F.floor((epoch_micros(F.col("ts")) - epoch_micros(F.lag("ts").over(W.partitionBy("user_id").orderBy("ts")))) / 3_600_000_000)
    c = events(spark, d).select("user_id", step.alias("hours")).where("hours > 0").groupBy("user_id", "hours").agg(F.count(F.lit(1)).alias("n"))
    return O.keep_one(c.withColumn("_back", -F.col("hours")), ["user_id"], ["n", "_back"]).select("user_id", "hours", "n")


@query("a31_session_hours", "SELECT CAST(ts AS DATE) AS day, CAST(min(hour(ts) * 60 + minute(ts)) AS INTEGER) AS opens, CAST(max(hour(ts) * 60 + minute(ts)) AS INTEGER) AS closes, isodow(CAST(ts AS DATE)) >= 6 AS weekend FROM events GROUP BY 1")
def a31(spark, d):
    from tidemark.functions.timebars import minute_of_day

    return events(spark, d).groupBy("day").agg(F.min(minute_of_day(F.col("ts"))).alias("opens"), F.max(minute_of_day(F.col("ts"))).alias("closes")).withColumn("weekend", F.weekday("day") >= 5)
