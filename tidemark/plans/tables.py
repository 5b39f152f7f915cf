"""Queries: columns, filters, missing values, quality, leaks, catalogs, files (P, M, Q, U, S, A15, A34, A36)."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators import catalog as K
from tidemark.operators import columns as C
from tidemark.operators import missing as M
from tidemark.operators import quality as Q
from tidemark.plans.registry import query, table
from tidemark.sources import readers as R


def events(spark, d):
    return table(spark, d, "events")


@query("s01_time_keyed_scan", "SELECT o_orderkey, o_orderdate AS ts FROM orders WHERE o_orderdate IS NOT NULL")
def s01(spark, d):
    return R.time_keyed(table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("Timestamp")))


@query("s03_label_scan", "SELECT DISTINCT ON (date_trunc('minute', ts)) date_trunc('minute', ts) AS ts, upper(event_type) AS label, value AS weight FROM events ORDER BY date_trunc('minute', ts), event_id")
def s03(spark, d):
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    first = events(spark, d).withColumn("m", minute).withColumn("n", F.row_number().over(W.partitionBy("m").orderBy("event_id"))).where("n = 1")
    raw = first.select(F.date_format("m", "dd-MM-yyyy HH:mm").alias("t"), F.concat(F.upper("event_type"), F.lit(" ")).alias("label"), F.col("value").cast("string").alias("w"))
    return R.clean_labels(raw, "t", "label", "w")


@query("s05_signals", "SELECT ts, upper(event_type) AS sig FROM events WHERE user_id % 2 = 0")
def s05(spark, d):
    split = F.when(F.col("user_id") % 2 == 0, " Test").otherwise("train")
    return R.signals(events(spark, d).withColumn("split", split), "ts", "event_type", "split")


@query("s10_split_accuracy", "WITH p AS (SELECT event_id % 5 AS k, event_type AS t, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) SELECT CASE WHEN k = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows, round_even(count(*) FILTER (WHERE t = p) * 1.0 / count(p), 6) AS accuracy FROM p GROUP BY 1")
def s10(spark, d):
    from tidemark.plans.evaluation import predictions

    p = predictions(spark, d).withColumn("split", F.when(F.col("event_id") % 5 == 0, "test").otherwise("train"))
    same = F.col("true_label") == F.col("pred_label")
    return p.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.bround(F.count(F.when(same, 1)) / F.count("pred_label"), 6).alias("accuracy"))


@query("s11_export_predictions", "WITH p AS (SELECT event_id, event_type AS true_label, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pred_label FROM events) SELECT *, CASE WHEN pred_label IS NULL THEN NULL WHEN true_label = pred_label THEN 'YES' ELSE 'NO' END AS correct FROM p")
def s11(spark, d):
    from tidemark.plans.evaluation import predictions

    return R.export_predictions(predictions(spark, d).select("event_id", "true_label", "pred_label"), "true_label", "pred_label")


@query("s06_price_columns", "SELECT p_partkey, p_retailprice AS price FROM part")
def s06(spark, d):
    part = table(spark, d, "part")
    role = C.detect_roles(part.columns, {"price": ["price", "close", "retailprice"]})
    return part.select("p_partkey", F.col(role["price"]).cast("double").alias("price"))


@query("p01_keep_columns", "SELECT n_nationkey, n_name FROM nation")
def p01(spark, d):
    return C.keep_columns(table(spark, d, "nation"), ["n_name", "n_nationkey", "missing"])[0]


@query("p02_prefixed", "SELECT p_partkey, p_name AS part__p_name, p_size AS part__p_size FROM part")
def p02(spark, d):
    return C.prefixed(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), "part", ["p_partkey"])


@query("p03_drop_list", "SELECT s_suppkey, s_name FROM supplier")
def p03(spark, d):
    df = C.prefixed(table(spark, d, "supplier"), "sup", ["s_suppkey", "s_name"])
    found, _ = C.resolve_drops(df.columns, ["s_acctbal", "sup__s_nationkey", "gone"])
    return df.drop(*found)


@query("p05_time_range", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06 12:00:00'")
def p05(spark, d):
    import datetime as dt

    return C.between_times(events(spark, d), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6, 12)).select("event_id")


@query("p06_within_day", "SELECT event_id FROM events WHERE hour(ts) * 60 + minute(ts) BETWEEN 555 AND 930")
def p06(spark, d):
    return C.within_day(events(spark, d), 555, 930).select("event_id")


@query("p07_last_sessions", "SELECT event_id FROM events WHERE CAST(ts AS DATE) >= (SELECT min(day) FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events ORDER BY 1 DESC LIMIT 4))")
def p07(spark, d):
    return C.last_sessions(events(spark, d), 4).select("event_id")


@query("p08_without_classes", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup')")
def p08(spark, d):
    return C.without_classes(events(spark, d), "event_type", ["error", "signup"]).select("event_id")


@query("p09_known_labels", "SELECT event_id FROM events WHERE event_type IN ('click', 'view')")
def p09(spark, d):
    known = spark.createDataFrame([("click",), ("view",)], "event_type string")
    return events(spark, d).join(known, "event_type", "left_semi").select("event_id")


@query("p10_common_span", "SELECT event_id FROM events WHERE ts BETWEEN (SELECT greatest((SELECT min(ts) FROM events WHERE event_type = 'click'), (SELECT min(ts) FROM events WHERE user_id = 7))) AND (SELECT least((SELECT max(ts) FROM events WHERE event_type = 'click'), (SELECT max(ts) FROM events WHERE user_id = 7)))")
def p10(spark, d):
    e = events(spark, d)
    return C.clip_to_common_span(e, [e.where("event_type = 'click'"), e.where("user_id = 7")]).select("event_id")


@query("p12_without_calendar", "SELECT o_orderkey, o_totalprice FROM orders")
def p12(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", F.year("o_orderdate").alias("cal__Year"))
    return C.without_calendar(o, ["o_orderkey"])


@query("p13_label_events", "SELECT doc_id, toxic FROM labels WHERE toxic IN (1)")
def p13(spark, d):
    return table(spark, d, "labels").where(F.col("toxic").isNotNull() & F.col("toxic").isin(1)).select("doc_id", "toxic")


@query("p15_search_columns", "SELECT DISTINCT p_name AS \"column\" FROM part WHERE lower(p_name) LIKE '%re%' AND lower(p_name) LIKE '%w%'")
def p15(spark, d):
    return C.search_columns(table(spark, d, "part").select(F.col("p_name").alias("column")).distinct(), "RE w")


@query("p16_detected_roles", "SELECT o_orderkey, o_orderdate AS ts, o_orderstatus AS label FROM orders")
def p16(spark, d):
    o = table(spark, d, "orders")
    role = C.detect_roles(o.columns, {"ts": ["date", "orderdate"], "label": ["status", "orderstatus"]})
    return o.select("o_orderkey", F.col(role["ts"]).alias("ts"), F.col(role["label"]).alias("label"))


@query("p16_detected_schema", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS \"timestamp\", value AS \"close\", value - 1 AS \"low\", event_type AS predicted, user_id % 3 AS target FROM events")
def p16b(spark, d):
    """Names that clash and values that decide: open interest is no opening price, scores and fractions are no labels, a text of times is the timestamp."""
    e = events(spark, d)
    x = e.select("event_id", "user_id", F.col("user_id").alias("Open Interest"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("bar ends"), F.col("value").alias("Adj Close"), (F.col("value") - 1).alias("Low Price"), (F.col("value") / 100).alias("pred_confidence"), (F.col("value") * 2).alias("prediction"), F.col("event_type").alias("Predicted Label"), (F.col("user_id") % 3).alias("label"))
    role = C.detect_schema(x)
    if "open" in role or role["open_interest"] != "Open Interest":
        raise ValueError("open interest was taken for a price")
    return x.select("event_id", *(F.col(f"`{role[r]}`").alias(r) for r in ("timestamp", "close", "low", "predicted", "target")))


@query("p17_renamed", "SELECT r_regionkey AS b__key, r_name AS name FROM region")
def p17(spark, d):
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("a__key"), F.col("r_name").alias("name"))
    plan, _, _ = C.rename_plan(r.columns, ["b__key", "name"])
    return r.withColumnsRenamed(plan)


@query("p18_label_candidates", "SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1")
def p18(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    (label,) = C.label_candidates(o, [], 10)
    return o.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("p19_first_source", "WITH c AS (SELECT DISTINCT p_brand AS source, p_name AS \"column\" FROM part) SELECT \"column\", max(source) AS source FROM c GROUP BY 1")
def p19(spark, d):
    """Sources in falling order of their names, as a table."""
    c = table(spark, d, "part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("column")).distinct()
    order = R.row_ids(c.select("source").distinct(), ["source"], "n").select("source", (-F.col("n")).alias("place"))
    return C.first_by_source(c, order)


#: Quantities under 5 and one flag count as missing.
_GAPS = "SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 1) AS q, CASE WHEN l_discount > 0.02 THEN l_discount END AS disc, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag FROM lineitem"


def gaps(spark, d):
    i = table(spark, d, "lineitem")
    return i.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_quantity") != 1, F.col("l_quantity")).alias("q"), F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("disc"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"))


@query("m01_sentinels", f"SELECT round(min(q) - (max(q) - min(q)) - 1, 6) AS q, round(min(disc) - (max(disc) - min(disc)) - 1, 6) AS disc FROM ({_GAPS})")
def m01(spark, d):
    return M.sentinels(gaps(spark, d), ["q", "disc"]).select(F.round("q", 6).alias("q"), F.round("disc", 6).alias("disc"))


@query("m02_zero_fill", f"SELECT round(sum(coalesce(q, 0)), 2) AS q, count(*) FILTER (WHERE coalesce(flag, 'MISSING') = 'MISSING') AS n_missing FROM ({_GAPS})")
def m02(spark, d):
    return M.fill_zero(gaps(spark, d), ["q", "flag"]).agg(F.round(F.sum("q"), 2).alias("q"), F.count(F.when(F.col("flag") == "MISSING", 1)).alias("n_missing"))


@query("m03_forward_fill", "SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS v FROM (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v FROM events)")
def m03(spark, d):
    x = events(spark, d).withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    return M.fill_forward(x, ["v"], ["user_id"], ["ts", "event_id"], 5 * 3).select("event_id", "v")


@query("m04_marked_rows", f"SELECT q IS NULL OR disc IS NULL AS drop_row, count(*) AS n FROM ({_GAPS}) GROUP BY 1")
def m04(spark, d):
    return M.mark_dropped(gaps(spark, d), ["q", "disc"]).groupBy("drop_row").agg(F.count(F.lit(1)).alias("n"))


@query("m05_sentinel_fill", f"SELECT round(sum(coalesce(q, -999)), 2) AS q FROM ({_GAPS})")
def m05(spark, d):
    return M.fill_sentinel(gaps(spark, d), {"q": -999}).agg(F.round(F.sum("q"), 2).alias("q"))


@query("m06_fill_note", f"SELECT 'q' AS \"column\", count(*) FILTER (WHERE q IS NULL) AS nulls_before, CAST(0 AS BIGINT) AS nulls_after, count(*) FILTER (WHERE q IS NULL) AS filled FROM ({_GAPS}) UNION ALL SELECT 'disc', count(*) FILTER (WHERE disc IS NULL), count(*) FILTER (WHERE disc IS NULL), 0 FROM ({_GAPS})")
def m06(spark, d):
    g = gaps(spark, d)
    return M.fill_note(g, M.fill_zero(g, ["q"]), ["q", "disc"])


@query("m07_encoded", "WITH c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 25 AND p_type <> 'ECONOMY')) SELECT p_partkey, CAST(coalesce(code, -1) AS INTEGER) AS code FROM part LEFT JOIN c USING (p_type)")
def m07(spark, d):
    part = table(spark, d, "part")
    codes = M.category_codes(part.where("p_size <= 25 and p_type <> 'ECONOMY'"), "p_type")
    return M.encode(part, "p_type", codes).select("p_partkey", F.col("p_type_code").alias("code"))


@query("m08_fit_and_apply", f"WITH g AS ({_GAPS}), s AS (SELECT min(disc) - (max(disc) - min(disc)) - 1 AS v FROM g WHERE l_partkey % 5 < 4) SELECT l_orderkey, count(*) AS n, round(sum(coalesce(disc, v)), 4) AS x FROM g, s GROUP BY 1")
def m08(spark, d):
    g = gaps(spark, d)
    fitted = M.sentinels(g.where("l_partkey % 5 < 4"), ["disc"]).first().asDict()
    return M.fill_sentinel(g, fitted).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("disc"), 4).alias("x"))


@query("m09_flag_text", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'True' WHEN p_size <= 25 THEN 'False' END AS big FROM part")
def m09(spark, d):
    return table(spark, d, "part").select("p_partkey", M.flag_text(F.col("p_size") > 25).alias("big"))


@query("a15_null_profile", f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE q IS NULL) AS null_q, count(*) FILTER (WHERE disc IS NULL) AS null_disc, count(*) FILTER (WHERE flag IS NULL) AS null_flag, count(*) FILTER (WHERE q IS NOT NULL AND disc IS NOT NULL AND flag IS NOT NULL) AS n_full, count(*) FILTER (WHERE q IS NULL AND disc IS NULL AND flag IS NULL) AS n_empty FROM ({_GAPS})")
def a15(spark, d):
    return M.null_profile(gaps(spark, d), ["q", "disc", "flag"])


@query("a36_group_tally", "SELECT p_brand AS \"group\", count(*) AS n FROM part GROUP BY 1")
def a36(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("group")).agg(F.count(F.lit(1)).alias("n"))


_LEAK = """WITH x AS (SELECT user_id, ts, value + 1 AS price, row_number() OVER o AS rn, lead(value + 1, 1) OVER o / (value + 1) - 1 AS a1, lead(value + 1, 5) OVER o / (value + 1) - 1 AS a5, (value + 1) / lag(value + 1, 1) OVER o - 1 AS b1, (value + 1) / lag(value + 1, 5) OVER o - 1 AS b5, lead(value, 1) OVER o AS peek, avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean5, epoch_us(ts) / 1000000.0 AS clock FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
l AS (UNPIVOT (SELECT CAST(rn AS DOUBLE) AS rn, a1, a5, b1, b5, CAST(peek AS DOUBLE) AS peek, mean5, CAST(clock AS DOUBLE) AS clock FROM x) ON peek, mean5, clock INTO NAME "column" VALUE x)"""


def leaky(spark, d):
    o = W.partitionBy("user_id").orderBy("ts")
    from tidemark.functions.timebars import epoch_micros

    x = events(spark, d).withColumns({"price": F.col("value") + 1, "peek": F.lead("value").over(o), "mean5": F.avg("value").over(o.rowsBetween(-4, 0)), "clock": epoch_micros(F.col("ts")) / 1e6})
    return Q.leak_statistics(x, ["user_id"], "price", ["peek", "mean5", "clock"], ["ts"], (1, 5))


@query("a34_leak_statistics", _LEAK + " SELECT \"column\", count(x) AS n, count(DISTINCT x) AS n_distinct, round(corr(x, rn), 4) AS time_corr, round(corr(x, a1), 4) AS ahead_1, round(corr(x, a5), 4) AS ahead_5, round(corr(x, b1), 4) AS behind_1, round(corr(x, b5), 4) AS behind_5 FROM l GROUP BY 1")
def a34(spark, d):
    s = leaky(spark, d)
    return s.select("column", "n", F.col("n_distinct").alias("n_distinct"), *(F.round(c, 4).alias(c) for c in s.columns[3:]))


@query("q01_leak_verdicts", _LEAK + ", s AS (SELECT \"column\", count(x) AS n, corr(x, rn) AS t, greatest(abs(corr(x, a1)), abs(corr(x, a5))) AS a, greatest(abs(corr(x, b1)), abs(corr(x, b5))) AS b FROM l GROUP BY 1) SELECT \"column\", CASE WHEN n > 1000 AND abs(t) > 0.97 THEN 'banned' WHEN a > 0.3 OR (a > 0.1 AND a > 2 * b) THEN 'banned' WHEN a > 0.05 AND a > 2 * b THEN 'suspect' ELSE 'ok' END AS verdict FROM s")
def q01(spark, d):
    return Q.leak_verdict(leaky(spark, d), (1, 5)).select("column", "verdict")


_NAMED = {"label_int": "banned", "dir_at_label": "banned", "signed_ret_3": "banned", "is_label_3": "banned", "outcome": "banned", "weight_raw": "banned", "y": "banned", "fut_ret_5": "banned", "ret_ahead": "banned", "x_lead5": "banned", "src__fwd_ret_5": "banned", "src__session": "banned", "up_future": "banned", "Future_option_Diff": "ok", "fut_spot_spread": "ok", "leading": "ok", "weights": "ok", "label_combined": "suspect", "Flow_State_Label": "suspect", "up_class": "suspect"}
_SCREENED = """, s AS (SELECT "column", count(x) AS n, corr(x, rn) AS t, greatest(CASE WHEN regr_count(x, a1) > 1000 THEN abs(corr(x, a1)) END, CASE WHEN regr_count(x, a5) > 1000 THEN abs(corr(x, a5)) END, 0) AS a, greatest(CASE WHEN regr_count(x, b1) > 1000 THEN abs(corr(x, b1)) END, CASE WHEN regr_count(x, b5) > 1000 THEN abs(corr(x, b5)) END, 0) AS b FROM l GROUP BY 1)
SELECT "column", CASE WHEN n > 1000 AND abs(t) > 0.97 THEN 'banned' WHEN a > 0.3 OR (a > 0.1 AND a > 2 * b) THEN 'banned' WHEN a > 0.05 AND a > 2 * b THEN 'suspect' ELSE 'ok' END AS verdict FROM s WHERE "column" <> 'clock'
UNION ALL SELECT 'day_text', CASE WHEN avg(CASE WHEN regexp_matches(strftime(ts, '%Y-%m-%d'), '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 1 ELSE 0 END) > 0.9 THEN 'banned' ELSE 'ok' END FROM events
UNION ALL SELECT c, v FROM (VALUES ('ts', 'banned'), ('kind', 'ok'), ('clock', 'ok'), """ + ", ".join(f"('{c}', '{v}')" for c, v in _NAMED.items()) + """) AS x(c, v) WHERE (SELECT count(*) FROM events) > 0"""


@query("q01_leak_screen", _LEAK + _SCREENED)
def q01s(spark, d):
    """Names, types and measures together; clock is allowed by hand. Named columns hold the event type, which no measure bans."""
    o = W.partitionBy("user_id").orderBy("ts")
    from tidemark.functions.timebars import epoch_micros

    e = events(spark, d)
    made = {"price": F.col("value") + 1, "peek": F.lead("value").over(o), "mean5": F.avg("value").over(o.rowsBetween(-4, 0)), "clock": epoch_micros(F.col("ts")) / 1e6, "day_text": F.date_format("ts", "yyyy-MM-dd"), "kind": F.col("event_type")}
    x = e.withColumns(made | {n: F.col("event_type") for n in _NAMED})
    return Q.leak_screen(x, ["user_id"], "price", ["ts", "day_text", *_NAMED, "kind", "clock", "peek", "mean5"], ["ts"], ("clock",), (1, 5)).select("column", "verdict")


@query("q02_price_column", "SELECT count(*) AS n, max(p_retailprice) AS top FROM part")
def q02(spark, d):
    part = table(spark, d, "part")
    price = C.detect_roles(part.columns, {"price": ["close", "price"]})["price"]
    return part.agg(F.count(F.lit(1)).alias("n"), F.max(price).alias("top"))


@query("q04_source_row", "SELECT 'events' AS name, count(*) AS rows, min(ts) AS lo, max(ts) AS hi, CAST(4 AS INTEGER) AS n_columns FROM events")
def q04(spark, d):
    r = K.source_rows(events(spark, d), "events", ["user_id"])
    return r.select("name", "rows", F.col("span.min").alias("lo"), F.col("span.max").alias("hi"), F.size("columns").alias("n_columns"))


_INSPECTED = """WITH s AS (SELECT user_id, ts, CAST(value AS VARCHAR) AS v1, CAST(epoch(date_trunc('minute', ts) - to_minutes(CAST(((hour(ts) * 60 + minute(ts) - 555) % 60 + 60) % 60 AS BIGINT))) AS VARCHAR) AS v60, CASE WHEN event_id % 3 > 0 THEN event_type END AS kind FROM events),
l AS (SELECT user_id, ts, 'v1' AS "column", v1 AS x FROM s UNION ALL SELECT user_id, ts, 'v60', v60 FROM s UNION ALL SELECT user_id, ts, 'kind', kind FROM s), p(period) AS (VALUES (1), (3), (5), (15), (30), (60)),
b AS (SELECT user_id, "column", period, date_trunc('minute', ts) - to_minutes(CAST(((hour(ts) * 60 + minute(ts) - 555) % period + period) % period AS BIGINT)) AS bar, count(DISTINCT x) AS k FROM l, p GROUP BY 1, 2, 3, 4),
f AS (SELECT "column", period, count(*) FILTER (WHERE k > 0) AS n, bool_and(k <= 1) AS constant FROM b GROUP BY 1, 2), c AS (SELECT "column", coalesce(max(period) FILTER (WHERE constant AND n >= 2), 1) AS clock FROM f GROUP BY 1),
m AS (SELECT *, x <> lag(x) OVER (PARTITION BY user_id, "column" ORDER BY ts) AS moved FROM l),
r AS (SELECT "column", count(*) FILTER (WHERE moved) >= 20 AND count(DISTINCT CASE WHEN moved THEN ((hour(ts) * 60 + minute(ts) - 555) % 60 + 60) % 60 END) >= 2 AS sure, count(*) FILTER (WHERE x IS NULL) AS nulls FROM m GROUP BY 1)
SELECT "column", CAST(clock AS INTEGER) AS clock, NOT sure AS unsure, nulls, "column" = 'kind' AS categorical, 2 AS n_banned, 'state_label' AS suspected FROM c JOIN r USING ("column")
UNION ALL SELECT 'state_label', 60, TRUE, 0, TRUE, 2, 'state_label' FROM (SELECT 1 WHERE (SELECT count(*) FROM events) > 0)"""


@query("q04_inspected_source", _INSPECTED)
def q04b(spark, d):
    """A table with numbers on two clocks, a text with gaps, two columns that are banned and one that is suspect."""
    from tidemark.functions.timebars import bar_start

    e = events(spark, d)
    still = F.unix_seconds(bar_start(F.col("ts"), 60).cast("timestamp")).cast("double")
    x = e.select("user_id", "ts", F.col("value").alias("v1"), still.alias("v60"), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("kind"), F.lit("x").alias("state_label"), F.lit(1).alias("label_int"), F.lit(2.0).alias("src__fwd_ret_5"))
    r = K.inspected(x, "events", ["user_id"])
    each = r.select(F.explode("columns").alias("column"), "clocks", "unsure", "nulls", "categorical", F.size("banned").alias("n_banned"), F.array_join(F.map_keys("suspect"), ",").alias("suspected"))
    has = lambda c: F.array_contains(c, F.col("column"))
    return each.select("column", F.col("clocks")[F.col("column")].alias("clock"), has("unsure").alias("unsure"), F.col("nulls")[F.col("column")].alias("nulls"), has("categorical").alias("categorical"), "n_banned", "suspected")


@query("q07_label_change", "WITH o AS (SELECT event_type AS label, count(*) AS n_old FROM events WHERE user_id % 2 = 0 GROUP BY 1), w AS (SELECT event_type AS label, count(*) AS n_new FROM events WHERE user_id % 2 = 1 GROUP BY 1) SELECT label, n_old, n_new, round(n_old * 1.0 / sum(n_old) OVER (), 6) AS share_old, round(n_new * 1.0 / sum(n_new) OVER (), 6) AS share_new FROM o FULL JOIN w USING (label)")
def q07(spark, d):
    e = events(spark, d)
    return K.label_change(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1"), "event_type")


@query("q09_conflicting_labels", "WITH g AS (SELECT p_size, p_brand, count(*) AS n, count(DISTINCT p_type) AS k FROM part GROUP BY 1, 2) SELECT count(*) AS n_groups, count(*) FILTER (WHERE n > 1) AS n_repeated, count(*) FILTER (WHERE k > 1) AS n_conflicting FROM g")
def q09(spark, d):
    return Q.conflicting_labels(table(spark, d, "part"), ["p_size", "p_brand"], "p_type")


@query("q09_stability_index", "WITH b AS (SELECT (CASE WHEN value >= 5 THEN 1 ELSE 0 END) + (CASE WHEN value >= 15 THEN 1 ELSE 0 END) + (CASE WHEN value >= 40 THEN 1 ELSE 0 END) AS bin, count(*) FILTER (WHERE user_id % 3 = 0) AS b, count(*) FILTER (WHERE user_id % 3 <> 0) AS a FROM events GROUP BY 1), s AS (SELECT (a + 0.5) / (sum(a) OVER () + 0.5) AS p, (b + 0.5) / (sum(b) OVER () + 0.5) AS q FROM b) SELECT round(sum((q - p) * ln(q / p)), 6) AS psi FROM s")
def q09b(spark, d):
    return Q.stability_index(events(spark, d), "value", F.col("user_id") % 3 == 0, [5.0, 15.0, 40.0])


_PARTS = "l AS (UNPIVOT (SELECT l_orderkey % 4 = 0 AS test, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount, CASE WHEN l_linenumber > 2 THEN CAST(l_suppkey + CASE WHEN l_orderkey % 4 = 0 THEN 2 ELSE 0 END AS DOUBLE) END AS moved FROM lineitem) ON l_quantity, l_extendedprice, l_discount, moved INTO NAME \"column\" VALUE x)"


@query("q09_ks", f"WITH {_PARTS}" + """, c AS (SELECT "column", x, count(*) FILTER (WHERE NOT test) AS a, count(*) FILTER (WHERE test) AS b FROM l GROUP BY 1, 2),
u AS (SELECT *, sum(a) OVER w AS ua, sum(b) OVER w AS ub, sum(a) OVER (PARTITION BY "column") AS na, sum(b) OVER (PARTITION BY "column") AS nb FROM c WINDOW w AS (PARTITION BY "column" ORDER BY x)),
k AS (SELECT "column", na, nb, least(9, floor(10 * (ua - a) / na)) AS bin, max(abs(ua / na - ub / nb)) AS ks, (sum(a) + 0.5) / (na + 0.5) AS p, (sum(b) + 0.5) / (nb + 0.5) AS q FROM u GROUP BY 1, 2, 3, 4),
r AS (SELECT "column", CAST(na AS BIGINT) AS n_train, CAST(nb AS BIGINT) AS n_test, round(max(ks), 6) AS ks, round(sqrt(-ln(0.025) / 2) * sqrt((na + nb) / (na * nb)), 6) AS ks_limit, round(sum((q - p) * ln(q / p)), 6) AS psi FROM k GROUP BY 1, na, nb)
SELECT *, ks > ks_limit AS drifted FROM r""")
def q09d(spark, d):
    """Four columns of lines in one pass, the last of which moves between the parts."""
    lines = table(spark, d, "lineitem").withColumn("test", F.col("l_orderkey") % 4 == 0)
    moved = F.when(F.col("l_linenumber") > 2, F.col("l_suppkey") + F.when(F.col("test"), 2).otherwise(0))
    return Q.drift(lines.withColumn("moved", moved), ["l_quantity", "l_extendedprice", "l_discount", "moved"], F.col("test"))


@query("q09_row_overlap", "WITH k AS (SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 4 <> 0), t AS (SELECT l_suppkey, l_quantity, l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey % 4 = 0 GROUP BY ALL), j AS (SELECT t.n, k.l_suppkey IS NOT NULL AS seen FROM t LEFT JOIN k ON t.l_suppkey = k.l_suppkey AND t.l_quantity = k.l_quantity AND t.l_returnflag = k.l_returnflag) SELECT CAST(sum(n) AS BIGINT) AS n_test, CAST(sum(n) FILTER (WHERE seen) AS BIGINT) AS n_seen, count(*) FILTER (WHERE seen) AS n_seen_distinct, round(sum(n) FILTER (WHERE seen) / sum(n), 6) AS share FROM j")
def q09e(spark, d):
    lines = table(spark, d, "lineitem")
    return Q.row_overlap(lines.where("l_orderkey % 4 <> 0"), lines.where("l_orderkey % 4 = 0"), ["l_suppkey", "l_quantity", "l_returnflag"])


@query("q09_new_categories", "SELECT p_name, count(*) AS n FROM part WHERE p_partkey % 2 = 1 AND p_name NOT IN (SELECT p_name FROM part WHERE p_partkey % 2 = 0 AND p_size < 10) GROUP BY 1")
def q09c(spark, d):
    p = table(spark, d, "part")
    return Q.new_categories(p.where("p_partkey % 2 = 0 and p_size < 10"), p.where("p_partkey % 2 = 1"), "p_name")


_COLS = "SELECT 'v' || (p_size % 4) AS version, p_name AS \"column\" FROM part"


def columns(spark, d):
    return table(spark, d, "part").select(F.concat(F.lit("v"), F.col("p_size") % 4).alias("version"), F.col("p_name").alias("column"))


@query("u01_column_diff", f"WITH c AS ({_COLS}), a AS (SELECT DISTINCT \"column\" FROM c WHERE version = 'v0'), b AS (SELECT DISTINCT \"column\" FROM c WHERE version = 'v1') SELECT coalesce(a.\"column\", b.\"column\") AS \"column\", CASE WHEN a.\"column\" IS NULL THEN 'added' WHEN b.\"column\" IS NULL THEN 'removed' ELSE 'kept' END AS change FROM a FULL JOIN b ON a.\"column\" = b.\"column\"")
def u01(spark, d):
    return K.column_diff(columns(spark, d), "v0", "v1")


_HAS = ", ".join(f"count(DISTINCT version) FILTER (WHERE version = 'v{k}') AS v{k}" for k in range(4))


@query("u02_difference_matrix", f"WITH c AS ({_COLS}) SELECT \"column\", {_HAS} FROM c GROUP BY 1 HAVING count(DISTINCT version) < 4")
def u02(spark, d):
    return K.difference_matrix(columns(spark, d), ["v0", "v1", "v2", "v3"])


@query("u03_derived_selections", f"WITH c AS ({_COLS}) SELECT DISTINCT 'w1' AS version, \"column\" FROM c WHERE version = 'v1' AND \"column\" <> 'red widget' UNION SELECT 'w1', 'extra'")
def u03(spark, d):
    plan = spark.createDataFrame([("w1", "v1", ["red widget"], ["extra"])], "version string, parent string, drops array<string>, adds array<string>")
    return K.derive_selections(columns(spark, d), plan)


@query("u04_selection", "SELECT DISTINCT p_brand AS \"group\", p_name AS name FROM part WHERE p_brand = 'Brand#2' OR p_name = 'red widget'")
def u04(spark, d):
    c = table(spark, d, "part").select(F.col("p_brand").alias("group"), F.col("p_name").alias("name")).distinct()
    return K.selection(c, ["Brand#2"], ["red widget"])


@query("u05_identical_versions", "WITH c AS (SELECT 's' || s_suppkey AS version, s_nationkey % 3 AS k FROM supplier), h AS (SELECT k, list_sort(list(version)) AS versions FROM c GROUP BY 1) SELECT array_to_string(versions, ',') AS versions FROM h WHERE len(versions) > 1")
def u05(spark, d):
    c = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("version"), (F.col("s_nationkey") % 3).cast("string").alias("column"))
    return K.identical_versions(c).select(F.array_join("versions", ",").alias("versions"))


@query("u06_tagged_union", "SELECT 'c' AS version, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT 's', s_nationkey, NULL FROM supplier")
def u06(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return K.tagged_union({"c": c, "s": table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))})


@query("u07_glued", "SELECT p_partkey, p_name, p_size FROM part")
def u07(spark, d):
    p = table(spark, d, "part")
    return K.glue([p.select("p_partkey", "p_name"), p.select("p_partkey", "p_size")], "p_partkey")


@query("f10_math", "SELECT c_custkey, round(abs(c_acctbal), 4) AS a, round(least(greatest(c_acctbal, 0), 5000), 4) AS clipped, round(sqrt(abs(c_acctbal)), 4) AS root, round_even(c_acctbal, 1) AS half_even, CAST(sign(c_acctbal) AS DOUBLE) AS s FROM customer")
def f10(spark, d):
    b = F.col("c_acctbal")
    return table(spark, d, "customer").select("c_custkey", F.round(F.abs(b), 4).alias("a"), F.round(F.least(F.greatest(b, F.lit(0.0)), F.lit(5000.0)), 4).alias("clipped"), F.round(F.sqrt(F.abs(b)), 4).alias("root"), F.bround(b, 1).alias("half_even"), F.signum(b).alias("s"))


@query("f07_name_bans", "SELECT p_name, regexp_matches(lower(p_name), 'w.*t') AS banned FROM (SELECT DISTINCT p_name FROM part)")
def f07(spark, d):
    return table(spark, d, "part").select("p_name").distinct().withColumn("banned", F.lower("p_name").rlike("w.*t"))


@query("q06_manifest_check", "SELECT count(*) AS rows, CAST(3 AS INTEGER) AS n_features, 'certified' AS status, '' AS problems FROM orders")
def q06(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    m = K.manifest(o, "v1", ["o_orderkey", "o_totalprice", "o_custkey"], "o_orderstatus", "closed bars only")
    problems = ",".join(K.verify(o, m))
    return m.select("rows", "n_features", "status", F.lit(problems).alias("problems"))
