"""Queries: bars, scans by time, point-in-time joins (F, J, P11, Q08)."""

from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.functions import timebars as B
from tidemark.operators import asof as J
from tidemark.plans.registry import query, table

#: Minutes from the anchor into the bar, floored times and closes, in SQL.
_MIN = "date_trunc('minute', ts)"
_OFF = "(((hour(ts) * 60 + minute(ts) - {a}) % {n} + {n}) % {n})"


def _start(n, a=B.ANCHOR):
    return f"({_MIN} - to_minutes(CAST({_OFF.format(n=n, a=a)} AS BIGINT)))"


def _close(n):
    return f"({_start(n)} + to_minutes(CAST({n} AS BIGINT)))"


def events(spark, d, kind=None):
    e = table(spark, d, "events")
    return e.where(F.col("event_type") == kind) if kind else e


@query("f01_bar_close", f"SELECT event_id, {_start(5)} AS start5, {_close(5)} AS close5, {_start(60)} AS start60, {_close(60)} AS close60 FROM events")
def f01(spark, d):
    ts = F.col("ts")
    return events(spark, d).select("event_id", B.bar_start(ts, 5).alias("start5"), B.bar_close(ts, 5).alias("close5"), B.bar_start(ts, 60).alias("start60"), B.bar_close(ts, 60).alias("close60"))


@query("f02_candle", f"SELECT {_start(15, 0)} AS candle, count(*) AS n FROM events GROUP BY 1")
def f02(spark, d):
    return events(spark, d).groupBy(B.candle(F.col("ts"), 15).alias("candle")).agg(F.count(F.lit(1)).alias("n"))


@query("f03_calendar_parts", "SELECT event_id, CAST(ts AS DATE) AS day, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute_of_day FROM events")
def f03(spark, d):
    ts = F.col("ts")
    return events(spark, d).select("event_id", F.to_date(ts).alias("day"), F.year(ts).alias("y"), F.month(ts).alias("m"), F.weekday(ts).alias("weekday"), B.minute_of_day(ts).alias("minute_of_day"))


_TEXTS = "CASE event_id % 4 WHEN 0 THEN strftime(ts, '%d-%m-%Y %H:%M') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN 'n/a' ELSE NULL END"


@query("f04_parse_times", f"WITH x AS (SELECT event_id, {_TEXTS} AS t FROM events) SELECT event_id, coalesce(try_strptime(t, '%d-%m-%Y %H:%M'), try_strptime(t, '%Y-%m-%d %H:%M:%S')) AS parsed, t IS NOT NULL AND coalesce(try_strptime(t, '%d-%m-%Y %H:%M'), try_strptime(t, '%Y-%m-%d %H:%M:%S')) IS NULL AS bad FROM x")
def f04(spark, d):
    from tidemark.sources.readers import parse_time

    ts, k = F.col("ts"), F.col("event_id") % 4
    text = F.when(k == 0, F.date_format(ts, "dd-MM-yyyy HH:mm")).when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(k == 2, "n/a")
    x = events(spark, d).select("event_id", text.alias("t"))
    parsed = parse_time(F.col("t"))
    return x.select("event_id", parsed.alias("parsed"), (F.col("t").isNotNull() & parsed.isNull()).alias("bad"))


_RAW = "CASE event_id % 5 WHEN 0 THEN ' ' || event_type || ' ' WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN CAST(event_id % 7 AS VARCHAR) || '.0' ELSE upper(event_type) END"


@query("f05_clean_labels", f"WITH x AS (SELECT event_id, upper(trim({_RAW})) AS t FROM events) SELECT event_id, CASE WHEN t NOT IN ('', 'NAN', 'NONE', 'NULL') THEN regexp_replace(t, '^(-?[0-9]+)\\.0+$', '\\1') END AS label FROM x")
def f05(spark, d):
    k, kind = F.col("event_id") % 5, F.col("event_type")
    raw = F.when(k == 0, F.concat(F.lit(" "), kind, F.lit(" "))).when(k == 1, "nan").when(k == 2, "").when(k == 3, F.concat((F.col("event_id") % 7).cast("string"), F.lit(".0"))).otherwise(F.upper(kind))
    return events(spark, d).select("event_id", L.clean_label(raw).alias("label"))


@query("f06_clean_names", "SELECT p_partkey, trim(lower(regexp_replace(p_brand || '/' || p_name || '!', '[^0-9A-Za-z]+', '_', 'g')), '_') AS name FROM part")
def f06(spark, d):
    return table(spark, d, "part").select("p_partkey", L.clean_name(F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit("!"))).alias("name"))


@query("f08_durations", "SELECT p_partkey, CAST(p_size AS INTEGER) AS minutes FROM part")
def f08(spark, d):
    return table(spark, d, "part").select("p_partkey", L.duration_minutes(F.concat(F.col("p_size").cast("string"), F.lit("min"))).alias("minutes"))


@query("f09_pair_keys", "SELECT DISTINCT o_orderstatus || '->' || o_orderpriority AS pair, o_orderstatus AS t, o_orderpriority AS p FROM orders")
def f09(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct().select(F.concat_ws("->", "o_orderstatus", "o_orderpriority").alias("pair"))
    parts = F.split("pair", "->")
    return o.select("pair", parts[0].alias("t"), parts[1].alias("p"))


@query("f11_version_order", "WITH v AS (SELECT DISTINCT 'v' || (p_size % 5) || '.' || p_size AS version, p_size % 5 AS a, p_size AS b FROM part) SELECT version, CAST(row_number() OVER (ORDER BY a, b) AS INTEGER) AS place FROM v")
def f11(spark, d):
    from pyspark.sql import Window as W

    v = table(spark, d, "part").select(F.format_string("v%d.%d", F.col("p_size") % 5, F.col("p_size")).alias("version")).distinct()
    return v.select("version", F.row_number().over(W.orderBy(L.version_key(F.col("version")))).alias("place"))


@query("f12_category_codes", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code FROM part")
def f12(spark, d):
    from tidemark.operators.missing import category_codes, encode

    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return encode(part, "p_brand", category_codes(part, "p_brand")).select("p_partkey", F.col("p_brand_code").alias("code"))


_ASOF = """
WITH f AS (
  SELECT user_id, {close} AS close_ts, arg_max(value, ts) AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2),
s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
j AS (SELECT s.*, f.value, f.close_ts FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.close_ts)
"""


def _aligned(spark, d, bar=5, tolerance=288):
    spine = events(spark, d, "view").select("event_id", "user_id", "ts")
    return J.align_to_bars(spine, events(spark, d, "click").select("user_id", "ts", "value"), ["user_id"], ["value"], bar, tolerance)


@query("j01_bar_close_asof", _ASOF.format(close=_close(5)) + "SELECT event_id, user_id, ts, CASE WHEN close_ts + INTERVAL 1440 MINUTE >= ts THEN value END AS value, CASE WHEN close_ts + INTERVAL 1440 MINUTE >= ts THEN close_ts END AS close_ts FROM j")
def j01(spark, d):
    return _aligned(spark, d).select("event_id", "user_id", "ts", "value", "close_ts")


@query("j02_per_column_clocks", f"""
WITH a AS (SELECT user_id, {_close(5)} AS c, arg_max(value, ts) AS v5 FROM events WHERE event_type = 'click' GROUP BY 1, 2),
b AS (SELECT user_id, {_close(60)} AS c, arg_max(value * 2, ts) AS v60 FROM events WHERE event_type = 'click' GROUP BY 1, 2),
s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
x AS (SELECT s.*, a.v5, a.c AS c5 FROM s ASOF LEFT JOIN a ON s.user_id = a.user_id AND s.ts >= a.c),
y AS (SELECT x.*, b.v60, b.c AS c60 FROM x ASOF LEFT JOIN b ON x.user_id = b.user_id AND x.ts >= b.c)
SELECT event_id, CASE WHEN c5 + INTERVAL 500 MINUTE >= ts THEN v5 END AS v5, CASE WHEN c60 + INTERVAL 6000 MINUTE >= ts THEN v60 END AS v60 FROM y""")
def j02(spark, d):
    spine = events(spark, d, "view").select(F.col("event_id").alias("row_id"), "user_id", "ts")
    feature = events(spark, d, "click").select("user_id", "ts", F.col("value").alias("v5"), (F.col("value") * 2).alias("v60"))
    return J.align_by_clock(spine, feature, ["user_id"], {"v5": 5, "v60": 60}, 100).select(F.col("row_id").alias("event_id"), "v5", "v60")


@query("j03_prealigned_join", "SELECT o.o_orderkey, count(l.l_orderkey) AS n_lines, CAST(round(sum(l.l_quantity), 2) AS DOUBLE) AS qty FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1")
def j03(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))
    return table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"), "qty")


@query("j04_attach_label_sets", "SELECT d.doc_id, l.quality AS label_quality, l.toxic AS label_toxic FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN labels l USING (doc_id)")
def j04(spark, d):
    out = table(spark, d, "documents").select("doc_id").distinct()
    labels = table(spark, d, "labels")
    for name in ("quality", "toxic"):
        out = out.join(labels.select("doc_id", F.col(name).alias(f"label_{name}")), "doc_id", "left")
    return out


def _nearest_sql(direction):
    pick = {"backward": "CASE WHEN bd <= 14400000000 THEN bv END", "forward": "CASE WHEN fd <= 14400000000 THEN fv END", "nearest": "CASE WHEN bd <= 14400000000 AND (fd IS NULL OR bd <= fd) THEN bv WHEN fd <= 14400000000 THEN fv WHEN bd <= 14400000000 THEN bv END"}[direction]
    return f"""
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT user_id, ts AS fts, value FROM events WHERE event_type = 'click'),
b AS (SELECT s.*, f.value AS bv, epoch_us(s.ts) - epoch_us(f.fts) AS bd FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.fts),
a AS (SELECT b.*, f.value AS fv, epoch_us(f.fts) - epoch_us(b.ts) AS fd FROM b ASOF LEFT JOIN f ON b.user_id = f.user_id AND b.ts <= f.fts)
SELECT event_id, {pick} AS value FROM a"""


def _priced(direction):
    def run(spark, d):
        price = events(spark, d, "purchase").select("event_id", "user_id", "ts")
        return J.align_to_price(price, events(spark, d, "click").select("user_id", "ts", "value"), ["user_id"], "value", direction, 240).select("event_id", "value")

    return run


for _direction in ("backward", "forward", "nearest"):
    query(f"j05_align_{_direction}", _nearest_sql(_direction))(_priced(_direction))


@query("j06_labels_on_bars", "SELECT event_id, CASE WHEN value > 5 THEN event_type END AS label, CASE WHEN user_id % 2 = 0 THEN lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) END AS predicted FROM events")
def j06(spark, d):
    from tidemark.plans.evaluation import predictions

    e = events(spark, d)
    labels = e.where("value > 5").select("event_id", F.col("event_type").alias("label"))
    return J.attach_labels(e.select("event_id"), ["event_id"], labels, predictions(spark, d).where("user_id % 2 = 0").select("event_id", F.col("pred_label").alias("predicted")))


@query("j06_bars_without_predictions", "SELECT event_id, event_type AS label, CAST(NULL AS VARCHAR) AS predicted FROM events")
def j06b(spark, d):
    e = events(spark, d)
    return J.attach_labels(e.select("event_id"), ["event_id"], e.select("event_id", F.col("event_type").alias("label")))


@query("j08_membership", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j08(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("j12_temporal_coverage", """
WITH a AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type = 'view'),
b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) < DATE '2024-01-21')
SELECT count(*) AS n_rows, count(*) FILTER (WHERE ts BETWEEN b.lo AND b.hi) AS n_covered, round(count(*) FILTER (WHERE ts BETWEEN b.lo AND b.hi) * 1.0 / count(*), 6) AS share FROM events, b WHERE event_type = 'view'""")
def j12(spark, d):
    from tidemark.operators.quality import coverage

    other = events(spark, d, "click").where("cast(ts as date) < date'2024-01-21'")
    return coverage(events(spark, d, "view"), other)


@query("j13_all_pairs", """
WITH c AS (SELECT DISTINCT event_type AS c FROM events),
p AS (SELECT event_type AS t, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT a.c AS true_label, b.c AS pred_label, count(p.t) AS n FROM c a CROSS JOIN c b LEFT JOIN p ON p.t = a.c AND p.p = b.c GROUP BY 1, 2""")
def j13(spark, d):
    from tidemark.operators.evaluate import pair_counts
    from tidemark.plans.evaluation import predictions

    return pair_counts(predictions(spark, d), "true_label", "pred_label").select("true_label", "pred_label", "n")


@query("j14_merged_export", "SELECT o.o_orderkey, o.o_totalprice, c.c_acctbal, n.n_name AS n_name_feat FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_totalprice IS NOT NULL AND c.c_acctbal IS NOT NULL AND o.o_totalprice <> c.c_acctbal")
def j14(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    o = o.join(table(spark, d, "nation").withColumnRenamed("n_name", "n_name_feat"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return o.where("o_totalprice is not null and c_acctbal is not null and o_totalprice <> c_acctbal").select("o_orderkey", "o_totalprice", "c_acctbal", "n_name_feat")


_BAD = f"SELECT DISTINCT user_id, {_close(5)} AS c FROM events WHERE event_type = 'error'"


@query("p11_drop_served_windows", f"SELECT s.event_id FROM events s WHERE event_type = 'view' AND NOT EXISTS (SELECT 1 FROM ({_BAD}) b WHERE b.user_id = s.user_id AND s.ts >= b.c AND s.ts < b.c + INTERVAL 1440 MINUTE)")
def p11(spark, d):
    return J.drop_served_windows(events(spark, d, "view"), events(spark, d, "error"), ["user_id"], 5, 288).select("event_id")


@query("q08_no_peek", _ASOF.format(close=_close(5)) + "SELECT count(*) AS n_rows, count(CASE WHEN close_ts + INTERVAL 1440 MINUTE >= ts THEN 1 END) AS n_served, CAST(0 AS BIGINT) AS n_violations FROM j")
def q08(spark, d):
    return J.no_peek(_aligned(spark, d))


@query("entry_hourly_coverage", _ASOF.format(close=_close(5)) + "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_rows, count(CASE WHEN close_ts + INTERVAL 1440 MINUTE >= ts THEN 1 END) AS n_served FROM j GROUP BY 1")
def hourly_coverage(spark, d):
    return _aligned(spark, d).groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n_rows"), F.count("close_ts").alias("n_served"))
