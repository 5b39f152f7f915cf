"""Queries: clocks, splits, folds, attributions (A01-A04, A29, A16-A20, A38, V, ML4, W17)."""

from pyspark.sql import functions as F

from tidemark.operators import attribution as A
from tidemark.operators import clocks as C
from tidemark.operators import splits as S
from tidemark.plans.alignment import _start
from tidemark.plans.registry import SQL, query, table


def events(spark, d):
    return table(spark, d, "events")




def smeared(spark, d):
    from tidemark.functions.timebars import bar_start

    def still(n):
        return F.unix_seconds(bar_start(F.col("ts"), n).cast("timestamp")).cast("double")

    return events(spark, d).select("user_id", "ts", F.col("value").alias("v1"), still(5).alias("v5"), still(15).alias("v15"), still(60).alias("v60"))


_V = "SELECT user_id, ts, value AS v1, " + ", ".join(f"CAST(epoch({_start(n)}) AS DOUBLE) AS v{n}" for n in (5, 15, 60)) + " FROM events"
_LONG = f"WITH s AS ({_V}), l AS (UNPIVOT s ON v1, v5, v15, v60 INTO NAME \"column\" VALUE x), p(period) AS (VALUES (1), (3), (5), (15), (30), (60)), b AS (SELECT user_id, \"column\", period, date_trunc('minute', ts) - to_minutes(CAST(((hour(ts) * 60 + minute(ts) - 555) % period + period) % period AS BIGINT)) AS bar, max(x) - min(x) AS spread, abs(avg(x)) AS level FROM l, p GROUP BY 1, 2, 3, 4), f AS (SELECT \"column\", period, count(*) AS n_bars, bool_and(spread <= greatest(level, 1e-9) * 1e-6) AS constant FROM b GROUP BY 1, 2)"


@query("a01_bar_constancy", _LONG + """, t AS (SELECT "column", median(abs(x)) AS typical FROM l GROUP BY 1)
SELECT "column", CAST(period AS INTEGER) AS period, count(*) AS n_bars, bool_and(spread <= greatest(level, typical, 1e-9) * 1e-6) AS constant FROM b JOIN t USING ("column") GROUP BY 1, 2""")
def a01(spark, d):
    return C.bar_constancy(smeared(spark, d), ["user_id"], ["v1", "v5", "v15", "v60"])


@query("a02_column_clocks", _LONG + " SELECT \"column\", CAST(coalesce(max(period) FILTER (WHERE constant AND n_bars >= 2), 1) AS INTEGER) AS clock FROM f GROUP BY 1")
def a02(spark, d):
    return C.column_clocks(smeared(spark, d), ["user_id"], ["v1", "v5", "v15", "v60"])


@query("a03_clock_report", f"WITH s AS ({_V}), l AS (UNPIVOT s ON v1, v60 INTO NAME \"column\" VALUE x), m AS (SELECT *, x <> lag(x) OVER (PARTITION BY user_id, \"column\" ORDER BY ts) AS moved FROM l), c AS (SELECT \"column\", count(*) FILTER (WHERE moved) AS n_changes, count(DISTINCT CASE WHEN moved THEN ((hour(ts) * 60 + minute(ts) - 555) % 60 + 60) % 60 END) AS n_offsets FROM m GROUP BY 1) SELECT *, n_changes >= 20 AND n_offsets >= 2 AS confident FROM c")
def a03(spark, d):
    return C.clock_report(smeared(spark, d), ["user_id"], ["v1", "v60"])


@query("a04_row_spacing", "WITH g AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 60000000.0 AS gap, CAST(ts AS DATE) = CAST(lag(ts) OVER o AS DATE) AS same FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, round(coalesce(quantile_cont(gap, 0.5) FILTER (WHERE same), quantile_cont(gap, 0.5)), 4) AS minutes FROM g GROUP BY 1")
def a04(spark, d):
    return C.row_spacing(events(spark, d), ["user_id"]).select("user_id", F.round("minutes", 4).alias("minutes"))


_TEXTS = f"""WITH s AS (SELECT user_id, ts, event_type AS kind, CASE WHEN event_id % 7 <> 0 THEN strftime({_start(15)}, '%H:%M') END AS quarter, day({_start(60)}) % 2 = 0 AS even FROM events),
l AS (SELECT user_id, ts, 'kind' AS "column", kind AS x FROM s UNION ALL SELECT user_id, ts, 'quarter', quarter FROM s UNION ALL SELECT user_id, ts, 'even', CAST(even AS VARCHAR) FROM s), p(period) AS (VALUES (1), (3), (5), (15), (30), (60)),
b AS (SELECT user_id, "column", period, date_trunc('minute', ts) - to_minutes(CAST(((hour(ts) * 60 + minute(ts) - 555) % period + period) % period AS BIGINT)) AS bar, count(DISTINCT x) AS k FROM l, p GROUP BY 1, 2, 3, 4),
f AS (SELECT "column", period, count(*) FILTER (WHERE k > 0) AS n_bars, bool_and(k <= 1) AS constant FROM b GROUP BY 1, 2) SELECT "column", CAST(coalesce(max(period) FILTER (WHERE constant AND n_bars >= 2), 1) AS INTEGER) AS clock FROM f GROUP BY 1"""


@query("a02_text_clocks", _TEXTS)
def a02t(spark, d):
    """Clocks of texts with gaps and of a boolean."""
    from tidemark.functions.timebars import bar_start

    quarter = F.when(F.col("event_id") % 7 != 0, F.date_format(bar_start(F.col("ts"), 15), "HH:mm"))
    x = events(spark, d).select("user_id", "ts", F.col("event_type").alias("kind"), quarter.alias("quarter"), (F.dayofmonth(bar_start(F.col("ts"), 60)) % 2 == 0).alias("even"))
    return C.column_clocks(x, ["user_id"], ["kind", "quarter", "even"])


@query("w13_value_changes", "WITH s AS (SELECT user_id, ts, value AS v, CASE WHEN event_type = 'view' THEN value END AS seen FROM events), l AS (SELECT user_id, ts, 'v' AS \"column\", v AS x FROM s UNION ALL SELECT user_id, ts, 'seen', seen FROM s), m AS (SELECT *, x <> lag(x) OVER (PARTITION BY user_id, \"column\" ORDER BY ts) AS moved FROM l) SELECT \"column\", count(*) FILTER (WHERE moved) AS n_changes, count(*) AS n_rows FROM m GROUP BY 1")
def w13(spark, d):
    x = events(spark, d).select("user_id", "ts", F.col("value").alias("v"), F.when(F.col("event_type") == "view", F.col("value")).alias("seen"))
    return C.value_changes(x, ["user_id"], ["v", "seen"])


@query("a29_label_block_purity", f"WITH b AS (SELECT user_id, {_start(240, 0)} AS c, count(DISTINCT event_type) AS k FROM events GROUP BY 1, 2) SELECT count(*) AS n_blocks, round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0.0 END), 6) AS purity FROM b")
def a29(spark, d):
    return C.label_block_purity(events(spark, d), ["user_id"], "event_type", 240)


_SESSION = "s AS (SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS session FROM events)"
_THREE = f"""WITH {_SESSION}, q AS (SELECT quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.6) AS a, quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.8) AS b FROM s),
e AS (SELECT a, b, max(CASE WHEN epoch_us(ts) <= a THEN session END) AS sa, max(CASE WHEN epoch_us(ts) <= b THEN session END) AS sb FROM s, q GROUP BY 1, 2)
SELECT event_id, CASE WHEN epoch_us(ts) <= a THEN 'train' WHEN epoch_us(ts) <= b AND session > sa + 2 THEN 'val' WHEN epoch_us(ts) > b AND session > sb + 2 THEN 'test' ELSE 'embargo' END AS split FROM s, e"""


@query("v01_three_way_split", _THREE)
def v01(spark, d):
    return S.three_way(events(spark, d), 0.2, 0.2, 2).select("event_id", "split")


_C15 = _start(15, 0)


@query("v02_bundle_time_split", f"""WITH {_SESSION}, x AS (SELECT *, {_C15} AS c FROM s), k AS (SELECT c, max(session) AS s FROM x GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY c) AS r, count(*) OVER () AS n FROM k), p AS (SELECT *, CASE WHEN r <= round_even(n * 0.6, 0) THEN 0 WHEN r <= round_even(n * 0.8, 0) THEN 1 ELSE 2 END AS p FROM r),
w AS (SELECT p, max(s) AS last, count(DISTINCT s) AS k FROM p GROUP BY 1),
z AS (SELECT c, CASE WHEN p.p < 2 AND k > 2 AND s > last - 2 THEN 'embargo' WHEN p.p = 0 THEN 'train' WHEN p.p = 1 THEN 'val' ELSE 'test' END AS split FROM p JOIN w ON p.p = w.p)
SELECT event_id, split FROM x JOIN z USING (c)""")
def v02(spark, d):
    return S.bundle_time(events(spark, d), 0.2, 0.2, 2).select("event_id", "split")


_HASH = "((({x}) * 2654435761 + {s} * 40503) % 4294967296 + 4294967296) % 4294967296"


@query("v03_bundle_random_split", f"""WITH x AS (SELECT *, {_C15} AS c FROM events), k AS (SELECT DISTINCT c FROM x),
r AS (SELECT c, row_number() OVER (ORDER BY {_HASH.format(x="CAST(epoch(c) AS BIGINT)", s=7)}, c) AS r, count(*) OVER () AS n FROM k)
SELECT event_id, CASE WHEN r <= round_even(n * 0.2, 0) THEN 'test' WHEN r <= round_even(n * 0.2, 0) + round_even(n * 0.2, 0) THEN 'val' ELSE 'train' END AS split FROM x JOIN r USING (c)""")
def v03(spark, d):
    return S.bundle_random(events(spark, d), 0.2, 0.2, 7).select("event_id", "split")


@query("v04_embargo_end", "SELECT max(day) AS day FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-10' ORDER BY 1 LIMIT 5)")
def v04(spark, d):
    return S.embargo_end(events(spark, d), F.lit("2024-01-10"), 5)


_FOLDS = f"""WITH {_SESSION}, k AS (SELECT max(session) + 1 AS k FROM s), f AS (SELECT unnest(range(5)) AS fold), b AS (SELECT fold, fold * (k // 5) + least(fold, k % 5) AS lo, fold * (k // 5) + least(fold, k % 5) + k // 5 + CASE WHEN fold < k % 5 THEN 1 ELSE 0 END AS hi FROM f, k),
a AS (SELECT s.*, fold, CASE WHEN session >= lo AND session < hi THEN 'test' WHEN session >= lo - 1 AND session < hi + 3 THEN 'dropped' ELSE 'train' END AS role FROM s, b)"""


def folds(spark, d):
    return S.purged_folds(events(spark, d), 5, 1, 2)


@query("v05_purged_folds", _FOLDS + " SELECT event_id, CAST(fold AS INTEGER) AS fold, role FROM a")
def v05(spark, d):
    return folds(spark, d).select("event_id", "fold", "role")


@query("v06_leaks", _FOLDS + ", w AS (SELECT DISTINCT fold, CASE WHEN session >= lo - 1 AND session < lo THEN 'purge' WHEN session >= hi AND session < hi + 3 THEN 'embargo' END AS problem FROM s, b) SELECT CAST(fold AS INTEGER) AS fold, problem FROM w WHERE problem IS NOT NULL")
def v06(spark, d):
    """Folds cut without the gaps that are promised: every block's neighbours are named."""
    return S.leaks(S.purged_folds(events(spark, d), 5, 0, 0), 1, 2)


@query("v06_no_leaks", _FOLDS + " SELECT CAST(fold AS INTEGER) AS fold, 'near' AS problem FROM a JOIN b USING (fold) WHERE role = 'train' AND session >= lo - 1 AND session < hi + 3")
def v06b(spark, d):
    """Folds cut as promised have none."""
    return S.leaks(folds(spark, d), 1, 2)


@query("a38_fold_report", _FOLDS + " SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (WHERE role = 'train') AS n_train, count(*) FILTER (WHERE role = 'test') AS n_test, count(*) FILTER (WHERE role = 'dropped') AS n_dropped, min(ts) FILTER (WHERE role = 'test') AS test_from, max(ts) FILTER (WHERE role = 'test') AS test_to FROM a GROUP BY 1")
def a38(spark, d):
    return S.fold_report(folds(spark, d))


@query("v07_random_rows", f"SELECT event_id, CASE WHEN {_HASH.format(x='event_id', s=3)} < 1288490188 THEN 'test' ELSE 'train' END AS split FROM events")
def v07(spark, d):
    return S.random_rows(events(spark, d), "event_id", 0.3, 3).select("event_id", "split")


@query("v09_split_from_recipe", _THREE)
def v09(spark, d):
    import json

    recipe = json.loads('{"kind": "three_way", "val": 0.2, "test": 0.2, "embargo": 2}')
    return S.from_recipe(events(spark, d), recipe).select("event_id", "split")


@query("v09_candles_from_recipe", SQL["v03_bundle_random_split"])
def v09b(spark, d):
    return S.from_recipe(events(spark, d), {"kind": "candles", "val": 0.2, "test": 0.2, "seed": 7}).select("event_id", "split")


@query("v10_groups_sample", f"""WITH p AS (SELECT event_id, event_type AS t, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT event_id, CASE WHEN t = 'click' AND p = 'view' THEN 'mistake' WHEN t = 'click' AND p = 'click' THEN 'a_right' WHEN t = 'view' AND p = 'view' THEN 'b_right' END AS "group" FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY {_HASH.format(x='event_id', s=5)}, event_id) AS n FROM g WHERE "group" IS NOT NULL) SELECT event_id, "group" FROM r WHERE n <= 40""")
def v10(spark, d):
    from tidemark.plans.evaluation import predictions

    return S.groups_sample(predictions(spark, d), "event_id", "true_label", "pred_label", "click", "view", 40, 5).select("event_id", "group")


#: Vector components are contributions; the label is the class.
_ATTR = "SELECT vec_id AS row_id, 'f' || (i - 1) AS feature, 'c' || label AS class, CAST(embedding[i] AS DOUBLE) * (1 + i % 3) AS value FROM embeddings, (SELECT unnest(range(1, (SELECT max(len(embedding)) + 1 FROM embeddings))) AS i) WHERE i <= len(embedding)"


def contributions(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), F.concat(F.lit("c"), F.col("label")).alias("class"), F.posexplode("embedding").alias("i", "x"))
    return e.select("row_id", F.concat(F.lit("f"), F.col("i")).alias("feature"), "class", (F.col("x").cast("double") * (1 + (F.col("i") + 1) % 3)).alias("value"))


@query("a16_attribution_shares", f"WITH a AS ({_ATTR}), m AS (SELECT feature, avg(abs(value)) AS m FROM a GROUP BY 1) SELECT feature, round(100 * m / sum(m) OVER (), 4) AS share FROM m")
def a16(spark, d):
    return A.shares(contributions(spark, d)).select("feature", F.round("share", 4).alias("share"))


@query("a16_attribution_shares_by_class", f"WITH a AS ({_ATTR}), m AS (SELECT class, feature, avg(abs(value)) AS m FROM a GROUP BY 1, 2) SELECT class, feature, round(100 * m / sum(m) OVER (PARTITION BY class), 4) AS share FROM m")
def a16c(spark, d):
    return A.shares(contributions(spark, d), ["class"]).select("class", "feature", F.round("share", 4).alias("share"))


_FACTORS = ", ".join(f"({b}, {A.sample_factor(b + 11)})" for b in range(6))
_DRAWN = f"""x AS (SELECT DISTINCT row_id FROM a), o AS (SELECT row_id, boot, row_number() OVER (PARTITION BY boot ORDER BY row_id * f % 4294967296, row_id) AS k, count(*) OVER (PARTITION BY boot) AS n FROM x, (VALUES {_FACTORS}) AS f(boot, f)),
e AS (SELECT a.*, boot FROM a JOIN o USING (row_id) WHERE k <= round_even(0.7 * n, 0))"""
_BOOT = f"""WITH a AS ({_ATTR}), {_DRAWN},
m AS (SELECT boot, feature, avg(abs(value)) AS m FROM e GROUP BY 1, 2), s AS (SELECT boot, feature, 100 * m / sum(m) OVER (PARTITION BY boot) AS share FROM m), r AS (SELECT *, rank() OVER (PARTITION BY boot ORDER BY share DESC) AS r FROM s),
o2 AS (SELECT feature, round(avg(share), 4) AS mean, round(stddev_samp(share), 4) AS std, count(*) FILTER (WHERE r <= 5) AS top_hits FROM r GROUP BY 1)
SELECT *, CASE WHEN top_hits = 6 THEN 'solid' WHEN top_hits * 2 >= 6 THEN 'probable' ELSE 'noise' END AS verdict FROM o2"""


@query("a17_stable_shares", _BOOT)
def a17(spark, d):
    return A.stable_shares(contributions(spark, d), 6, 0.7, 11).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("a18_model_agreement", f"WITH a AS ({_ATTR}), b AS (SELECT 'm' || (row_id % 2) AS model, * FROM a), m AS (SELECT model, feature, avg(abs(value)) AS m FROM b GROUP BY 1, 2), s AS (SELECT model, feature, 100 * m / sum(m) OVER (PARTITION BY model) AS share FROM m), r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY share DESC) AS r FROM s) SELECT feature, round(max(share) FILTER (WHERE model = 'm0'), 4) AS m0, round(max(share) FILTER (WHERE model = 'm1'), 4) AS m1, round(avg(share), 4) AS mean, count(*) FILTER (WHERE r <= 5) AS n_models FROM r GROUP BY 1")
def a18(spark, d):
    by_model = A.shares(contributions(spark, d).withColumn("model", F.concat(F.lit("m"), F.col("row_id") % 2)), ["model"])
    return A.agreement(by_model, ["m0", "m1"]).withColumns({c: F.round(c, 4) for c in ("m0", "m1", "mean")})


_ROWS = "SELECT vec_id AS row_id, 'c' || (vec_id % 3) AS true_label, 'c' || label AS pred_label FROM embeddings"


def rows(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), F.concat(F.lit("c"), F.col("vec_id") % 3).alias("true_label"), F.concat(F.lit("c"), F.col("label")).alias("pred_label"))


@query("a19_cell_table", f"WITH a AS ({_ATTR}), r AS ({_ROWS}) SELECT true_label, pred_label, feature, round(avg(value), 4) AS value FROM a JOIN r ON a.row_id = r.row_id AND a.class = r.pred_label GROUP BY 1, 2, 3")
def a19(spark, d):
    return A.cell_table(contributions(spark, d), rows(spark, d)).withColumn("value", F.round("value", 4))


@query("a20_margin", f"WITH a AS ({_ATTR}), r AS ({_ROWS} WHERE 'c' || (vec_id % 3) = 'c1' AND label = 2), x AS (SELECT a.row_id, feature, sum(CASE WHEN class = 'c2' THEN value WHEN class = 'c1' THEN -value END) AS d FROM a JOIN r ON a.row_id = r.row_id GROUP BY 1, 2) SELECT feature, round(avg(d), 4) AS margin FROM x GROUP BY 1")
def a20(spark, d):
    return A.margin(contributions(spark, d), rows(spark, d), "c1", "c2").withColumn("margin", F.round("margin", 4))


@query("w17_row_texts", f"WITH a AS ({_ATTR}), r AS (SELECT *, row_number() OVER (PARTITION BY row_id, class ORDER BY abs(value) DESC, feature) AS n FROM a) SELECT row_id, class, string_agg(feature || '=' || printf('%.3f', value), ', ' ORDER BY n) AS text FROM r WHERE n <= 3 GROUP BY 1, 2")
def w17(spark, d):
    return A.row_texts(contributions(spark, d))


@query("ml4_linear_contributions", f"WITH a AS ({_ATTR}), m AS (SELECT feature, avg(value) AS mean FROM a GROUP BY 1) SELECT a.row_id, feature, 'up' AS class, round(2 * (value - mean), 4) AS value FROM a JOIN m USING (feature)")
def ml4(spark, d):
    long = contributions(spark, d).select("row_id", "feature", F.col("value").alias("x"))
    coefficients = long.select("feature").distinct().select("feature", F.lit("up").alias("class"), F.lit(2.0).alias("coefficient"))
    return A.linear_contributions(long, coefficients).withColumn("value", F.round("value", 4))
