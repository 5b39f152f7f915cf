"""Queries: price bars of users' values, signals from event types, trades and what comes of them (T, A21-A28, A35, A37, J07, J11, W10)."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.timebars import candle
from tidemark.operators import ledger as L
from tidemark.operators import quality as Q
from tidemark.operators import trades as T
from tidemark.plans.registry import query, table

#: Six-hour candles of each user's values; the signal of a candle is its last event's type, errors are gaps; truth is its first.
_N = 360
_BASE = f"""
WITH e AS (SELECT *, date_trunc('minute', ts) - to_minutes(CAST((hour(ts) * 60 + minute(ts)) % {_N} AS BIGINT)) AS c FROM events),
g AS (SELECT user_id, c AS ts, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
             arg_max(event_type, ts) AS last_type, arg_min(event_type, ts) AS first_type FROM e GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN last_type <> 'error' THEN last_type END AS sig, CASE WHEN first_type <> 'error' THEN first_type END AS truth FROM g)"""


def _book(column):
    return f""", f AS (SELECT *, {column} IS NOT NULL AND {column} IS DISTINCT FROM last_value({column} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fire,
  row_number() OVER o AS bar, lead(ts) OVER o AS fill_ts, lead(open) OVER o AS fill_price,
  last_value(close) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_close, max(ts) OVER (PARTITION BY user_id) AS last_ts FROM b WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
v(version, entry, x1, x2) AS (VALUES ('V1', 'click', 'view', 'view'), ('V2', 'click', 'view', 'purchase')),
h AS (SELECT f.*, version, fire AND fill_ts IS NOT NULL AND {column} = entry AS is_entry, fire AND fill_ts IS NOT NULL AND {column} IN (x1, x2) AS is_exit FROM f, v),
k AS (SELECT *, first_value(CASE WHEN is_exit THEN bar END IGNORE NULLS) OVER w AS xb, first_value(CASE WHEN is_exit THEN fill_ts END IGNORE NULLS) OVER w AS xt, first_value(CASE WHEN is_exit THEN fill_price END IGNORE NULLS) OVER w AS xp
      FROM h WINDOW w AS (PARTITION BY user_id, version ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
t AS (SELECT user_id, version, bar + 1 AS entry_bar, fill_ts AS entry_ts, fill_price AS entry_price, coalesce(xt, last_ts) AS exit_ts, coalesce(xp, last_close) AS exit_price,
             CASE WHEN xb IS NOT NULL THEN 'exit' ELSE 'end_of_data' END AS reason, coalesce(xp, last_close) - fill_price AS points, coalesce(xp, last_close) - fill_price - 0.5 AS net FROM k WHERE is_entry)"""


_TRADES = _BASE + _book("sig")
_SHADOW = _BASE + _book("truth")
KEYS = ["user_id"]


def bars(spark, d):
    e = table(spark, d, "events").withColumn("c", candle(F.col("ts"), _N))
    g = e.groupBy("user_id", F.col("c").alias("ts")).agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.max_by("event_type", "ts").alias("last_type"), F.min_by("event_type", "ts").alias("first_type"))
    known = lambda c: F.when(F.col(c) != "error", F.col(c))
    return g.select("user_id", "ts", "open", "high", "low", "close", known("last_type").alias("sig"), known("first_type").alias("truth"))


def versions(spark):
    return T.strategies(spark, [("V1", "click", ["view"]), ("V2", "click", ["view", "purchase"])])


def trades(spark, d, signal="sig"):
    return T.pair_trades(T.bar_events(bars(spark, d), KEYS, versions(spark), signal), KEYS, 0.5)


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("t01_strategies", "SELECT * FROM (VALUES ('V1', 'click', 1), ('V2', 'click', 2)) AS v(version, entry, n_exits), (SELECT count(DISTINCT user_id) AS n_series FROM events)")
def t01(spark, d):
    n = table(spark, d, "events").agg(F.count_distinct("user_id").alias("n_series"))
    return versions(spark).select("version", "entry", F.size("exits").alias("n_exits")).crossJoin(n)


@query("t02_entries_and_exits", _TRADES + " SELECT version, count(*) FILTER (WHERE is_entry) AS n_entries, count(*) FILTER (WHERE is_exit) AS n_exits, count(*) FILTER (WHERE fire AND fill_ts IS NULL) AS n_unfilled FROM h GROUP BY 1")
def t02(spark, d):
    e = T.bar_events(bars(spark, d), KEYS, versions(spark))
    return e.groupBy("version").agg(F.count(F.when(F.col("is_entry"), 1)).alias("n_entries"), F.count(F.when(F.col("is_exit"), 1)).alias("n_exits"), F.count(F.when(F.col("fire") & F.col("fill_ts").isNull(), 1)).alias("n_unfilled"))


_BOOK = " SELECT user_id, version, CAST(entry_bar AS INTEGER) AS entry_bar, entry_ts, entry_price, exit_ts, exit_price, reason, round(points, 4) AS points, round(net, 4) AS net FROM t"


def _columns(t):
    return rounded(t, "points", "net").select("user_id", "version", "entry_bar", "entry_ts", "entry_price", "exit_ts", "exit_price", "reason", "points", "net")


@query("t03_trade_pairs", _TRADES + _BOOK)
def t03(spark, d):
    return _columns(trades(spark, d))


@query("t03_trade_pairs_two_level", _TRADES + _BOOK)
def t03b(spark, d):
    events = T.bar_events(bars(spark, d).withColumn("day", F.to_date("ts")), KEYS, versions(spark), chunk="day")
    return _columns(T.pair_trades(events, KEYS, 0.5, chunk="day"))


@query("t06_shadow_book", _SHADOW + _BOOK)
def t06(spark, d):
    return _columns(trades(spark, d, "truth"))


_REACH = _TRADES + """, i AS (SELECT *, row_number() OVER () AS id FROM t),
m AS (SELECT i.id, max(b.high) AS hi, min(b.low) AS lo FROM i JOIN b ON b.user_id = i.user_id AND b.ts >= i.entry_ts AND (b.ts < i.exit_ts OR (reason = 'end_of_data' AND b.ts <= i.exit_ts)) GROUP BY 1),
x AS (SELECT i.*, greatest(greatest(coalesce(hi, exit_price), exit_price) - entry_price, 0) AS mfe, greatest(entry_price - least(coalesce(lo, exit_price), exit_price), 0) AS mae FROM i LEFT JOIN m USING (id))"""


@query("t05_excursions", _REACH + " SELECT user_id, version, entry_ts, round(mfe, 4) AS mfe, round(mae, 4) AS mae FROM x")
def t05(spark, d):
    return rounded(T.excursions(trades(spark, d), bars(spark, d), KEYS), "mfe", "mae").select("user_id", "version", "entry_ts", "mfe", "mae")


@query("t07_equity_curve", _TRADES + """, n AS (SELECT DISTINCT version FROM t), r AS (SELECT b.user_id, b.ts, b.close, n.version FROM b, n)
SELECT user_id, version, ts, (SELECT count(*) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.entry_ts <= r.ts) - (SELECT count(*) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.exit_ts <= r.ts) AS lots,
 round((SELECT coalesce(sum(CASE WHEN t.exit_ts <= r.ts THEN exit_price ELSE r.close END - entry_price), 0) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.entry_ts <= r.ts), 4) AS gross FROM r""")
def t07(spark, d):
    return rounded(T.equity_curve(bars(spark, d).select("user_id", "ts", "close"), trades(spark, d), KEYS, versions(spark)), "gross")


_CURVE_SQL = """n AS (SELECT DISTINCT version FROM t), r AS (SELECT b.user_id, b.ts, b.close, n.version FROM b, n),
c AS (SELECT user_id, version, ts, close, (SELECT count(*) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.entry_ts <= r.ts) - (SELECT count(*) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.exit_ts <= r.ts) AS lots,
 (SELECT coalesce(sum(CASE WHEN t.exit_ts <= r.ts THEN exit_price ELSE r.close END - entry_price), 0) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.entry_ts <= r.ts) AS gross,
 (SELECT 0.5 * count(*) FROM t WHERE t.user_id = r.user_id AND t.version = r.version AND t.exit_ts <= r.ts) AS charged FROM r)"""


def curve(spark, d):
    """Curves in chunks of days; money to 4 digits, so that equal levels are equal in every engine."""
    b = bars(spark, d).select("user_id", "ts", "close", F.to_date("ts").alias("day"))
    return rounded(T.equity_curve(b, trades(spark, d), KEYS, versions(spark), chunk="day", charge=0.5), "gross", "net")


@query("t07_equity_curve_two_level", _TRADES + ", " + _CURVE_SQL + " SELECT user_id, version, ts, lots, round(gross, 4) AS gross, round(gross - charged, 4) AS net FROM c")
def t07b(spark, d):
    return curve(spark, d).drop("close", "day")


@query("t08_tradebook", _REACH + " SELECT user_id, version, entry_ts, round((epoch(exit_ts) - epoch(entry_ts)) / 60, 4) AS minutes, round(CASE WHEN mfe > 0 THEN points / mfe END, 4) AS capture, net > 0 AS paid, round(sum(net) OVER (PARTITION BY user_id, version ORDER BY entry_ts, exit_ts ROWS UNBOUNDED PRECEDING), 3) AS cum_net FROM x")
def t08(spark, d):
    t = T.tradebook(T.excursions(trades(spark, d), bars(spark, d), KEYS), KEYS)
    return t.select("user_id", "version", "entry_ts", F.round("minutes", 4).alias("minutes"), F.round("capture", 4).alias("capture"), "paid", F.round("cum_net", 3).alias("cum_net"))


_MISSED = _SHADOW.replace("t AS (SELECT user_id, version, bar", "s AS (SELECT user_id, version, bar") + _book("sig").replace(", f AS", ", f2 AS").replace("FROM f, v", "FROM f2, v").replace("v(version, entry, x1, x2) AS (VALUES ('V1', 'click', 'view', 'view'), ('V2', 'click', 'view', 'purchase')),\n", "").replace("h AS (", "h2 AS (").replace("FROM h WINDOW", "FROM h2 WINDOW").replace("k AS (", "k2 AS (").replace("FROM k WHERE", "FROM k2 WHERE").replace("f.*", "f2.*")


@query("t09_missed_trades", _MISSED + " SELECT user_id, version, entry_ts, round(greatest(net, 0), 4) AS missed, round(net, 4) AS missed_raw FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id AND t.version = s.version AND t.entry_ts = s.entry_ts)")
def t09(spark, d):
    m = T.missed_trades(trades(spark, d, "truth"), trades(spark, d), KEYS)
    return rounded(m, "missed", "missed_raw").select("user_id", "version", "entry_ts", "missed", "missed_raw")


@query("t10_unknown_signals", "SELECT DISTINCT event_type AS sig FROM events WHERE event_type NOT IN ('click', 'view', 'purchase', 'error')")
def t10(spark, d):
    return T.unknown_signals(table(spark, d, "events").select(F.col("event_type").alias("sig")), versions(spark), ["error"])


@query("a21_core_metrics", _TRADES + " SELECT version, count(*) AS n_trades, count(*) FILTER (WHERE net > 0) AS n_wins, round(sum(points), 2) AS gross, round(sum(net), 2) AS net, round(avg(net) FILTER (WHERE net > 0), 4) AS avg_win, round(avg(net) FILTER (WHERE net < 0), 4) AS avg_loss, round(max(net), 4) AS best, round(min(net), 4) AS worst, count(*) FILTER (WHERE reason = 'end_of_data') AS n_forced, round(count(*) FILTER (WHERE net > 0) * 1.0 / count(*), 6) AS win_rate, round(sum(net) FILTER (WHERE net > 0) / -sum(net) FILTER (WHERE net < 0), 4) AS profit_factor FROM t GROUP BY 1")
def a21(spark, d):
    m = T.core_metrics(trades(spark, d), ["version"])
    return rounded(m, "avg_win", "avg_loss", "best", "worst", "profit_factor").select("version", "n_trades", "n_wins", F.round("gross", 2).alias("gross"), F.round("net", 2).alias("net"), "avg_win", "avg_loss", "best", "worst", "n_forced", F.round("win_rate", 6).alias("win_rate"), "profit_factor")


@query("a21_book_metrics", _REACH + """ SELECT version, count(*) AS n_trades, round(sum(net) * 10, 2) AS net_pnl, round(sum(points) * 10, 2) AS gross_pnl, round(CAST(count(*) * 5.0 AS DOUBLE), 2) AS total_charge, count(*) FILTER (WHERE points > 0) AS n_wins_gross, count(*) FILTER (WHERE points < 0) AS n_losses_gross,
 round(count(*) FILTER (WHERE points > 0) / count(*), 6) AS win_rate_gross, round(sum(points) FILTER (WHERE points > 0) / -sum(points) FILTER (WHERE points < 0), 4) AS profit_factor_gross, round(avg(points) FILTER (WHERE points > 0) * 10, 3) AS avg_win_gross, round(-avg(points) FILTER (WHERE points < 0) * 10, 3) AS avg_loss_gross, round(avg(points) * 10, 3) AS expectancy_gross,
 count(*) FILTER (WHERE net = 0) AS n_breakeven, round(count(*) * 500.0 / abs(sum(points) * 10), 3) AS charge_pct_of_gross, round(count(*) * 500.0 / (sum(points) FILTER (WHERE points > 0) * 10), 3) AS charge_pct_of_gross_wins,
 round(avg(epoch(exit_ts) - epoch(entry_ts)) / 60, 3) AS avg_minutes, round(avg(mfe), 4) AS avg_mfe, round(avg(mae), 4) AS avg_mae, round(max(mfe), 4) AS best_mfe, round(max(mae), 4) AS worst_mae, round(sum(points) / sum(mfe) * 100, 3) AS capture_pct, round(avg(mfe) / avg(mae), 4) AS edge_ratio, round(avg(CASE WHEN mfe > 20 THEN 100.0 ELSE 0 END), 3) AS pct_past_breakeven FROM x GROUP BY 1""")
def a21b(spark, d):
    m = L.book_metrics(T.excursions(trades(spark, d), bars(spark, d), KEYS), ["version"], 10.0, 20.0)
    digits = {2: ("net_pnl", "gross_pnl", "total_charge"), 6: ("win_rate_gross",), 4: ("profit_factor_gross", "avg_mfe", "avg_mae", "best_mfe", "worst_mae", "edge_ratio"), 3: ("avg_win_gross", "avg_loss_gross", "expectancy_gross", "charge_pct_of_gross", "charge_pct_of_gross_wins", "avg_minutes", "capture_pct", "pct_past_breakeven")}
    for n, columns in digits.items():
        m = rounded(m, *columns, digits=n)
    return m.select("version", "n_trades", "n_wins_gross", "n_losses_gross", "n_breakeven", *(c for columns in digits.values() for c in columns))


@query("a21_exposure", _TRADES + ", " + _CURVE_SQL + """ SELECT version, count(*) AS n_bars, CAST(max(lots) AS BIGINT) AS peak_lots, round(coalesce(avg(lots) FILTER (WHERE lots > 0), 0), 4) AS avg_lots_in_market, round(avg(CASE WHEN lots > 0 THEN 100.0 ELSE 0 END), 3) AS pct_bars_in_market, round(avg(CASE WHEN lots > 1 THEN 100.0 ELSE 0 END), 3) AS pct_bars_multi_lot,
 round(max(close * lots * 10), 3) AS peak_notional, round(avg(close * lots * 10) FILTER (WHERE close * lots > 0), 3) AS avg_notional_in_market, count(DISTINCT CAST(ts AS DATE)) AS n_days, round(date_diff('hour', min(ts), max(ts)) // 24 / 365.25, 6) AS years FROM c GROUP BY 1""")
def a21c(spark, d):
    m = L.exposure_metrics(curve(spark, d), ["version"], 10.0)
    m = rounded(rounded(m, "pct_bars_in_market", "pct_bars_multi_lot", "peak_notional", "avg_notional_in_market", digits=3), "avg_lots_in_market")
    return m.withColumns({"years": F.round("years", 6), "peak_lots": F.col("peak_lots").cast("long")}).drop("days_per_year")


@query("a21_drawdowns", _TRADES + ", " + _CURVE_SQL + """, eq AS (SELECT *, round(gross - charged, 4) AS net FROM c), p AS (SELECT *, greatest(max(net) OVER w, 0) AS peak FROM eq WINDOW w AS (PARTITION BY user_id, version ORDER BY ts)),
q AS (SELECT *, net - peak AS dd, sum(CASE WHEN net < peak THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, version ORDER BY ts) AS g FROM p), s AS (SELECT user_id, version, g, min(dd) AS trough FROM q WHERE dd < 0 GROUP BY 1, 2, 3), a AS (SELECT user_id, version, avg(trough) AS t, count(*) AS n FROM s GROUP BY 1, 2)
SELECT q.user_id, q.version, round(min(dd), 3) AS max_drawdown, round(coalesce(any_value(a.t), 0), 6) AS avg_drawdown, coalesce(any_value(a.n), 0) AS n_drawdowns, round(avg(CASE WHEN dd < 0 THEN 100.0 ELSE 0 END), 3) AS pct_time_in_dd FROM q LEFT JOIN a ON q.user_id = a.user_id AND q.version = a.version GROUP BY 1, 2""")
def a21d(spark, d):
    return rounded(L.drawdown_metrics(curve(spark, d), ["user_id", "version"], chunk="day"), "max_drawdown", "pct_time_in_dd", digits=3).withColumn("avg_drawdown", F.round("avg_drawdown", 6))


_DAILY = _TRADES + ", y AS (SELECT version, CAST(exit_ts AS DATE) AS day, sum(net) AS net FROM t GROUP BY 1, 2), z AS (SELECT version, day, sum(net) OVER (PARTITION BY version ORDER BY day) AS equity FROM y)"


def daily(spark, d):
    y = trades(spark, d).groupBy("version", F.to_date("exit_ts").alias("day")).agg(F.sum("net").alias("net"))
    return y.select("version", "day", F.sum("net").over(W.partitionBy("version").orderBy("day").rowsBetween(W.unboundedPreceding, 0)).alias("equity"))


@query("a22_capital_metrics", _DAILY + """, c AS (SELECT *, 100000 + equity AS v FROM z), r AS (SELECT version, day, v, v / coalesce(lag(v) OVER (PARTITION BY version ORDER BY day), 100000) - 1 AS r, v / greatest(max(v) OVER (PARTITION BY version ORDER BY day), 100000) - 1 AS fall FROM c)
SELECT version, count(*) AS n_days, round(arg_max(v, day) / 100000 - 1, 5) AS total_return, round(min(fall), 5) AS worst_fall, round(avg(r) / stddev_samp(r) * sqrt(252), 3) AS sharpe, round(avg(r) / sqrt(avg(pow(least(r, 0), 2))) * sqrt(252), 3) AS sortino FROM r GROUP BY 1""")
def a22(spark, d):
    m = T.capital_metrics(daily(spark, d), ["version"], 100_000)
    return rounded(rounded(m, "total_return", "worst_fall", digits=5), "sharpe", "sortino", digits=3)


@query("a23_yearly", _TRADES + " SELECT version, strftime(exit_ts, '%Y') AS period, count(*) AS n_trades, count(*) FILTER (WHERE net > 0) AS n_wins, round(sum(net), 2) AS net FROM t GROUP BY 1, 2")
def a23(spark, d):
    return rounded(T.period_stats(trades(spark, d), ["version"], "year"), "net", digits=2)


_MONTHS = _TRADES + ", " + _CURVE_SQL + """, eq AS (SELECT *, strftime(ts, '%Y-%m') AS period, round(gross, 4) AS g, round(gross - charged, 4) AS net FROM c), z AS (SELECT user_id, version, period, arg_max(net, ts) AS fin, arg_max(g, ts) AS fing, count(DISTINCT CAST(ts AS DATE)) AS sessions FROM eq GROUP BY 1, 2, 3),
y AS (SELECT *, coalesce(lag(fin) OVER w, 0) AS beg, coalesce(lag(fing) OVER w, 0) AS begg FROM z WINDOW w AS (PARTITION BY user_id, version ORDER BY period)),
hh AS (SELECT eq.*, beg, greatest(beg, max(net) OVER (PARTITION BY eq.user_id, eq.version, eq.period ORDER BY ts)) AS high FROM eq JOIN y USING (user_id, version, period)),
l AS (SELECT user_id, version, period, min(net - high) AS dd, min((1000 + net) / (1000 + high) - 1) * 100 AS ddp FROM hh GROUP BY 1, 2, 3),
kk AS (SELECT user_id, version, strftime(exit_ts, '%Y-%m') AS period, count(*) AS trades, count(*) FILTER (WHERE net > 0) AS wins, count(*) * 0.5 AS charges FROM t GROUP BY 1, 2, 3)
SELECT user_id, version, period, sessions, coalesce(trades, 0) AS trades, coalesce(wins, 0) AS wins, round(CAST(coalesce(charges, 0) AS DOUBLE), 3) AS charges, round(dd, 3) AS max_dd, round(ddp, 4) AS max_dd_pct, round(fing - begg, 3) AS gross_pnl, round(fin - beg, 3) AS net_pnl, round((fin - beg) / 10, 4) AS return_pct FROM y JOIN l USING (user_id, version, period) LEFT JOIN kk USING (user_id, version, period)"""


@query("a23_period_curves", _MONTHS)
def a23b(spark, d):
    """Months, as the tables have one year; each starts from where the one before ended."""
    p = L.period_curves(curve(spark, d), trades(spark, d), ["user_id", "version"], 1000.0, "month")
    return rounded(rounded(p, "charges", "max_dd", "gross_pnl", "net_pnl", digits=3), "max_dd_pct", "return_pct").drop("gross_return_pct", "win_rate_pct")


@query("a24_monthly_grid", _TRADES + " SELECT version, CAST(year(exit_ts) AS INTEGER) AS year, " + ", ".join(f"round(sum(net) FILTER (WHERE month(exit_ts) = {k}), 2) AS m{k}" for k in range(1, 13)) + " FROM t GROUP BY 1, 2")
def a24(spark, d):
    return rounded(T.month_grid(trades(spark, d), ["version"]), *(f"m{k}" for k in range(1, 13)), digits=2)


@query("a25_daily_levels", "SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, ts) AS value FROM events GROUP BY 1, 2")
def a25(spark, d):
    return T.daily_levels(table(spark, d, "events"), KEYS, "value")


@query("a26_error_costs", _MISSED + """, gg AS (SELECT user_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS entry_ts, truth, sig FROM b),
j AS (SELECT t.*, gg.truth AS tr, gg.sig AS sg FROM t LEFT JOIN gg ON t.user_id = gg.user_id AND t.entry_ts = gg.entry_ts),
w AS (SELECT user_id, version, count(*) FILTER (WHERE tr <> sg) AS n_wrong_entries, round(coalesce(-sum(least(net, 0)) FILTER (WHERE tr <> sg), 0), 4) AS wrong_cost FROM j GROUP BY 1, 2),
mm AS (SELECT user_id, version, count(*) AS n_missed, round(sum(greatest(net, 0)), 4) AS missed_cost FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id AND t.version = s.version AND t.entry_ts = s.entry_ts) GROUP BY 1, 2)
SELECT user_id, version, n_wrong_entries, wrong_cost, n_missed, missed_cost FROM w FULL JOIN mm USING (user_id, version)""")
def a26(spark, d):
    x = T.error_costs(trades(spark, d), trades(spark, d, "truth"), bars(spark, d), KEYS)
    return rounded(x, "wrong_cost", "missed_cost").select("user_id", "version", "n_wrong_entries", "wrong_cost", "n_missed", "missed_cost")


@query("a26_cost_decomposition", _MISSED + """, m AS (SELECT user_id, ts, truth, sig, row_number() OVER o AS bar, lead(ts) OVER o AS fill_ts, coalesce(lead(open) OVER o, open) AS px, avg(high - low) OVER (PARTITION BY user_id ORDER BY ts ROWS 13 PRECEDING) AS atr, truth IS DISTINCT FROM lag(truth) OVER o OR row_number() OVER o = 1 AS st FROM b WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
q AS (SELECT *, last_value(CASE WHEN st THEN bar END IGNORE NULLS) OVER w AS k0, last_value(CASE WHEN st THEN px END IGNORE NULLS) OVER w AS p0, last_value(CASE WHEN st THEN atr END IGNORE NULLS) OVER w AS a0 FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)),
j AS (SELECT t.version, t.points, e.truth AS et, coalesce(e.truth IN ('view', 'purchase'), FALSE) OR coalesce(x.truth = 'click', FALSE) AS flip, e.bar - e.k0 AS late, entry_price - e.p0 AS dp, e.a0 FROM t LEFT JOIN q e ON t.user_id = e.user_id AND t.entry_ts = e.fill_ts LEFT JOIN q x ON t.user_id = x.user_id AND t.exit_ts = x.fill_ts AND reason = 'exit'),
own AS (SELECT version, count(*) FILTER (WHERE et = 'signup') AS n_false, count(*) FILTER (WHERE et = 'signup') * 5.0 AS churn, count(*) FILTER (WHERE flip) AS n_flips, coalesce(sum(abs(points)) FILTER (WHERE flip), 0) * 10 AS wrong, count(*) FILTER (WHERE et = 'click' AND late > 0) AS n_delayed,
  avg(late) FILTER (WHERE et = 'click') AS db, avg(dp) FILTER (WHERE et = 'click') AS dp, avg(dp / a0) FILTER (WHERE et = 'click' AND a0 > 0) AS da, coalesce(sum(dp) FILTER (WHERE et = 'click'), 0) * 10 AS delay FROM j GROUP BY 1),
mm AS (SELECT s.version, count(*) AS n, sum(s.points) * 10 AS g, count(*) FILTER (WHERE q.sig = 'signup') AS n_missed, coalesce(sum(greatest(s.points, 0)) FILTER (WHERE q.sig = 'signup'), 0) * 10 AS missed, coalesce(sum(s.points) FILTER (WHERE q.sig = 'signup'), 0) * 10 AS raw FROM s LEFT JOIN q ON s.user_id = q.user_id AND s.entry_ts = q.fill_ts GROUP BY 1)
SELECT version, n_false, round(CAST(churn AS DOUBLE), 3) AS churn_cost, n_flips, round(wrong, 3) AS wrong_direction_cost, n_delayed, round(db, 4) AS avg_delay_bars, round(dp, 4) AS avg_delay_points, round(da, 4) AS avg_delay_atr, round(delay, 3) AS delay_cost, n AS shadow_trades, round(g, 2) AS shadow_gross, n_missed, round(missed, 3) AS missed_cost, round(raw, 3) AS missed_raw, round(churn + missed + wrong, 2) AS total_error_cost FROM own JOIN mm USING (version)""")
def a26b(spark, d):
    """Signups are idle; bars in chunks of days."""
    over = W.partitionBy("user_id").orderBy("ts").rowsBetween(-13, 0)
    b = bars(spark, d).withColumns({"atr": F.avg(F.col("high") - F.col("low")).over(over), "day": F.to_date("ts")})
    x = L.cost_decomposition(trades(spark, d), trades(spark, d, "truth"), b, KEYS, ["click"], ["view", "purchase"], ["signup"], 10.0, atr="atr", chunk="day")
    x = rounded(rounded(x, "churn_cost", "wrong_direction_cost", "delay_cost", "missed_cost", "missed_raw", digits=3), "shadow_gross", "total_error_cost", digits=2)
    return rounded(x, "avg_delay_bars", "avg_delay_points", "avg_delay_atr")


@query("a27_churn", _BASE + ", x AS (SELECT user_id, sig, last_value(sig IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM b) SELECT user_id, count(sig) AS n_known, count(*) FILTER (WHERE sig <> p) AS n_changes FROM x GROUP BY 1")
def a27(spark, d):
    return T.churn(bars(spark, d), KEYS)


@query("a28_price_checks", _BASE + " SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing, count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS n_not_positive, CAST(0 AS BIGINT) AS n_high_below_low, CAST(0 AS BIGINT) AS n_high_below_open, CAST(0 AS BIGINT) AS n_high_below_close, CAST(0 AS BIGINT) AS n_low_above_open, CAST(0 AS BIGINT) AS n_low_above_close FROM b")
def a28(spark, d):
    return Q.price_checks(bars(spark, d))


@query("a35_metrics_long", _TRADES + ", m AS (SELECT version, CAST(count(*) AS DOUBLE) AS n_trades, round(sum(net), 2) AS net FROM t GROUP BY 1) SELECT 'n_trades' AS metric, max(n_trades) FILTER (WHERE version = 'V1') AS \"V1\", max(n_trades) FILTER (WHERE version = 'V2') AS \"V2\" FROM m UNION ALL SELECT 'net', max(net) FILTER (WHERE version = 'V1'), max(net) FILTER (WHERE version = 'V2') FROM m")
def a35(spark, d):
    m = T.core_metrics(trades(spark, d), ["version"]).select("version", F.col("n_trades").cast("double").alias("n_trades"), F.round("net", 2).alias("net"))
    return m.unpivot("version", ["n_trades", "net"], "metric", "x").groupBy("metric").pivot("version", ["V1", "V2"]).agg(F.max("x"))


_SPARSE = "(SELECT user_id, ts, sig FROM b WHERE sig IS NOT NULL)"


@query("j07_dense_grid", _BASE + f", s AS {_SPARSE}, p AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM s GROUP BY 1), g2 AS (SELECT b.user_id, b.ts, s.sig FROM b JOIN p USING (user_id) LEFT JOIN s ON b.user_id = s.user_id AND b.ts = s.ts WHERE b.ts BETWEEN lo AND hi) SELECT user_id, count(*) AS n_bars, count(sig) AS n_matched, round(count(sig) * 1.0 / count(*), 6) AS coverage, min(ts) FILTER (WHERE sig IS NULL) AS first_missing FROM g2 GROUP BY 1")
def j07(spark, d):
    b = bars(spark, d)
    return T.grid_report(T.dense_grid(b.select("user_id", "ts", "open", "close"), b.where("sig is not null").select("user_id", "ts", "sig"), KEYS), KEYS)


@query("j11_daily_by_version", _DAILY + " SELECT day, round(max(equity) FILTER (WHERE version = 'V1'), 3) AS \"V1\", round(max(equity) FILTER (WHERE version = 'V2'), 3) AS \"V2\" FROM z GROUP BY 1")
def j11(spark, d):
    a, b = (daily(spark, d).where(F.col("version") == v).select("day", F.round("equity", 3).alias(v)) for v in ("V1", "V2"))
    return a.join(b, "day", "full_outer").select("day", "V1", "V2")


@query("a37_quality_report", _BASE + " SELECT 'bars' AS what, count(*) AS n FROM b UNION ALL SELECT 'gaps', count(*) FROM b WHERE sig IS NULL UNION ALL SELECT 'no truth', count(*) FROM b WHERE truth IS NULL")
def a37(spark, d):
    b = bars(spark, d)
    counts = b.agg(F.count(F.lit(1)).alias("bars"), F.count(F.when(F.col("sig").isNull(), 1)).alias("gaps"), F.count(F.when(F.col("truth").isNull(), 1)).alias("no truth"))
    return counts.selectExpr("stack(3, 'bars', bars, 'gaps', gaps, 'no truth', `no truth`) as (what, n)")


def _atr_sql(bars: str, key: str) -> str:
    over = f"PARTITION BY {key} ORDER BY ts"
    return f"""WITH RECURSIVE {bars}, c AS (SELECT *, coalesce(lag(close) OVER ({over}), close) AS pc, row_number() OVER ({over}) AS i FROM b),
t AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr FROM c),
r AS (SELECT {key} AS k, CAST(14 AS BIGINT) AS i, avg(tr) AS atr FROM t WHERE i <= 14 GROUP BY 1 HAVING count(*) = 14
      UNION ALL SELECT r.k, t.i, (r.atr * 13 + t.tr) / 14 FROM r JOIN t ON t.{key} = r.k AND t.i = r.i + 1)
SELECT {key}, ts, round(atr, 6) AS atr FROM t LEFT JOIN r ON r.k = t.{key} AND r.i = t.i"""


@query("w10_wilder_atr", _atr_sql(_BASE.strip().removeprefix("WITH "), "user_id"))
def w10(spark, d):
    return T.wilder_atr(bars(spark, d), KEYS, "ts").select("user_id", "ts", F.round("atr", 6).alias("atr"))


@query("w10_wilder_atr_two_level", _atr_sql("b AS (SELECT 1 AS \"all\", date_trunc('hour', ts) AS ts, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close FROM events GROUP BY 2)", '"all"') + "")
def w10b(spark, d):
    """Hourly bars of all events as one series, in chunks of days."""
    e = table(spark, d, "events")
    hours = e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"))
    x = T.wilder_atr(hours.withColumns({"all": F.lit(1), "day": F.to_date("ts")}), ["all"], "ts", chunk="day")
    return x.select("all", "ts", F.round("atr", 6).alias("atr"))
