"""Queries: models, streams, files (ML, V08, ST, S02, S07-S09, S14, S15)."""

from pyspark.sql import functions as F

from tidemark.functions.timebars import ANCHOR
from tidemark.operators import catalog as K
from tidemark.operators import models as X
from tidemark.operators import splits as S
from tidemark.plans.alignment import _start
from tidemark.plans.registry import query, table
from tidemark.sources import readers as R
from tidemark.streaming import bars as B

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark, d):
    i = table(spark, d, "lineitem")
    return i.withColumn("id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))


def fitted(spark, d):
    x = S.random_rows(lines(spark, d), "id", 0.3, 3)
    train = x.where("split = 'train'")
    prepared = X.Prepared(train, FEATURES, ["l_linestatus"])
    model = X.fit(X.pipeline(prepared.columns, "l_returnflag", "forest", numTrees=5, maxDepth=4), prepared.apply(train))
    return x, prepared, model


@query("ml1_trained_forest")
def ml1(spark, d):
    _, prepared, model = fitted(spark, d)
    return X.importances(model, prepared.columns)


@query("ml2_batch_scores")
def ml2(spark, d):
    x, prepared, model = fitted(spark, d)
    return X.score(model, prepared.apply(x.where("split = 'test'")), "l_returnflag").select("id", F.col("l_returnflag").alias("true_label"), "predicted_label", "correct", F.round(F.col("proba")["A"], 4).alias("proba_A"))


def by_shipping(spark, d):
    """Lines with the fold of their shipping date's block."""
    return S.purged_folds(lines(spark, d), 3, 0, 0, ts="l_shipdate").where("role = 'test'").drop("role", "session")


GRID = {"numTrees": [3], "maxDepth": [2, 3, 4]}


@query("ml2_scored_table", "SELECT l_orderkey * 8 + l_linenumber AS id, l_returnflag AS true_label, 'forest' AS model, 'lines-v1' AS scored_dataset, 'L1' AS label_set, TRUE AS sums_to_one FROM lineitem")
def ml2t(spark, d):
    """All lines with the truth of the set that the model was trained on, of two that they have, every class's probability and the lineage."""
    x, prepared, model = fitted(spark, d)
    tagged = x.withColumns({"l_returnflag_L1": F.concat(F.col("l_returnflag"), F.lit(" ")), "l_returnflag_L2": F.lit("other")})
    t = X.scored_table(model, prepared.apply(tagged).drop("l_returnflag"), "id", "l_returnflag", {"model": "forest", "scored_dataset": "lines-v1", "label_set": "L1"}, "L1", "split")
    total = sum((F.col(c) for c in t.columns if c.startswith("proba_")), F.lit(0.0))
    return t.select("id", "true_label", "model", "scored_dataset", "label_set", (F.abs(total - 1) < 1e-6).alias("sums_to_one"))


@query("ml3_search_by_cost")
def ml3(spark, d):
    """Each depth's cost over the folds, which is the best, and whether it ends the grid's range; asked again, nothing is trained."""
    x = by_shipping(spark, d)
    found = X.search(x, FEATURES, "l_returnflag", None, GRID, "fold")
    again = X.search(x, FEATURES, "l_returnflag", None, GRID, "fold", known=found)
    rows = [(p["maxDepth"], float(p["cost"]), p["maxDepth"] == again["best"]["maxDepth"], "maxDepth" in again["edges"], again["skipped"]) for p in again["points"]]
    return spark.createDataFrame(rows, "max_depth int, cost double, best boolean, at_edge boolean, skipped boolean")


@query("ml5_split_arms")
def ml5(spark, d):
    e = table(spark, d, "events").withColumns({"hour": F.hour("ts").cast("double"), "label": F.col("event_type")})
    made = {"rows": S.random_rows(e, "event_id", 0.3, 3), "time": S.three_way(e, 0.1, 0.2, 1), "candles": S.bundle_random(e, 0.1, 0.2, 7)}
    return spark.createDataFrame(X.arms(e, made, ["value", "hour"], "label", None), "arm string, accuracy double, cost double")


@query("ml6_ignored_features")
def ml6(spark, d):
    """One of the features has one value."""
    x = lines(spark, d).withColumn("flat", F.col("l_orderkey") * 0.0)
    features = [*FEATURES, "flat"]
    model = X.fit(X.pipeline(features, "l_returnflag", "forest", numTrees=5, maxDepth=4), x)
    return X.importances(model, features).where("importance < 0.001").select("feature")


def holdout_arms(spark, d):
    """Two development splits of all but the last fifth of events, and that fifth."""
    e = table(spark, d, "events").withColumns({"hour": F.hour("ts").cast("double"), "label": F.col("event_type")})
    whole = S.three_way(e, 0.1, 0.2, 1)
    dev, ahead = whole.where("split <> 'test'").drop("split", "session"), whole.where("split = 'test'").drop("session")
    return {"candles": S.bundle_random(dev, 0.1, 0.2, 7), "time": S.three_way(dev, 0.1, 0.2, 1)}, ahead


@query("v08_forward_holdout")
def v08(spark, d):
    arms, ahead = holdout_arms(spark, d)
    scores = X.holdout_scores(arms, ahead, ["value", "hour"], "label", None)
    verdict = X.holdout_verdict(scores, "candles", "time")
    rows = [(s["arm"], s["part"], s["macro_f1"], s["cost"], verdict["inflated"], verdict["keep"], verdict["tied"]) for s in scores]
    return spark.createDataFrame(rows, "arm string, part string, macro_f1 double, cost double, inflated boolean, keep string, tied boolean")


_SAVED = "WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 1) AS q, CASE WHEN l_discount > 0.02 THEN l_discount END AS disc, l_returnflag AS mode FROM lineitem), t AS (SELECT * FROM g WHERE l_partkey % 5 < 4 AND mode <> 'R'), s AS (SELECT min(q) - (max(q) - min(q)) - 1 AS sq, min(disc) - (max(disc) - min(disc)) - 1 AS sd FROM t), c AS (SELECT mode, row_number() OVER (ORDER BY mode) - 1 AS code FROM (SELECT DISTINCT mode FROM t)) SELECT l_orderkey, l_linenumber, round(CAST(coalesce(q, sq) AS DOUBLE), 6) AS q, round(CAST(coalesce(disc, sd) AS DOUBLE), 6) AS disc, CAST(coalesce(code, -1) AS INTEGER) AS mode_code FROM g CROSS JOIN s LEFT JOIN c USING (mode)"


@query("m08_saved_and_replayed", _SAVED)
def m08(spark, d):
    """Sentinels and codes learnt from a part that lacks a mode, saved, loaded, and applied to all lines."""
    from tidemark.operators.missing import Preparer, PreparerModel

    g = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_quantity") != 1, F.col("l_quantity")).alias("q"), F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("disc"), F.col("l_returnflag").alias("mode"))
    path = R.scratch(spark, "prepared")
    Preparer(["q", "disc"], ["mode"]).fit(g.where("l_partkey % 5 < 4 and mode <> 'R'")).write().overwrite().save(path)
    return PreparerModel.load(path).transform(g).select("l_orderkey", "l_linenumber", F.round("q", 6).alias("q"), F.round("disc", 6).alias("disc"), "mode_code")


@query("ml5_shuffled_labels", "SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1")
def ml5s(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("label"))
    return X.shuffled(e, "label", "event_id", 5).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


_BARS = f"SELECT user_id, {_start(60)} AS bar, {_start(60)} + INTERVAL 60 MINUTE AS close_ts, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS n FROM events GROUP BY 1, 2, 3"


@query("st2_closed_bars_batch", _BARS)
def st2(spark, d):
    return B.closed_bars(table(spark, d, "events"), ["user_id"], 60, "value", anchor=ANCHOR)


@query("st2_closed_bars_stream", f"WITH b AS ({_BARS}) SELECT * FROM b WHERE close_ts <= (SELECT max(ts) FROM events)")
def st2s(spark, d):
    """All of events as a stream; the bars that the last event leaves open never appear."""
    e = table(spark, d, "events")
    src, out, state = (R.scratch(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    e.write.parquet(src)
    stream = B.closed_bars(B.event_stream(spark, src, e.schema, 1000), ["user_id"], 60, "value")
    q = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("st1_new_datasets_once", "SELECT event_type AS version, count(*) AS rows FROM events GROUP BY 1")
def st1(spark, d):
    """A manifest for each event type, handled by two runs of the stream; each is handled once."""
    src, out, state = (R.scratch(spark, n) for n in ("manifests", "handled", "manifest-state"))
    m = table(spark, d, "events").groupBy(F.col("event_type").alias("version")).agg(F.count(F.lit(1)).alias("rows"))
    m.write.json(src)
    for _ in range(2):
        B.on_new_datasets(spark, src, m.schema, state, B.by_batch(out)).awaitTermination()
    return spark.read.schema(m.schema).parquet(out).select(*m.columns)


@query("s02_folder_scan")
def s02(spark, d):
    return R.read_folder(spark, f"{d}").select("name")


@query("s02_moved_and_orphaned", "SELECT lower(r_name) AS name, 'orphan' AS change FROM region UNION ALL SELECT unnest(['lineitem', 'orders']), 'moved' UNION ALL SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations']), 'kept'")
def s02b(spark, d):
    """The folder against a catalogue that has two files elsewhere and one for each region."""
    found = R.read_folder(spark, d).select("name", "path")
    elsewhere = F.when(F.col("name").isin("lineitem", "orders"), F.concat(F.lit("old/"), "path")).otherwise(F.col("path"))
    known = found.select("name", elsewhere.alias("path")).union(table(spark, d, "region").select(F.lower("r_name"), F.lit("gone")))
    return R.folder_changes(found, known).select("name", "change")


@query("s07_schema_gaps", "SELECT 'missing' AS what, 'o_extra' AS \"column\" WHERE (SELECT count(*) FROM orders) > 0 UNION ALL SELECT 'extra', 'o_orderpriority' WHERE (SELECT count(*) FROM orders) > 0")
def s07(spark, d):
    from pyspark.sql import types as T

    o = table(spark, d, "orders").schema
    expected = T.StructType([f for f in o if f.name != "o_orderpriority"] + [T.StructField("o_extra", T.DoubleType())])
    found = R.schema_gaps(o, expected)
    return spark.createDataFrame([(k, c) for k, cs in found.items() for c in cs], "what string, column string")


@query("s08_stamped", "SELECT o_orderkey, o_orderstatus FROM orders")
def s08(spark, d):
    path = R.scratch(spark, "stamped")
    R.stamp(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", labels="v1").write.parquet(path)
    again = spark.read.parquet(path)
    R.read_stamp(again, "o_orderstatus", labels="v1")
    return again


@query("s09_certified_write", "SELECT * FROM customer")
def s09(spark, d):
    return R.write_certified(table(spark, d, "customer"), R.scratch(spark, "certified"))


@query("s12_report_tables", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def s12(spark, d):
    path = R.scratch(spark, "report")
    o = table(spark, d, "orders")
    R.write_report({"summary": o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "rows": o.limit(10)}, path)
    return spark.read.parquet(f"{path}/summary")


@query("s13_manifest_round_trip", "SELECT 'v1' AS version, count(*) AS rows FROM orders")
def s13(spark, d):
    path = R.scratch(spark, "manifest")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    K.manifest(o, "v1", ["o_orderkey"], "o_orderstatus", "closed bars only").write.json(path)
    return spark.read.json(path).select("version", "rows")


@query("s14_content_hashes")
def s14(spark, d):
    """The content of every file of the folder."""
    return R.content_hashes(spark, d).select("sha256")


_NOTEBOOK_CODE = "'x = ' || r_regionkey || chr(10) || 'y = x' || chr(10) || 'print(\"' || r_name || '\")'"


@query("s14_notebook_hashes", f"SELECT r_regionkey, sha256({_NOTEBOOK_CODE}) AS sha256 FROM region UNION ALL SELECT r_regionkey, sha256({_NOTEBOOK_CODE}) FROM region")
def s14b(spark, d):
    """Two runs of a notebook for each region, with other outputs and the same code."""
    path = R.scratch(spark, "notebooks")
    source = lambda *lines: F.array(*lines)
    cell = lambda kind, lines, note: F.struct(F.lit(kind).alias("cell_type"), lines.alias("source"), note.alias("outputs"))
    code = (source(F.concat(F.lit("x = "), F.col("r_regionkey"), F.lit("\n")), F.lit("y = x")), source(F.concat(F.lit('print("'), F.col("r_name"), F.lit('")'))))
    runs = table(spark, d, "region").withColumn("run", F.explode(F.array(F.lit(1), F.lit(2))))
    note = F.concat(F.lit("out "), F.col("run"))
    book = F.to_json(F.struct(F.array(cell("code", code[0], note), cell("markdown", source(F.lit("words")), note), cell("code", code[1], note)).alias("cells")))
    runs.select(book.alias("value"), F.col("r_regionkey").alias("region"), "run").repartition("region", "run").write.partitionBy("region", "run").text(path)
    return R.code_hashes(spark, path, "*.txt").select(F.regexp_extract("path", "region=([0-9]+)", 1).cast(table(spark, d, "region").schema["r_regionkey"].dataType).alias("r_regionkey"), "sha256")


@query("s15_dataset_catalogue", "SELECT 'v' || (o_custkey % 3) AS version, count(*) AS rows, CAST(1 AS INTEGER) AS n_features, CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS n_classes, 'certified' AS status FROM orders GROUP BY 1")
def s15(spark, d):
    o = table(spark, d, "orders")
    parts = [K.manifest(o.where(F.col("o_custkey") % 3 == k).select("o_orderkey", "o_orderstatus"), f"v{k}", ["o_orderkey"], "o_orderstatus", "closed bars only") for k in range(3)]
    return K.dataset_catalogue(parts[0].union(parts[1]).union(parts[2]))
