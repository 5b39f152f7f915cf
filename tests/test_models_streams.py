"""Saved preprocessing, searches, verdicts, and streams whose batches come again."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.operators.missing import Preparer, PreparerModel
from tidemark.streaming import bars


@pytest.fixture(scope="module")
def rows(spark):
    data = [(float(k % 7) if k % 5 else None, "uvw"[k % 3] if k % 4 else None, "ab"[k % 7 > 3], k % 3) for k in range(210)]
    return spark.createDataFrame(data, "x double, kind string, label string, fold int").cache()


def test_preprocessing_is_saved_and_replayed(spark, rows, tmp_path):
    train = rows.where("kind <> 'w' and x > 1")
    model = Preparer(["x"], ["kind"]).fit(train)
    assert model.fitted == {"sentinels": {"x": 2 - 4 - 1.0}, "codes": {"kind": ["u", "v"]}} and model.features == ["x", "kind_code"]
    path = f"file://{tmp_path}/prepared"
    model.write().overwrite().save(path)
    again = PreparerModel.load(path)
    assert again.fitted == model.fitted and again.uid == model.uid and again.features == model.features
    for kind, x, code, value in (("u", 4.0, 0, 4.0), ("v", None, 1, -3.0), ("w", 0.0, -1, 0.0), (None, None, -1, -3.0)):
        r = again.transform(spark.createDataFrame([(kind, x)], "kind string, x double")).first()
        assert (r.kind_code, r.x) == (code, value)
    with pytest.raises(ValueError, match="missing"):
        again.transform(rows.drop("x"))
    with pytest.raises(ValueError, match="no codes"):
        PreparerModel([], ["kind"]).transform(rows)


def test_a_pipeline_with_preprocessing_scores_alike_once_loaded(spark, rows, tmp_path):
    first = Preparer(["x"], ["kind"])
    fitted = Pipeline(stages=[first, *models.pipeline(first.features, "label", "forest", numTrees=3).getStages()]).fit(rows)
    fitted.write().overwrite().save(f"file://{tmp_path}/model")
    again = PipelineModel.load(f"file://{tmp_path}/model")
    a, b = ([r.prediction for r in m.transform(rows).orderBy("x", "kind", "label", "fold").select("prediction").collect()] for m in (fitted, again))
    assert a == b and len(a) == 210


def test_searches_refuse_skip_and_warn(spark, rows):
    known = rows.na.fill(0.0, ["x"])
    grid = {"maxDepth": [1, 2], "numTrees": [2]}
    found = models.search(known, ["x"], "label", None, grid, "fold")
    assert len(found["points"]) == 2 and not found["skipped"] and found["edges"] == ["maxDepth"]
    assert found["points"][0]["cost"] <= found["points"][1]["cost"] and found["best"]["maxDepth"] == found["points"][0]["maxDepth"]
    shuffled = known.repartition(3).orderBy(F.rand(1))
    assert models.search(shuffled, ["x"], "label", None, grid, "fold", known=found) == {**found, "skipped": True}
    more = models.search(known.union(known.limit(1)), ["x"], "label", None, grid, "fold", known=found)
    assert not more["skipped"] and more["fingerprint"] != found["fingerprint"]
    assert len(models.search(known, ["x"], "label", None, {"maxDepth": [1, 2, 3], "numTrees": [1, 2]}, "fold", draw=2)["points"]) == 2
    with pytest.raises(ValueError, match="folds"):
        models.search(known.withColumn("fold", F.lit(0)), ["x"], "label", None, grid, "fold")


def test_costs_of_a_search_are_those_of_severities(spark, rows):
    severity = spark.createDataFrame([("a", "b", 4.0)], "true_label string, pred_label string, severity double")
    scored = spark.createDataFrame([(0.0, 1.0)] + [(0.0, 0.0)] * 3 + [(1.0, 0.0), (1.0, 1.0)], "_label double, prediction double")
    evaluator = models.CostEvaluator(["a", "b"], severity)
    assert evaluator.evaluate(scored) == pytest.approx(0.25 * 4 + 0.5 * 1) and not evaluator.isLargerBetter()


@pytest.mark.parametrize("new, old, dev, inflated, keep, tied", [
    ((0.30, 5.0), (0.20, 6.0), 0.31, False, "r", False),
    ((0.30, 5.0), (0.20, 5.2), 0.31, False, "t", True),
    ((0.20, 5.0), (0.30, 5.0), 0.31, True, "t", False),
    ((0.20, 6.0), (0.20, 5.0), 0.19, False, "t", False),
])
def test_verdict_of_a_holdout(new, old, dev, inflated, keep, tied):
    scores = [{"arm": a, "part": p, "macro_f1": f, "cost": c} for a, p, f, c in (("r", "dev", dev, 1.0), ("r", "forward", *new), ("t", "dev", 0.2, 1.0), ("t", "forward", *old))]
    assert models.holdout_verdict(scores, "r", "t") == {"inflated": inflated, "keep": keep, "tied": tied}


def test_a_batch_that_comes_again_is_written_once(spark, tmp_path):
    source, state, out = (f"file://{tmp_path}/{n}" for n in ("in", "state", "out"))
    schema = "version string, rows long"
    spark.createDataFrame([("v1", 1), ("v2", 2)], schema).coalesce(1).write.mode("append").json(source)
    write, tries = bars.by_batch(out), []

    def breaks_off(df, batch):
        tries.append(batch)
        write(df, batch)
        if len(tries) == 1:
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        bars.on_new_datasets(spark, source, schema, state, breaks_off).awaitTermination()
    bars.on_new_datasets(spark, source, schema, state, breaks_off).awaitTermination()
    spark.createDataFrame([("v3", 3)], schema).write.mode("append").json(source)
    bars.on_new_datasets(spark, source, schema, state, breaks_off).awaitTermination()
    bars.on_new_datasets(spark, source, schema, state, breaks_off).awaitTermination()
    assert tries == [0, 0, 1]
    assert sorted((r.version, r.rows) for r in spark.read.parquet(out).collect()) == [("v1", 1), ("v2", 2), ("v3", 3)]


def test_truth_is_that_of_the_models_label_set(spark, rows):
    known = rows.na.fill(0.0, ["x"])
    model = models.pipeline(["x"], "label", "forest", numTrees=2).fit(known)
    two = known.withColumnsRenamed({"label": "label_L1"}).withColumns({"label_L1": F.concat(F.col("label_L1"), F.lit("  ")), "label_L2": F.lit("z"), "row": F.monotonically_increasing_id()})
    t = models.scored_table(model, two, "row", "label", {"model": "m1"}, "L1", keep=["fold"])
    assert t.columns == ["row", "fold", "split", "true_label", "predicted_label", "correct", "proba_a", "proba_b", "model"]
    for r in t.collect():
        assert r.true_label in ("a", "b") and r.correct == (r.true_label == r.predicted_label) and r.proba_a + r.proba_b == pytest.approx(1) and (r.split, r.model) == (None, "m1")
    with pytest.raises(ValueError, match="trained on L3"):
        models.scored_table(model, two, "row", "label", {}, "L3")
    none = models.scored_table(model, two.drop("label_L1", "label_L2"), "row", "label", {}, "L1").collect()
    assert len(none) == 210 and all(r.true_label is None and r.correct is None and r.predicted_label for r in none)
    assert models.truth_column(["label"], "label", "L1") == "label" and models.truth_column(["label_L1"], "label", None) is None


def test_long_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    import hashlib

    from tidemark.sources import readers

    for k, n in enumerate((1, 4096, 3_000_001)):
        (tmp_path / f"sub {k}").mkdir()
        (tmp_path / f"sub {k}" / "f.bin").write_bytes(bytes(range(256)) * (n // 256) + b"x" * (n % 256))
    want = sorted(hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.rglob("*.bin"))
    for whole in (1 << 30, 4000, -1):
        got = readers.content_hashes(spark, str(tmp_path), whole).collect()
        assert sorted(r.sha256 for r in got) == want and len({r.path for r in got}) == 3


def test_no_long_file_is_one_value(spark, tmp_path):
    import hashlib

    from tidemark.sources import readers

    for k, n in enumerate((5, 40_000_000, 20_000_000)):
        (tmp_path / f"{k} of.bin").write_bytes(bytes([k]) * n)
    want = sorted(hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.glob("*.bin"))
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.hashed.link./in", f"file://{tmp_path}")
    assert sorted(r.sha256 for r in readers.content_hashes(spark, "viewfs://hashed/in").collect()) == want  # Arrow can't open it
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 32_000_000)
    try:
        assert sorted(r.sha256 for r in readers.content_hashes(spark, str(tmp_path)).collect()) == want
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_a_directory_of_parts_is_one_table(spark, tmp_path):
    from tidemark.sources import readers

    spark.range(40).repartition(3).write.parquet(f"{tmp_path}/deep/many.parquet")
    spark.range(4).withColumn("n", F.col("id")).write.partitionBy("id").parquet(f"{tmp_path}/parted.parquet")
    spark.range(3).toPandas().to_parquet(tmp_path / "one.parquet")
    found = readers.read_folder(spark, str(tmp_path)).collect()
    assert sorted((r.name, r.group, r.path.rpartition("/")[2]) for r in found) == [("many", "deep", "many.parquet"), ("one", None, "one.parquet"), ("parted", None, "parted.parquet")]
    kept = readers.folder_changes(*[readers.read_folder(spark, str(tmp_path)).select("name", "path")] * 2).collect()
    assert sorted((r.name, r.change) for r in kept) == [(n, "kept") for n in ("many", "one", "parted")]
    (tmp_path / "other").mkdir()
    spark.range(3).toPandas().to_parquet(tmp_path / "other" / "many.parquet")
    with pytest.raises(ValueError, match="named many"):
        readers.read_folder(spark, str(tmp_path))


def test_shuffled_labels_lose_no_row(spark, tmp_path):
    """Ranges that are not put together again, as those of a large table are not."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        spark.range(0, 60_000, 1, 3).select(F.col("id"), F.concat(F.lit("k"), F.col("id") % 5).alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("more")).write.parquet(f"{tmp_path}/t")
        df = spark.read.parquet(f"{tmp_path}/t")
        counts = models.shuffled(df, "label", "id", 5).groupBy("label").count().collect()
    finally:
        spark.conf.set(name, before)
    assert sorted((r[0], r[1]) for r in counts) == [(f"k{k}", 12_000) for k in range(5)]


def test_no_task_fits_more_rows_than_its_share(spark):
    one = spark.range(0, 50_000, 1, 1)
    assert models.dealt(one, 6_000).rdd.getNumPartitions() == 9 and models.dealt(one).rdd.getNumPartitions() == 4
    assert models.dealt(one.limit(100)).rdd.getNumPartitions() == 1 and models.dealt(one.where("id < 0")).count() == 0
    sizes = models.dealt(one, 6_000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in sizes) == 50_000 and max(r[1] for r in sizes) <= 6_000


def test_sessions_move_no_row(spark):
    """Days are few and local: their join deals no rows, and folds and cuts are known before rows are read."""
    from tidemark.operators import splits

    df = spark.range(0, 2_000, 1, 3).select(F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"), "id")
    for made in (splits.with_session(df), splits.three_way(df, 0.1, 0.2, 1), splits.purged_folds(df, 3, 0, 0)):
        assert "SortMergeJoin" not in (plan := made._jdf.queryExecution().executedPlan().toString()) and "hashpartitioning" not in plan
    assert splits.with_session(df.where("id < 0")).count() == 0


def test_clocks_deal_more_rows_to_more_tasks(spark, monkeypatch):
    from tidemark.operators import clocks

    df = spark.range(4_000).select((F.col("id") % 40).alias("k"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).cast("double").alias("x"))
    want = clocks.bar_constancy(df, ["k"], ["x"]).collect()
    monkeypatch.setattr(clocks, "CELLS", 100, raising=False)
    many = clocks.bar_constancy(df, ["k"], ["x"])
    assert sorted(many.collect()) == sorted(want)
    assert "40), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
