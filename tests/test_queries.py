"""Every registered query of the library against its DuckDB twin, or for having rows."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest
from compare import duck, differences
from conftest import SF
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.operators.splits import bundle_random, random_rows
from tidemark.plans import all_queries, all_sql
from tidemark.plans.jobs import FEATURES, GRID, by_shipping, holdout_arms, lines

QUERIES, SQL = all_queries(), all_sql()


def importances_are_shares(spark, rows):
    assert {r.feature for r in rows} >= set(FEATURES) and all(r.importance >= 0 for r in rows)
    assert sum(r.importance for r in rows) == pytest.approx(1, abs=1e-6)


def scores_beat_the_commonest_class(spark, rows):
    test = {r.id: r.l_returnflag for r in random_rows(lines(spark, SF), "id", 0.3, 3).where("split = 'test'").collect()}
    assert {r.id: r.true_label for r in rows} == test and all(r.correct == (r.true_label == r.predicted_label) for r in rows)
    assert sum(r.correct for r in rows) / len(rows) >= max(Counter(test.values()).values()) / len(rows) - 0.02
    assert all(0 <= r.proba_A <= 1 for r in rows)


def cost_by_hand(pairs):
    """Of (truth, prediction): each mistake's share of its true class, rounded as reports round it."""
    true, both = Counter(t for t, _ in pairs), Counter(pairs)
    return sum(round(n / true[t], 4) for (t, p), n in both.items() if t != p)


def predictions_of(model, df, label):
    return [(r[0], r[1]) for r in models.score(model, df, label).select(label, "predicted_label").collect()]


def deeper_trees_were_tried(spark, rows):
    assert sorted(r.max_depth for r in rows) == GRID["maxDepth"] and all(r.skipped for r in rows)
    x = by_shipping(spark, SF).cache()
    for r in rows:
        costs = []
        for k in range(3):
            model = models.pipeline(FEATURES, "l_returnflag", "forest", numTrees=3, maxDepth=r.max_depth).fit(x.where(f"fold <> {k}"))
            costs.append(cost_by_hand(predictions_of(model, x.where(f"fold = {k}"), "l_returnflag")))
        assert r.cost == pytest.approx(sum(costs) / 3, abs=0.1)  # forests of equal seeds see their rows in other orders
    best = min(rows, key=lambda r: (r.cost, r.max_depth))
    assert [r.max_depth for r in rows if r.best] == [best.max_depth] and all(r.at_edge == (best.max_depth != 3) for r in rows)


def every_arm_is_scored(spark, rows):
    assert {r.arm for r in rows} == {"rows", "time", "candles"} and all(0 <= r.accuracy <= 1 and r.cost >= 0 for r in rows)
    e = spark.read.parquet(f"{SF}/events.parquet").withColumns({"hour": F.hour("ts").cast("double"), "label": F.col("event_type")})
    for arm, parted in {"rows": random_rows(e, "event_id", 0.3, 3), "candles": bundle_random(e, 0.1, 0.2, 7)}.items():
        model = models.pipeline(["value", "hour"], "label", "linear").fit(parted.where("split = 'train'"))
        pairs = predictions_of(model, parted.where("split = 'test'"), "label")
        r = next(r for r in rows if r.arm == arm)
        assert r.accuracy == pytest.approx(sum(t == p for t, p in pairs) / len(pairs)) and r.cost == pytest.approx(cost_by_hand(pairs), abs=1e-3)


def f1_by_hand(pairs):
    classes = {c for pair in pairs for c in pair}
    hit, true, said = (Counter(x) for x in ([t for t, p in pairs if t == p], [t for t, _ in pairs], [p for _, p in pairs]))
    return sum(2 * hit[c] / (true[c] + said[c]) for c in classes) / len(classes)


def every_part_has_a_cost(spark, rows):
    assert {(r.arm, r.part) for r in rows} == {(a, p) for a in ("candles", "time") for p in ("dev", "forward")}
    made, ahead = holdout_arms(spark, SF)
    at = {(r.arm, r.part): r for r in rows}
    for arm, parted in made.items():
        model = models.pipeline(["value", "hour"], "label", "linear").fit(parted.where("split = 'train'"))
        for part, df in (("dev", parted.where("split = 'test'")), ("forward", ahead)):
            pairs = predictions_of(model, df, "label")
            assert at[arm, part].cost == pytest.approx(cost_by_hand(pairs), abs=1e-3) and at[arm, part].macro_f1 == pytest.approx(f1_by_hand(pairs), abs=1e-5)
    dev, new, old = at["candles", "dev"], at["candles", "forward"], at["time", "forward"]
    assert {r.inflated for r in rows} == {dev.macro_f1 - new.macro_f1 > 0.02}
    assert {r.keep for r in rows} == {"candles" if new.macro_f1 > old.macro_f1 + 0.005 and new.cost < old.cost - 0.5 else "time"}


def unused_features_are_those_without_importance(spark, rows):
    assert {r.feature for r in rows} == {"flat"}
    known = {r.feature: r.importance for r in QUERIES["ml1_trained_forest"](spark, SF).collect()}
    assert all(known[f] >= 0.001 for f in FEATURES)


def names_are_the_files(spark, rows):
    assert sorted(r.name for r in rows) == sorted(p.stem for p in Path(SF).rglob("*.parquet"))


def hashes_are_the_files(spark, rows):
    assert sorted(r.sha256 for r in rows) == sorted(hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(SF).rglob("*.parquet"))


CHECKS = {
    "ml1_trained_forest": importances_are_shares, "ml2_batch_scores": scores_beat_the_commonest_class, "ml3_search_by_cost": deeper_trees_were_tried, "ml5_split_arms": every_arm_is_scored,
    "ml6_ignored_features": unused_features_are_those_without_importance, "v08_forward_holdout": every_part_has_a_cost, "s02_folder_scan": names_are_the_files, "s14_content_hashes": hashes_are_the_files,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        CHECKS[name](spark, df.collect())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
