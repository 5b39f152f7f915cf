"""Model jobs with Spark's own learners: prepared on the training part, chosen by trading cost, scored for every class."""

from __future__ import annotations

import hashlib
import itertools
import random
import statistics
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import missing as M
from tidemark.sources import readers as R


class Prepared:
    """Sentinels and category codes learnt from the training part, and how to apply them again."""

    def __init__(self, train: DataFrame, numbers: list[str], texts: list[str]):
        self.numbers, self.texts = numbers, texts
        self.sentinels = M.sentinels(train, numbers).first().asDict() if numbers else {}
        self.codes = {c: M.category_codes(train, c) for c in texts}

    @property
    def columns(self) -> list[str]:
        return [*self.numbers, *(f"{c}_code" for c in self.texts)]

    def apply(self, df: DataFrame) -> DataFrame:
        out = M.fill_sentinel(df, self.sentinels)
        for c, codes in self.codes.items():
            out = M.encode(out, c, codes)
        return out


def pipeline(features: list[str], label: str, kind: str = "forest", weight: str | None = None, **params) -> Pipeline:
    """Label codes, feature vector and a learner: forest or linear."""
    learner = {"forest": RandomForestClassifier, "linear": LogisticRegression}[kind](labelCol="_label", featuresCol="_features", **({"seed": 7} if kind == "forest" else {}) | params)
    if weight:
        learner.setWeightCol(weight)
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep"), VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep"), learner])


ROWS = 500_000  # of a training part that one task holds


def dealt(df: DataFrame, rows: int = ROWS) -> DataFrame:
    """df in parts of about `rows` rows at most, however few parts it comes in; a small table in one for each core at most."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(-(-n // rows), min(cores, n // 10_000), 1))


def fit(learner: Pipeline, train: DataFrame) -> PipelineModel:
    """A pipeline() fitted on a training part, of which learners keep a row for every row, in parts of bounded size."""
    coder, vectors, last = learner.getStages()
    weight = [last.getWeightCol()] if last.isDefined("weightCol") else []
    used = train.select(*dict.fromkeys([*vectors.getInputCols(), coder.getInputCol(), *weight]))
    return Pipeline(stages=[coder.fit(used), vectors, last]).fit(dealt(used))


def class_weights(df: DataFrame, label: str, weights: dict[str, float], name: str = "weight") -> DataFrame:
    """df with each class's weight; refuses a class without one."""
    lost = [r[0] for r in df.select(label).distinct().collect() if r[0] is not None and r[0] not in weights]
    if lost:
        raise ValueError(f"no weight for {', '.join(lost)}")
    pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
    return df.withColumn(name, F.create_map(*pairs)[F.col(label)])


def score(model: PipelineModel, df: DataFrame, true: str | None = None) -> DataFrame:
    """df with predicted_label and proba, a map of every class; and correct, if truth is given."""
    classes = [c for c in model.stages[0].labels]
    scored = model.transform(df if true in df.columns or true is None else df.withColumn(true, F.lit(None).cast("string")))
    names = F.array(*map(F.lit, classes))
    p = F.slice(vector_to_array("probability"), 1, len(classes))
    out = scored.withColumns({"proba": F.map_from_arrays(names, p), "predicted_label": F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))})
    out = out.drop("_label", "_features", "rawPrediction", "probability", "prediction")
    return out.withColumn("correct", F.col("predicted_label") == F.col(true)) if true else out


def truth_column(columns: list[str], label: str, label_set: str | None) -> str | None:
    """The column that holds a model's truth: label_<set> for the set that it was trained on, or the plain label.

    A table that has other sets' truths and not the model's is refused, as wrong labels would look
    like a bad model; one without any truth gives None.
    """
    tagged = sorted(c for c in columns if c.startswith(f"{label}_"))
    if label_set and f"{label}_{label_set}" in columns:
        return f"{label}_{label_set}"
    if label_set and tagged:
        raise ValueError(f"the model was trained on {label_set}, the table only has {', '.join(tagged)}")
    return label if label in columns else None


def scored_table(model: PipelineModel, df: DataFrame, id_col: str, label: str, lineage: dict[str, str], label_set: str | None = None, split: str | None = None, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """id, `keep`, split, true_label, predicted_label, correct, a proba_ column for every class that the model knows, and the lineage as columns.

    The truth is that of the label set that the model was trained on (see truth_column), trimmed;
    without one, true_label and correct are null, as rows that have no labels yet are scored too. A
    class that the training part lacked has probability 0. Lineage (which model, on which rows)
    is the same in every row, so that tables can be put together and told apart.
    """
    truth = truth_column(df.columns, label, label_set)
    named = df.withColumn("true_label", F.trim(F.col(truth).cast("string")) if truth else F.lit(None).cast("string"))
    coded = named.withColumn(model.stages[0].getInputCol(), F.col("true_label"))
    scored = score(model, coded)
    fixed = [F.coalesce(F.col("proba")[c], F.lit(0.0)).alias(f"proba_{c}") for c in model.stages[0].labels]
    part = F.col(split).cast("string") if split else F.lit(None).cast("string")
    said = [F.lit(v).alias(k) for k, v in lineage.items()]
    return scored.select(id_col, *keep, part.alias("split"), "true_label", "predicted_label", (F.col("predicted_label") == F.col("true_label")).alias("correct"), *fixed, *said)


def cost(scored: DataFrame, true: str, severity: DataFrame | None) -> float:
    return E.trading_cost(E.rank_mistakes(scored, true, "predicted_label", severity)).first()["cost"]


class CostEvaluator(Evaluator):
    """The trading cost of a scored table: the mistakes' rates times their severities, summed; smaller is better.

    Labels are the codes of a StringIndexer with these names, in the columns _label and prediction.
    """

    def __init__(self, names: list[str], severity: DataFrame | None = None):
        super().__init__()
        self.names, self.severity = names, severity

    def _evaluate(self, dataset: DataFrame) -> float:
        names = F.array(*map(F.lit, self.names))
        named = dataset.select(*(F.get(names, F.col(c).cast("int")).alias(c) for c in ("_label", "prediction")))
        return float(E.trading_cost(E.rank_mistakes(named, "_label", "prediction", self.severity)).first()["cost"])

    def isLargerBetter(self) -> bool:
        return False

    def copy(self, extra=None) -> CostEvaluator:
        return self  # has no params; a table of severities can't be copied deeply


def fingerprint(df: DataFrame) -> str:
    """Of a table's rows, whatever their order: their number and the sum of their hashes, with the columns' names and types."""
    digest = df.select(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).first()
    return f"{digest['n']}:{digest['s']}:{hashlib.sha256(repr(sorted(df.dtypes)).encode()).hexdigest()[:16]}"


def at_edges(best: dict, grid: dict[str, list]) -> list[str]:
    """Params whose best value is the least or largest of several that were tried: the optimum may lie beyond."""
    return [name for name, values in grid.items() if len(set(values)) > 1 and best[name] in (min(values), max(values))]


def search(train: DataFrame, features: list[str], label: str, severity: DataFrame | None, grid: dict[str, list], fold: str, kind: str = "forest", weight: str | None = None, draw: int | None = None, seed: int = 7, known: dict | None = None, parallelism: int = 1) -> dict:
    """Cross-validated search for the point of a grid with the least mean trading cost.

    train has a column `fold` of whole numbers from 0; each fold is the validation part once. Points
    are all of the grid, or `draw` of them at random. Returns fingerprint (of the data, the grid and
    the folds), points (each with its mean cost and that of each fold, the cheapest first), best,
    edges (params whose best value ends their range) and skipped: if `known`, an earlier result, has
    the same fingerprint, it is given back and nothing is trained. Refuses fewer than two folds, as
    there would be nothing to validate on.

    Rows are coded and written once, in files of bounded length, and every fold reads them there;
    `parallelism` points are trained at a time, each of which keeps its training part in memory.
    """
    used = train.select(*features, label, fold, *([weight] if weight else []))
    mark = f"{fingerprint(used)}/{hashlib.sha256(repr((sorted(grid.items()), features, label, fold, kind, weight, draw, seed)).encode()).hexdigest()[:16]}"
    if known and known.get("fingerprint") == mark:
        return {**known, "skipped": True}
    folds = used.agg(F.count_distinct(fold).alias("n"), F.min(fold).alias("lo"), F.max(fold).alias("hi")).first()
    if folds["n"] < 2 or folds["lo"] != 0 or folds["hi"] != folds["n"] - 1:
        raise ValueError("a search needs two folds or more, numbered from 0, to validate on")
    stages = pipeline(features, label, kind, weight).getStages()
    coder = stages[0].fit(used)  # the classes of all folds
    names = sorted(grid)
    points = [dict(zip(names, values, strict=True)) for values in itertools.product(*(grid[n] for n in names))]
    if draw is not None and draw < len(points):
        points = random.Random(seed).sample(points, draw)
    learner = stages[2]
    maps = [{learner.getParam(n): v for n, v in point.items()} for point in points]
    evaluator, spark, path = CostEvaluator(coder.labels, severity), train.sparkSession, R.scratch(train.sparkSession, "search")
    coded = coder.transform(used).select(*features, "_label", F.col(fold).cast("int").alias("_fold"), *([weight] if weight else []))
    try:
        dealt(coded, ROWS // 2).write.parquet(path)
        ready = stages[1].transform(spark.read.parquet(path))

        def tried(params: dict, k: int) -> float:
            model = learner.fit(ready.where(F.col("_fold") != k), params)
            return evaluator.evaluate(model.transform(ready.where(F.col("_fold") == k)))

        with ThreadPool(parallelism) as pool:
            costs = pool.starmap(inheritable_thread_target(spark)(tried), [(params, k) for params in maps for k in range(folds["n"])], 1)
    finally:
        R.drop(spark, path)
    by_point = [{**point, "cost": statistics.fmean(own), "spread": statistics.pstdev(own)} for point, own in zip(points, itertools.batched(costs, folds["n"]), strict=True)]
    ordered = sorted(by_point, key=lambda x: (x["cost"], [x[n] for n in names]))
    best = {n: ordered[0][n] for n in names}
    return {"fingerprint": mark, "points": ordered, "best": best, "edges": at_edges(best, grid), "skipped": False}


def importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """(feature, importance) of a forest."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray().tolist()
    return SparkSession.getActiveSession().createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double")


def arms(df: DataFrame, splits: dict[str, DataFrame], features: list[str], label: str, severity: DataFrame | None, kind: str = "linear") -> list[tuple[str, float, float]]:
    """(arm, accuracy, cost) of the same model on different splits (df with split)."""
    out = []
    for name, parted in splits.items():
        model = fit(pipeline(features, label, kind), parted.where("split = 'train'"))
        scored = score(model, parted.where("split = 'test'"), label)
        out.append((name, scored.agg(F.avg(F.col("correct").cast("int"))).first()[0], cost(scored, label, severity)))
    return out


def holdout_scores(arms_: dict[str, DataFrame], ahead: DataFrame, features: list[str], label: str, severity: DataFrame | None, kind: str = "linear") -> list[dict]:
    """arm, part, macro_f1, cost: one model for each development split, scored on its own test part (dev) and on rows after all of them (forward)."""
    out = []
    for arm, parted in arms_.items():
        model = fit(pipeline(features, label, kind), parted.where("split = 'train'"))
        for part, rows in (("dev", parted.where("split = 'test'")), ("forward", ahead)):
            scored = score(model, rows, label)
            macro = E.per_class(scored, label, "predicted_label", zero=True).where("label = 'MACRO'").first()
            out.append({"arm": arm, "part": part, "macro_f1": float(macro["f1"] or 0.0), "cost": float(cost(scored, label, severity))})
    return out


#: Differences that count in a verdict: a development score this far above the forward one, and what one arm must be better by.
INFLATED, BETTER_F1, BETTER_COST = 0.02, 0.005, 0.5


def holdout_verdict(scores: list[dict], candidate: str, fallback: str) -> dict:
    """inflated (the candidate's development score overstates its forward one) and keep: which arm to develop with.

    The candidate must be better forward in macro F1 and in cost; otherwise the fallback is kept,
    by right if it is better in either, else as a tie.
    """
    at = {(s["arm"], s["part"]): s for s in scores}
    own, new, old = at[candidate, "dev"], at[candidate, "forward"], at[fallback, "forward"]
    better = lambda a, b: (a["macro_f1"] > b["macro_f1"] + BETTER_F1, a["cost"] < b["cost"] - BETTER_COST)
    keep = candidate if all(better(new, old)) else fallback
    return {"inflated": own["macro_f1"] - new["macro_f1"] > INFLATED, "keep": keep, "tied": keep == fallback and not any(better(old, new))}


def shuffled(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """df with its labels dealt anew: the label of the row that has the same place in another order."""
    from tidemark.operators.splits import hash_rank
    from tidemark.sources.readers import row_ids

    a = row_ids(df.drop(label), [id_col], "_place")
    b = row_ids(df.select(F.col(label), F.col(id_col).alias("_id"), hash_rank(F.col(id_col), seed).alias("_h")), ["_h", "_id"], "_place").select("_place", label)
    return a.join(b, "_place").drop("_place")
