"""Choosing, naming and matching columns and rows; plans are made from names, so nothing is read for them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.functions.timebars import minute_of_day

CALENDAR = ("year", "month", "quarter", "week", "day", "dayofweek", "date", "time", "session")  # fixed values


def keep_columns(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns in df's order, and those it lacks; refuses to keep none."""
    kept = [c for c in df.columns if c in set(wanted)]
    if not kept:
        raise ValueError("none of the wanted columns is there")
    return df.select(*kept), [c for c in wanted if c not in df.columns]


def prefixed(df: DataFrame, source: str, fixed: list[str], known: list[str] = []) -> DataFrame:  # noqa: B006
    """source__column for all but the fixed columns and those that carry a known source already."""
    done = tuple(f"{s}__" for s in [source, *known])
    return df.select(*(F.col(c) if c in fixed or c.startswith(done) else F.col(c).alias(f"{source}__{c}") for c in df.columns))


def bare_name(column: str, sources: list[str]) -> str:
    """The column without its source, the longest known source first, with __ or _ between."""
    for s in sorted(sources, key=len, reverse=True):
        for gap in ("__", "_"):
            if column.startswith(s + gap):
                return column[len(s + gap) :]
    return column


def bare_names(names: DataFrame, sources: DataFrame, name: str, source: str) -> DataFrame:
    """name, bare: bare_name of every distinct name, joined by each head of it that an underscore ends."""
    heads = names.select(F.col(name).alias("name")).distinct().withColumn("at", F.explode_outer(F.expr("filter(sequence(1, length(name)), p -> substr(name, p, 1) = '_')")))
    known = sources.select(F.col(source).alias("head")).distinct()
    met = heads.withColumn("head", F.expr("substr(name, 1, at - 1)")).join(known.withColumn("known", F.lit(True)), "head", "left")
    last = met.groupBy("name").agg(F.max(F.when(F.col("known"), F.col("at"))).alias("at"))
    return last.select("name", F.expr("case when at is null then name when substr(name, at, 2) = '__' then substr(name, at + 2) else substr(name, at + 1) end").alias("bare"))


def resolve_drops(columns: list[str], drops: list[str]) -> tuple[list[str], list[str]]:
    """Full names of columns to drop, bare or prefixed, and those that aren't there; refuses a name that fits several."""
    found, missing = [], []
    for name in drops:
        hits = [c for c in columns if c == name] or [c for c in columns if c.endswith(f"__{name}")]
        if len(hits) > 1:
            raise ValueError(f"{name} fits {', '.join(hits)}")
        (found if hits else missing).append(hits[0] if hits else name)
    return found, missing


def next_minor(version: str) -> str:
    """v2.9 to v2.10; v3 to v3.1."""
    major, _, minor = version.lstrip("v").partition(".")
    return f"v{major}.{int(minor or 0) + 1}"


def without_calendar(df: DataFrame, keep: list[str]) -> DataFrame:
    """df without calendar columns, bare or prefixed, and times, but for `keep`."""
    drop = [f.name for f in df.schema.fields if f.name not in keep and (f.name.lower().split("__")[-1] in CALENDAR or isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)))]
    return df.drop(*drop)


def between_times(df: DataFrame, low=None, high=None, ts: str = "ts") -> DataFrame:
    """Inclusive; an open end is None."""
    tests = [F.col(ts) >= F.lit(low)] * (low is not None) + [F.col(ts) <= F.lit(high)] * (high is not None)
    return df.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def within_day(df: DataFrame, low: int, high: int, ts: str = "ts") -> DataFrame:
    """Minutes of the day from low to high."""
    return df.where(minute_of_day(F.col(ts)).between(low, high))


def last_sessions(df: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """Rows of the n latest days that occur (not the last n calendar days)."""
    days = df.select(F.to_date(ts).alias("_day")).distinct().orderBy(F.desc("_day")).limit(n)
    return df.join(F.broadcast(days.agg(F.min("_day").alias("_from"))), F.to_date(ts) >= F.col("_from")).drop("_from")  # one row


def without_classes(df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    return df.where(~F.col(label).isin(*classes))


def clip_to_common_span(spine: DataFrame, sources: list[DataFrame], ts: str = "ts") -> DataFrame:
    """Spine rows that every source's span covers."""
    spans = [s.agg(F.min(ts).alias(f"_lo{i}"), F.max(ts).alias(f"_hi{i}")) for i, s in enumerate(sources)]
    joined = reduce(lambda a, b: a.crossJoin(b), spans)  # one row each
    n = range(len(sources))
    low = F.greatest(*(f"_lo{i}" for i in n)) if len(sources) > 1 else F.col("_lo0")
    high = F.least(*(f"_hi{i}" for i in n)) if len(sources) > 1 else F.col("_hi0")
    return spine.crossJoin(joined).where(F.col(ts).between(low, high)).select(*spine.columns)


def search_columns(catalog: DataFrame, terms: str, name: str = "column") -> DataFrame:
    """Catalog rows whose name holds every term, whatever the case."""
    tests = [F.contains(F.lower(name), F.lit(t.lower())) for t in terms.split()]
    return catalog.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def rename_plan(have: list[str], want: list[str]) -> tuple[dict[str, str], list[str], list[str]]:
    """New names for a file's columns, by the longest common end after a __; what fits several; what is still missing."""
    missing = [w for w in want if w not in have]
    free = [h for h in have if h not in want]
    ends = lambda c: {c.split("__", k)[-1] for k in range(c.count("__") + 1)}
    plan, unsure = {}, []
    for w in missing:
        fits = sorted(((len(max(common, key=len)), h) for h in free if (common := ends(h) & ends(w))), reverse=True)
        best = [h for n, h in fits if n == fits[0][0]] if fits else []
        if len(best) == 1 and best[0] not in plan:
            plan[best[0]] = w
        elif best:
            unsure.append(w)
    return plan, unsure, [w for w in missing if w not in plan.values() and w not in unsure]


def detect_roles(names: list[str], aliases: dict[str, list[str]]) -> dict[str, str]:
    """Role to column: an alias as the whole name, then as a word of it, then (if of over three letters) within it; each column once."""
    found: dict[str, str] = {}
    tests = (lambda n, a: n == a, lambda n, a: a in re.split(r"[^a-z0-9]+", n), lambda n, a: len(a) > 3 and a in n)
    for role, own in aliases.items():
        for test in tests:
            hit = next((n for a in own for n in names if n not in found.values() and test(n.lower(), a)), None)
            if hit:
                found[role] = hit
                break
    return found


# What files call the columns of each role, the likeliest name first, and words that mark a measure of a prediction.
ROLE_NAMES = {
    "timestamp": ("timestamp", "datetime", "date_time", "time", "bar_time", "candle_time", "date", "dt", "ts", "index"),
    "open_interest": ("open_interest", "oi", "openinterest"),
    "open": ("open", "open_price", "o", "op"),
    "high": ("high", "high_price", "h", "hi"),
    "low": ("low", "low_price", "l", "lo"),
    "close": ("close", "close_price", "adj_close", "last_price", "last", "ltp", "c"),
    "volume": ("volume", "vol", "traded_volume", "qty", "quantity", "v"),
    "predicted": ("predicted_label", "predicted", "prediction", "pred_label", "pred", "y_pred", "yhat", "y_hat", "model_label", "model_output", "forecast"),
    "target": ("target_label", "target", "true_label", "actual_label", "ground_truth", "label", "actual", "y_true", "ytrue", "y"),
}
MEASURE_WORDS = ("confidence", "conf", "proba", "probability", "prob", "score", "logit", "pct", "percent", "margin")
LEAST_PART, MOST_CLASSES, MOSTLY = 3, 32, 0.8


def _words(name: str) -> str:
    return "_" + re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_") + "_"


def named_like(columns: list[str], aliases: tuple[str, ...], taken: list[str]) -> list[str]:
    """Columns that an alias fits, the best first: as the whole name, then as words of it, then (from LEAST_PART letters on) as a part."""
    free = [(c, _words(c)) for c in columns if c not in taken]
    single = lambda a, w: a in w.strip("_").split("_")
    tests = (lambda a, w: w == f"_{a}_", single, lambda a, w: len(a) >= LEAST_PART and a in w)
    return list(dict.fromkeys(c for fits in tests for a in aliases for c, w in free if fits(a, w)))


def detect_schema(df: DataFrame) -> dict[str, str]:
    """Role to column, by names and then by values: timestamp, prices, volume, predicted and target labels.

    Open interest is claimed before prices, so that it is never an opening price, and predictions
    before targets. Labels are no measures of a prediction: not so named, and no fractions of more
    than MOST_CLASSES values. Without a name that says so, the first text or time column that
    mostly reads as a time is the timestamp. Values are looked at only in columns that it depends on,
    in one aggregation for each question.
    """
    kinds, found = dict(df.dtypes), {}

    def claim(role: str, columns: list[str]) -> None:
        fits = named_like(columns, ROLE_NAMES[role], list(found.values()))
        if fits:
            found[role] = fits[0]

    for role in ("timestamp", "open_interest", "open", "high", "low", "close", "volume"):
        claim(role, df.columns)
    if "timestamp" not in found:
        texts = [c for c, k in df.dtypes if k == "string"]
        shares = df.select(*(F.avg(F.try_to_timestamp(c).isNotNull().cast("int")).alias(c) for c in texts)).first() if texts else {}
        times = [c for c, k in df.dtypes if k.startswith(("timestamp", "date")) or (k == "string" and (shares[c] or 0) > MOSTLY)]
        if times:
            found["timestamp"] = times[0]
    prices = {r: c for r, c in found.items() if r != "timestamp"}
    labels = [c for c in df.columns if not set(_words(c).strip("_").split("_")) & set(MEASURE_WORDS)]
    asked = {c for role in ("predicted", "target") for c in named_like(labels, ROLE_NAMES[role], []) if kinds[c] in ("double", "float")}
    if asked:
        counts = df.agg(*(F.count_distinct(c).alias(c) for c in sorted(asked))).first()
        labels = [c for c in labels if c not in asked or counts[c] <= MOST_CLASSES]
    found = {r: c for r, c in found.items() if r == "timestamp"}  # a label may have a price's name
    for role in ("predicted", "target"):
        claim(role, labels)
    return prices | found


def label_candidates(df: DataFrame, reserved: list[str], most: int = 32) -> list[str]:
    """Columns that may be labels: not reserved, not fractions, and of at most `most` values (one aggregation)."""
    names = [f.name for f in df.schema.fields if f.name not in reserved and not isinstance(f.dataType, (T.DoubleType, T.FloatType, T.ArrayType))]
    counts = df.agg(*(F.count_distinct(c).alias(c) for c in names)).first() if names else {}
    return [c for c in names if counts[c] <= most]


def first_by_source(catalog: DataFrame, order: list[str] | DataFrame, name: str = "column", source: str = "source") -> DataFrame:
    """One row for each column name, of the source that comes first in order; sources that the order lacks come last, by name.

    order: names, or a table (source, place) where they are many.
    """
    if isinstance(order, list):
        place = F.array_position(F.array(*map(F.lit, order)), F.col(source))
        placed = catalog.withColumn("_place", F.when(place > 0, place))
    else:
        placed = catalog.join(order.select(F.col("source").alias(source), F.col("place").alias("_place")), source, "left")
    rest = [c for c in catalog.columns if c != name]
    first = F.min_by(F.struct(*rest), F.struct(F.col("_place").isNull(), "_place", source)).alias("_first")
    return placed.groupBy(name).agg(first).select(name, "_first.*").select(*catalog.columns)


def schema_changes(now: list[tuple[str, str]], frozen: list[tuple[str, str]]) -> dict[str, list[str]]:
    """Added, removed and retyped columns and whether the order moved; text types count as one."""
    text = lambda t: "text" if t in ("string", "varchar", "char", "boolean") else t
    a, b = {n: text(t) for n, t in now}, {n: text(t) for n, t in frozen}
    return {"added": [n for n in a if n not in b], "removed": [n for n in b if n not in a], "retyped": [n for n in a if n in b and a[n] != b[n]], "moved": ["order"] if [n for n, _ in now if n in b] != [n for n, _ in frozen if n in a] else []}
