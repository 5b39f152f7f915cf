"""Catalogs, manifests and comparisons of datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.operators import clocks as C
from tidemark.operators import quality as Q

REQUIRED = ("version", "rows", "n_features", "schema", "feature_columns", "class_distribution", "no_peek", "status", "fingerprint")  # fixed values


def column_diff(columns: DataFrame, a: str, b: str) -> DataFrame:
    """(column, change): added, removed or kept between two versions of (version, column)."""
    old, new = (columns.where(F.col("version") == v).select("column").distinct().withColumn(f"_{k}", F.lit(1)) for k, v in (("a", a), ("b", b)))
    return old.join(new, "column", "full").select("column", F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("kept").alias("change"))


def difference_matrix(columns: DataFrame, versions: list[str]) -> DataFrame:
    """A row for each column that not all versions have, with 1 or 0 for each version."""
    wide = columns.distinct().groupBy("column").pivot("version", versions).agg(F.count(F.lit(1)))
    filled = wide.na.fill(0)
    return filled.where(sum((F.col(f"`{v}`") for v in versions), F.lit(0)) < len(versions))


def derive_selections(columns: DataFrame, plan: DataFrame) -> DataFrame:
    """(version, column) of each plan row (version, parent, drops, adds): the parent's columns without drops, with adds."""
    kept = plan.join(columns.withColumnRenamed("version", "parent"), "parent").where(~F.array_contains("drops", F.col("column"))).select("version", "column")
    return kept.union(plan.select("version", F.explode("adds").alias("column"))).distinct()


def selection(catalog: DataFrame, groups: list[str] = [], names: list[str] = []) -> DataFrame:  # noqa: B006
    """Sources by group or name, all if neither is given; refuses what the catalog lacks."""
    if not groups and not names:
        return catalog
    known = {(k, r[c]) for k, c, asked in (("g", "group", groups), ("n", "name", names)) if asked for r in catalog.where(F.col(c).isin(*asked)).select(c).distinct().collect()}  # of what is asked for only
    lost = [x for k, xs in (("g", groups), ("n", names)) for x in xs if (k, x) not in known]
    if lost:
        raise ValueError(f"not in the catalog: {', '.join(lost)}")
    return catalog.where(F.col("group").isin(*groups) | F.col("name").isin(*names))


def identical_versions(columns: DataFrame) -> DataFrame:
    """(content, versions): sets of versions with the same columns."""
    content = columns.groupBy("version").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("column")), ","), 256).alias("content"))
    return content.groupBy("content").agg(F.array_sort(F.collect_list("version")).alias("versions")).where(F.size("versions") > 1)


def tagged_union(tables: dict[str, DataFrame], tag: str = "version") -> DataFrame:
    """All rows, each with its table's name; columns that a table lacks are null."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def glue(pieces: list[DataFrame], row_id: str) -> DataFrame:
    """Aligned pieces side by side, by id and never by position."""
    out = pieces[0]
    for p in pieces[1:]:
        out = out.join(p, row_id)
    return out


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, content): the same for the same rows in any order."""
    h = F.xxhash64(*(F.to_json(c) if isinstance(df.schema[c].dataType, (T.MapType,)) else F.col(c) for c in sorted(df.columns)))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h.cast("decimal(20,0)")).cast("string").alias("content"))


def manifest(df: DataFrame, version: str, features: list[str], label: str, no_peek: str) -> DataFrame:
    """One row that certifies df as it is read back."""
    schema = F.array(*(F.struct(F.lit(n).alias("col"), F.lit(t).alias("dtype")) for n, t in df.dtypes))
    classes = df.groupBy(F.coalesce(F.col(label).cast("string"), F.lit("")).alias("c")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("class_distribution"))
    print_ = fingerprint(df)
    return print_.crossJoin(classes).select(F.lit(version).alias("version"), F.col("n_rows").alias("rows"), F.lit(len(features)).alias("n_features"), schema.alias("schema"), F.array(*map(F.lit, features)).alias("feature_columns"), "class_distribution", F.lit(no_peek).alias("no_peek"), F.lit("certified").alias("status"), F.col("content").alias("fingerprint"))


def verify(df: DataFrame, certificate: DataFrame) -> list[str]:
    """What the certificate says that isn't so."""
    lost = [c for c in REQUIRED if c not in certificate.columns]
    if lost:
        return [f"no {', '.join(lost)}"]
    c, now = certificate.first(), fingerprint(df).first()
    tests = {"status": c["status"] == "certified", "rows": c["rows"] == now["n_rows"], "content": c["fingerprint"] == now["content"], "schema": [(x["col"], x["dtype"]) for x in c["schema"]] == df.dtypes, "feature columns": set(c["feature_columns"]) <= set(df.columns), "n_features": c["n_features"] == len(c["feature_columns"]), "no_peek": bool(c["no_peek"])}
    return [name for name, holds in tests.items() if not holds]


def dataset_catalogue(manifests: DataFrame) -> DataFrame:
    """(version, rows, n_features, n_classes, status) of many manifests, newest version first."""
    from tidemark.functions.labels import version_key

    listed = manifests.select("version", "rows", "n_features", F.size("class_distribution").alias("n_classes"), "status")
    return listed.orderBy(version_key(F.col("version")).desc())


def source_rows(df: DataFrame, name: str, keys: list[str], ts: str = "ts") -> DataFrame:
    """One catalog row of a source: rows, span, columns, categorical ones and nulls, in one aggregation."""
    own = [c for c in df.columns if c not in [*keys, ts]]
    text = [f.name for f in df.schema.fields if f.name in own and isinstance(f.dataType, (T.StringType, T.BooleanType))]
    nulls = F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*(F.count(F.when(F.col(c).isNull(), 1)) for c in own)))
    return df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.struct(F.min(ts).alias("min"), F.max(ts).alias("max")).alias("span"), F.array(*map(F.lit, own)).alias("columns"), F.array(*map(F.lit, text)).cast("array<string>").alias("categorical"), nulls.alias("nulls"))


def inspected(df: DataFrame, name: str, keys: list[str], ts: str = "ts", price: str | None = None, order: list[str] | None = None, allow: tuple[str, ...] = (), sources: tuple[str, ...] = ()) -> DataFrame:
    """A source's whole catalog row: name, rows, span, columns, categorical, nulls, banned, suspect, pre_aligned, clock, clocks and unsure.

    Columns that the leak screen bans are on record with their reasons and in nothing else (without
    a price column names alone are judged). A table nine tenths of whose columns carry a source's
    name has been aligned before: its clocks aren't measured. Else clock is the longest of the row
    spacing and all columns' clocks, and unsure are the columns that change too rarely for theirs to
    be more than a guess. Refuses a table of which no column is left.
    """
    own = [c for c in df.columns if c not in [*keys, ts]]
    kinds = dict(df.dtypes)
    if price:
        judged = Q.leak_screen(df, keys, price, [c for c in own if c != price], order or [ts], allow, sources=sources).where("verdict <> 'ok'").collect()  # a row for each column
        found = {r["column"]: (r["verdict"], r["reason"]) for r in judged}
    else:
        found = {c: v for c in own if (v := Q.name_verdict(c, kinds[c], allow, sources))[0] != "ok"}
    banned, suspect = ({c: why for c, (v, why) in found.items() if v == verdict} for verdict in ("banned", "suspect"))
    safe = [c for c in own if c not in banned]
    if not safe:
        raise ValueError(f"every column of {name} was refused")
    as_map = lambda pairs: F.map_from_arrays(*(F.array(*map(F.lit, x)).cast("array<string>") for x in (list(pairs), list(pairs.values()))))
    pre = sum(Q.own_name(c, sources) != c for c in own) >= max(1, int(0.9 * len(own)))
    row = source_rows(df.select(*keys, ts, *safe), name, keys, ts).withColumns({"banned": as_map(banned), "suspect": as_map(suspect), "pre_aligned": F.lit(pre)})
    if pre:
        return row.withColumns({"clock": F.lit(1), "clocks": F.lit(None).cast("map<string,int>"), "unsure": F.lit(None).cast("array<string>")})
    clocks = C.column_clocks(df, keys, safe, ts=ts).agg(F.max("clock").alias("_longest"), F.map_from_entries(F.collect_list(F.struct("column", "clock"))).alias("clocks"))
    unsure = C.clock_report(df, keys, safe, ts).where("not confident").agg(F.array_sort(F.collect_list("column")).alias("unsure"))
    spacing = C.row_spacing(df, keys, ts).agg(F.max("minutes").alias("_spacing"))
    whole = row.crossJoin(clocks).crossJoin(unsure).crossJoin(spacing)  # one row each
    clock = F.greatest(F.ceil(F.coalesce("_spacing", F.lit(1.0))), F.coalesce("_longest", F.lit(1))).cast("int")
    return whole.withColumn("clock", clock).select(*row.columns, "clock", "clocks", "unsure")


def label_change(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    """(label, n_old, n_new, share_old, share_new) of two label sets."""
    def shares(df: DataFrame, tag: str) -> DataFrame:
        n = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias(f"n_{tag}"))
        return n.withColumn(f"share_{tag}", F.round(F.col(f"n_{tag}") / F.sum(f"n_{tag}").over(W.partitionBy()), 6))

    return shares(old, "old").join(shares(new, "new"), "label", "full")
