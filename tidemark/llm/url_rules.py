"""URL rules by a sort-merge range join, with DataFrame functions only.

A host with its labels reversed is a key whose prefixes are its parent domains, so a rule's host
covers an interval of keys, and such intervals nest. Rules and pages are sorted together by key; a
sweep down the sorted rows keeps a stack with the last rule host opened at each depth. An entry is
popped when the row's key has left its interval, that is, when the entry isn't a prefix of the key.
A host that holds the character which ends the key's labels could stand in an interval that isn't
its own, so an entry's host is compared with the page's before its rules count.
The path prefixes of the hosts still on the stack decide, the longest rule first.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import local_table, shuffle_partitions

#: (verdict, host, path prefix without its first slash)
RULES = (("allow", "org", ""), ("block", "example.org", "es/"), ("block", "example.org", "en/1"), ("allow", "com", "fr/"), ("block", "com", "de/"))
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def host_key(host: Column) -> Column:
    """The labels reversed, each with an end that sorts before all others, so that a domain's interval is its prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\u0001"), F.lit("\u0001"))


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT, url_col: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The `keep` columns, host, path, rule (host/path; null without one) and verdict for every row of pages.

    A rule fits its host and all subdomains if the path starts with its own. The longest wins: the
    longest host, then the longest path; of equal rules a block wins. The rules are an argument, so
    they are small; each part of the pages sweeps past all of them. Pages are dealt to parts by
    hash, never by host, so one host may hold any share of them. Null urls have empty host and path.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col).cast("string"))
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule_host, rule_path in rules:
        by_host.setdefault(rule_host, []).append(("/" + rule_path, f"{rule_host}/{rule_path}", verdict))
    nested = [(h, h.count(".") + 1, sorted(set(r), key=lambda x: (-len(x[0]), x[0], x[2] != "block"))) for h, r in by_host.items()]
    depth = max((d for _, d, _ in nested), default=0)
    found = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    named = [*keep, "host", "path"]
    dealt = pages.select(*keep, host.alias("host"), path.alias("path"))
    if not nested:
        return dealt.select(*named, found["rule"].alias("rule"), found["verdict"].alias("verdict"))
    parts = 2 * shuffle_partitions(spark)
    dealt = dealt.withColumns({"_part": F.pmod(F.xxhash64(*keep, "host", "path"), F.lit(parts)).cast("int"), "_key": host_key(F.col("host")), "_depth": F.lit(0), "_paths": F.lit(None).cast("array<struct<path:string,rule:string,verdict:string>>")})
    path = pa.struct([(c, pa.string()) for c in ("path", "rule", "verdict")])
    opened = local_table(spark, [(h, d, [dict(zip(("path", "rule", "verdict"), x, strict=True)) for x in r]) for h, d, r in nested], host=pa.string(), _depth=pa.int32(), _paths=pa.list_(path))
    opened = opened.withColumns({"_key": host_key(F.col("host")), "_part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))})
    rows = dealt.unionByName(opened, allowMissingColumns=True)
    sweep = W.partitionBy("_part").orderBy("_key", F.desc("_depth")).rowsBetween(W.unboundedPreceding, W.currentRow)
    entry = F.struct(F.col("_key").alias("key"), F.col("host").alias("host"), F.col("_paths").alias("paths"))
    stack = {f"_open{d}": F.last(F.when(F.col("_depth") == d, entry), ignorenulls=True).over(sweep) for d in range(1, depth + 1)}
    swept = rows.withColumns(stack).where("_depth = 0")
    hits = []
    for d in range(depth, 0, -1):
        top = F.col(f"_open{d}")
        fits = F.filter(top["paths"], lambda x: F.startswith(F.col("path"), x["path"]))
        own = F.startswith(F.col("_key"), top["key"]) & ((F.col("host") == top["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), top["host"])))
        hits.append(F.when(own & (F.size(fits) > 0), F.struct(fits[0]["rule"].alias("rule"), fits[0]["verdict"].alias("verdict"))))
    found = F.coalesce(*hits, found)
    return swept.withColumn("_found", found).select(*named, F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM u),
r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.k = 1
"""
