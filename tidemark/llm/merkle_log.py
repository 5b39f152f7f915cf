"""A Merkle manifest of a dataset, kept as append logs in postorder.

Rows are leaves of one tree for each source, FAN children to a node; the sources' roots are leaves
of one tree above them. A builder takes an aligned block of BLOCK leaves, so that all nodes over
them but the last are its own, and appends each node the moment its last child is there: its log
is the block's tree in postorder. The blocks' roots are the next builders' leaves, and so on, until
a tree has one block. In such a log a node's place follows from sizes alone (`position`): whatever
lies before its first leaf is complete, and its own subtree ends with it. Proofs are taken from the
top down: a block's proof is its own place in the builder above and that builder's proof, so that
no builder is asked for by more than BLOCK others, however large its source is.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, shuffle_partitions, table

FAN, LEVELS = 16, 2
BLOCK = FAN**LEVELS  # leaves of a builder
DIGEST = 32  # bytes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def node(children: bytes) -> bytes:
    """The digest over children's digests, which it takes as hex text."""
    return sha256(children.hex().encode()).digest()


def levels_over(n: int) -> int:
    """Levels that a builder has over its leaves in a tree of n: as many as the tree has, LEVELS at most."""
    return next((k for k in range(LEVELS) if FAN**k >= n), LEVELS)


def position(level: int, index: int, m: int) -> int:
    """Where the index-th node of a level (0: leaves) stands in the log of a builder with m leaves, in closed form.

    It stands at the end of its own subtree, after all nodes that were complete at its first leaf.
    """
    first = index * FAN**level
    own = min(FAN**level, m - first)
    return sum(first // FAN**k for k in range(LEVELS + 1)) + sum(-(-own // FAN**k) for k in range(level + 1)) - 1


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """The nodes of a block in the order in which they are complete; the last one is its root."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(level: int, digest: bytes) -> None:
        log.append(digest)
        waiting[level].append(digest)
        if level < levels and len(waiting[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        run, waiting[level] = b"".join(waiting[level]), []
        add(level + 1, node(run))

    for leaf in leaves:
        add(0, leaf)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return b"".join(log)


def siblings(log: bytes, m: int, levels: int, index: int) -> list[tuple[bytes, bytes]]:
    """For each level the digests left and right of the path from a leaf to the block's root."""
    path = []
    for level in range(levels):
        at = index // FAN**level
        run = range(at // FAN * FAN, min(at // FAN * FAN + FAN, -(-m // FAN**level)))
        found = [log[p * DIGEST : (p + 1) * DIGEST] for p in (position(level, k, m) for k in run)]
        path.append((b"".join(found[: at % FAN]), b"".join(found[at % FAN + 1 :])))
    return path


# --- building ------------------------------------------------------------------------------------

_LOG = "tree long, block long, n long, m int, log binary, top binary"
_LOG_TYPES = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("m", pa.int32()), ("log", pa.binary()), ("top", pa.binary())])


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of leaves, which come in order and each block to one task."""
    key, leaves = None, []

    def done(rows: list[tuple]) -> None:
        if leaves:
            tree, block, n = key
            log = append_log(leaves, levels_over(n))
            rows.append((tree, block, n, len(leaves), log, log[-DIGEST:]))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _LOG_TYPES.types, strict=True)], schema=_LOG_TYPES)

    for batch in batches:
        rows: list[tuple] = []
        for tree, index, n, digest in zip(*(batch.column(c).to_pylist() for c in ("tree", "index", "n", "digest")), strict=True):
            if (now := (tree, index // BLOCK, n)) != key:
                done(rows)
                key, leaves = now, []
            leaves.append(digest)
        if rows:
            yield packed(rows)
    rows = []
    done(rows)
    if rows:
        yield packed(rows)


def _ordered(df: DataFrame, scratch: Scratch, name: str, group: list[Column], order: list[Column]) -> DataFrame:
    """df written in the order of (group, order), with _part and _at (a row's place in its part).

    Equal rows are told apart by where they were read, so that no number of them must stay together.
    """
    parts = shuffle_partitions(df.sparkSession)
    tie = F.xxhash64(F.monotonically_increasing_id())
    by = [*group, *order, F.col("_tie")]
    dealt = df.withColumn("_tie", tie).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
    placed = dealt.withColumn("_id", F.monotonically_increasing_id())  # the part's number, then 33 bits for the row
    placed = placed.select(*df.columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))
    return scratch.save(placed, name)


def build(leaves: DataFrame, scratch: Scratch, name: str, most: int) -> list[DataFrame]:
    """The logs of trees whose leaves are given as tree, index, n (the tree's leaves), digest; most: the largest n.

    Round by round: tree, block, n, m (the builder's leaves), log (digests in postorder), top (the
    last of them). A tree ends in the round in which n <= BLOCK.
    """
    parts, logs = shuffle_partitions(leaves.sparkSession), []
    while True:
        dealt = leaves.withColumn("_block", F.floor(F.col("index") / BLOCK)).repartition(parts, "tree", "_block").sortWithinPartitions("tree", "index")
        logs.append(scratch.save(dealt.select("tree", "index", "n", "digest").mapInArrow(_built, _LOG), f"{name}-{len(logs)}"))
        if most <= BLOCK:
            return logs
        most = -(-most // BLOCK)
        leaves = logs[-1].where(F.col("n") > BLOCK).select("tree", F.col("block").alias("index"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest"))


def tops(logs: list[DataFrame]) -> DataFrame:
    """tree, digest: the root of each tree."""
    ended = [log.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("digest")) for log in logs]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


# --- proofs --------------------------------------------------------------------------------------

_PATH = "tree long, index long, lefts array<binary>, rights array<binary>, roots array<binary>"
_PATH_TYPES = pa.schema([("tree", pa.int64()), ("index", pa.int64()), ("lefts", pa.list_(pa.binary())), ("rights", pa.list_(pa.binary())), ("roots", pa.list_(pa.binary()))])


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of a builder: its siblings there, and those of the builder itself."""
    columns = ("tree", "block", "n", "m", "log", "lefts", "rights", "roots")
    for batch in batches:
        for tree, block, n, m, log, lefts, rights, roots in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            paths = [siblings(log, m, levels_over(n), k) for k in range(m)]
            rows = ([tree] * m, [block * BLOCK + k for k in range(m)], [[x for x, _ in p] + lefts for p in paths], [[x for _, x in p] + rights for p in paths], [roots] * m)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _PATH_TYPES.types, strict=True)], schema=_PATH_TYPES)


def block_paths(logs: list[DataFrame], above: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The first round's builders, each with lefts and rights (siblings from its root upwards) and roots.

    above: tree, lefts, rights, roots of each tree's root. Rounds are walked from the last to the
    first; a builder's leaves take its path, and those of them that are builders join it by place.
    """
    paths = None
    for k in range(len(logs) - 1, -1, -1):
        log = logs[k]
        here = log.where(F.col("n") <= BLOCK).join(above, "tree")
        if paths is not None:
            below = log.where(F.col("n") > BLOCK).join(paths.withColumnRenamed("index", "block"), ["tree", "block"])
            here = here.unionByName(below)
        if k == 0:
            return here
        paths = scratch.save(here.mapInArrow(_expanded, _PATH), f"{name}-{k}")
    raise ValueError("no logs")


_FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def fold(digest: bytes, lefts: list[bytes], rights: list[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights, strict=True):
        digest = node(left + digest + right)
    return digest


def _proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents' proofs; a block's log comes before its documents."""
    columns = ("log", "n", "m", "lefts", "rights", "roots", "index", "doc_id", "leaf", "tampered")
    block: tuple = ()
    for batch in batches:
        out: list[tuple] = []
        for log, n, m, lefts, rights, roots, index, doc_id, leaf, tampered in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if log is not None:
                block = (log, m, levels_over(n), lefts, rights, roots)
                continue
            log, m, levels, lefts, rights, roots = block
            own = siblings(log, m, levels, index % BLOCK)
            lefts, rights = [x for x, _ in own] + lefts, [x for _, x in own] + rights
            proof = b"".join(x + y for x, y in zip(lefts, rights, strict=True))
            folded = fold(leaf if tampered is None else tampered, lefts, rights)
            out.append((doc_id, leaf.hex(), roots[0].hex(), roots[1].hex(), node(proof).hex(), folded.hex()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k else pa.int64()) for k, c in enumerate(zip(*out, strict=True))], names=[c.split()[0] for c in _FOLDED.split(", ")])


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 over fields, each - if null, else its UTF-8 byte count, a colon and itself."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*said), 256))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def manifest(docs: DataFrame, scratch: Scratch, fields: tuple[str, ...] = FIELDS, tampered: Column | None = None, every: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs.

    fields: the columns of a leaf, the first an integer id that orders a source's leaves, the second
    its source, the last a text. Null ids come first, null sources before all others. Rows that
    share an id are ordered by their leaves, equal rows are leaves of their own. Where `every`
    divides the CRC-32 of the id as text, the leaf is taken again from `tampered` instead of the
    text (default: A-Z lower-cased; null stays), and folded with the siblings of the first; a null
    id has no CRC and stays. Without siblings the proof is the digest of nothing. Nothing is
    gathered but the numbers of sources and of the largest source's leaves; an empty table gives
    none. Further columns are not read.
    """
    spark = docs.sparkSession
    columns = [F.col(c) for c in fields]
    doc_id, source, text = columns[0].cast("long"), columns[1].cast("string"), columns[-1].cast("string")
    changed = F.translate(text, _UPPER, _LOWER) if tampered is None else tampered
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % every == 0
    again = F.when(chosen, leaf_digest(*columns[:-1], changed))
    rows = docs.select(doc_id.alias("doc_id"), source.alias("source"), leaf_digest(*columns).alias("leaf"), again.alias("tampered"))
    rows = _ordered(rows, scratch, "leaves", [F.col("source").asc_nulls_first()], [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    # A source's rows in one part are a run; the runs before it give its first leaf's place.
    runs = scratch.save(rows.groupBy("source", "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n")), "runs")
    sources = _ordered(runs.groupBy("source").agg(F.sum("_n").alias("n")), scratch, "sources", [F.col("source").asc_nulls_first()], [])
    firsts = sources.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each part
    upto = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    trees = sources.join(firsts.select("_part", upto.alias("_upto")), "_part").select(F.col("source").alias("_source"), "n", (F.col("_upto") + F.col("_at")).alias("tree"))
    trees = scratch.save(trees, "trees")
    size = trees.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("trees")).first()
    if not size["trees"]:
        return spark.createDataFrame([], f"{_FOLDED}, verified boolean")
    before = F.coalesce(F.sum("_n").over(W.partitionBy("tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.join(trees, F.col("source").eqNullSafe(F.col("_source"))).select("source", "_part", "tree", "n", (before - F.col("_from")).alias("_shift"))
    runs = scratch.save(runs.toDF("_of", "_in", "tree", "n", "_shift"), "shifts")
    placed = rows.join(runs, (F.col("_part") == F.col("_in")) & F.col("source").eqNullSafe(F.col("_of")))
    placed = placed.select("tree", (F.col("_at") + F.col("_shift")).alias("index"), "n", "doc_id", "leaf", "tampered")
    logs = build(placed.select("tree", "index", "n", F.col("leaf").alias("digest")), scratch, "log", size["most"])
    subroots = tops(logs)
    over = build(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(size["trees"]).cast("long").alias("n"), "digest"), scratch, "over", size["trees"])
    none = F.array().cast("array<binary>")
    above = tops(over).select("tree", none.alias("lefts"), none.alias("rights"), F.array("digest").alias("roots"))
    of_sources = block_paths(over, above, scratch, "over-paths").mapInArrow(_expanded, _PATH)
    above = of_sources.select(F.col("index").alias("tree"), "lefts", "rights", "roots").join(subroots, "tree")
    above = scratch.save(above.select("tree", "lefts", "rights", F.concat(F.array("digest"), "roots").alias("roots")), "source-paths")
    blocks = block_paths(logs, above, scratch, "paths").drop("top")
    both = blocks.unionByName(placed.drop("n").withColumn("block", F.floor(F.col("index") / BLOCK)), allowMissingColumns=True)
    both = both.repartition(shuffle_partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", F.col("index").asc_nulls_first())
    return both.mapInArrow(_proven, _FOLDED).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, a fifth of them tampered with."""
    return manifest(table(spark, sf_dir, "documents", *FIELDS), Scratch(spark, "merkle-log"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         -- CRC-32, bit by bit
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda b: ((ascii(c) >> b) & 1)::BIGINT)))),
           lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) AS crc
  FROM documents),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM l),
nodes AS (
  SELECT source, 0 AS level, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY source, level, n, idx // 16),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, (SELECT max(level) FROM nodes x WHERE x.source IS NOT DISTINCT FROM nodes.source) AS height
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos AS idx, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, n, idx // 16),
runs AS (
  SELECT source, level, idx // 16 AS run, list(digest ORDER BY idx) AS digests FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16),
topruns AS (
  SELECT level, idx // 16 AS run, list(digest ORDER BY idx) AS digests FROM tops WHERE n > 1 GROUP BY level, idx // 16),
topheight AS (SELECT max(level) AS h FROM tops),
steps AS (
  SELECT a.source, a.idx AS leaf_idx, k.level, (a.idx // CAST(16 ** k.level AS BIGINT)) % 16 AS place, r.digests
  FROM leaves a JOIN (SELECT DISTINCT source, level FROM runs) k ON a.source IS NOT DISTINCT FROM k.source
  JOIN runs r ON r.source IS NOT DISTINCT FROM a.source AND r.level = k.level AND r.run = a.idx // CAST(16 ** (k.level + 1) AS BIGINT)
  UNION ALL
  SELECT a.source, a.idx, s.height + r.level, (s.pos // CAST(16 ** r.level AS BIGINT)) % 16, r.digests
  FROM leaves a JOIN subroots s ON a.source IS NOT DISTINCT FROM s.source JOIN topruns r ON r.run = s.pos // CAST(16 ** (r.level + 1) AS BIGINT)),
cut AS (
  SELECT source, leaf_idx, level, array_to_string(digests[1:place], '') AS lefts, array_to_string(digests[place + 2:], '') AS rights FROM steps),
proofs AS (
  SELECT source, leaf_idx, string_agg(lefts || rights, '' ORDER BY level) AS proof FROM cut GROUP BY source, leaf_idx),
folded AS (
  SELECT source, idx, 0 AS level, coalesce(tampered, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.source, f.idx, f.level + 1, sha256(c.lefts || f.digest || c.rights)
  FROM folded f JOIN cut c ON c.source IS NOT DISTINCT FROM f.source AND c.leaf_idx = f.idx AND c.level = f.level),
last AS (SELECT source, idx, arg_max(digest, level) AS folded_root FROM folded GROUP BY source, idx)
SELECT a.doc_id, a.leaf, s.subroot, t.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root, f.folded_root = t.digest AS verified
FROM leaves a JOIN subroots s ON a.source IS NOT DISTINCT FROM s.source JOIN tops t ON t.n = 1
JOIN last f ON f.source IS NOT DISTINCT FROM a.source AND f.idx = a.idx
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM a.source AND p.leaf_idx = a.idx
"""
