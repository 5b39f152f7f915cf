"""Token-ID output as a content-addressed store.

Each document's ids are cut into chunks where a rolling hash of the last ids says so, so that equal
passages give equal chunks wherever they stand. Unique chunks are stored once under their digest,
each document has a recipe (its chunks' digests in order), and Merkle roots over recipes let a
reader verify what it puts together.

Files below `path`:
  entries/kind=chunk    digest, payload: ids as little-endian unsigned 16-bit integers (32-bit for large vocabularies)
  entries/kind=recipe   doc_id, n_tokens, digests, ends, as encoded
  recipes               ascending doc_id: shard, pos (place in the shard), doc_id, n_tokens, first (the shard's ids before),
                        digests (16 bytes each, joined), ends (in ids, of each chunk), root, leaf
  manifest              a row for each shard: n_docs, n_tokens, the Merkle root of its documents' leaves, and id_bytes (2 or 4)

A chunk proves itself by its digest, a document's chunks and their ends by its root, its id, place and
sizes by its leaf, and all leaves of a shard by the manifest. Both readers check every one of these.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, shuffle_partitions, slices, table
from tidemark.llm.tokens import encoder

DIGEST = 16  # bytes
WINDOW, LEAST, MOST = 16, 64, 1024  # ids that the rolling hash covers; ids in a chunk
CUT_BITS = 8  # a cut where these many top bits are zero: about 256 ids after LEAST


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary Merkle tree; an odd node moves up as it is; no leaf: the digest of nothing."""
    level = leaves or [_digest(b"")]
    while len(level) > 1:
        paired = [_digest(b"\x01" + a + b) for a, b in zip(level[::2], level[1::2], strict=False)]
        level = paired + level[len(paired) * 2 :]
    return level[0]


@lru_cache(maxsize=1)
def _gear(size: int = 1 << 16) -> np.ndarray:
    """A fixed pseudo-random number for each id (larger ids share them)."""
    x = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


def cut_candidates(ids: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last WINDOW ids has CUT_BITS zero bits on top.

    Each id's number is shifted by its distance, so that older ones drop out; the sum over the
    window is built by doubling. Places nearer than WINDOW to a start are never used, so documents
    can lie one after another in `ids`.
    """
    h = _gear()[ids & 0xFFFF]
    width = 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return np.flatnonzero((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - CUT_BITS) == 0) + 1


def cut_points(n: int, candidates: list[int]) -> list[int]:
    """Ends of the chunks of n ids: candidates LEAST apart, and at most MOST ids in a chunk."""
    ends, last = [], 0
    for at in candidates:
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            ends.append(at)
            last = at
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


_ENTRY = "kind string, digest binary, payload binary, doc_id long, n_tokens long, digests binary, ends array<int>, row long"


def _entries(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(tokenizer), 0
        size = enc.dtype.itemsize
        end, seen = np.array([end_id], dtype=enc.dtype).tobytes(), set()
        schema = pa.schema([("kind", pa.string()), ("digest", pa.binary()), ("payload", pa.binary()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("digests", pa.binary()), ("ends", pa.list_(pa.int32())), ("row", pa.int64())])
        for batch in slices(batches):
            ids_of = [ids + end for ids in enc.encode([t or "" for t in batch.column(1).to_pylist()])]
            firsts = np.cumsum([0, *(len(x) // size for x in ids_of)])
            cuts = cut_candidates(np.frombuffer(b"".join(ids_of), dtype=enc.dtype))
            edges = np.searchsorted(cuts, firsts, "right")
            chunks: tuple[list, list] = ([], [])
            recipes, ends_of = [], []
            for k, data in enumerate(ids_of):
                ends = cut_points(len(data) // size, (cuts[edges[k] : edges[k + 1]] - firsts[k]).tolist())
                at, digests = 0, []
                for to in ends:
                    piece = data[at * size : to * size]
                    digests.append(key := _digest(piece))
                    if key not in seen:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(key)
                        chunks[0].append(key)
                        chunks[1].append(piece)
                    at = to
                recipes.append(b"".join(digests))
                ends_of.append(ends)
            n, m = len(chunks[0]), len(recipes)
            columns = (["chunk"] * n + ["recipe"] * m, chunks[0] + [_digest(x) for x in recipes], chunks[1] + [None] * m, [None] * n + batch.column(0).to_pylist(), [None] * n + np.diff(firsts).tolist(), [None] * n + recipes, [None] * n + ends_of, [None] * n + list(range(row, row + m)))
            row += m
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    return run


_RECIPE = "shard int, pos long, doc_id long, n_tokens long, first long, digests binary, ends array<int>, root binary, leaf binary"


def _root(digests: bytes, ends: list[int]) -> bytes:
    """Merkle root over a document's chunks, each with its end."""
    return merkle_root([b"%s/%d" % (digests[k * DIGEST : (k + 1) * DIGEST], end) for k, end in enumerate(ends)])


def _leaf(pos: int, doc_id: int | None, n: int, first: int, root: bytes) -> bytes:
    return _digest(b"%d/%s/%d/%d/" % (pos, str(doc_id).encode(), n, first) + root)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's recipes, which come in order and all to one task, with their places, roots and leaves."""
    pos = first = 0
    for batch in batches:
        firsts, roots, leaves = [], [], []
        at = range(pos, pos + batch.num_rows)
        for p, doc_id, n, digests, ends in zip(at, *(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "digests", "ends")), strict=True):
            firsts.append(first)
            roots.append(root := _root(digests, ends))
            leaves.append(_leaf(p, doc_id, n, first, root))
            first += n
        pos += batch.num_rows
        new = {"pos": pa.array(at, pa.int64()), "first": pa.array(firsts, pa.int64()), "root": pa.array(roots, pa.binary()), "leaf": pa.array(leaves, pa.binary())}
        named = dict(zip(batch.schema.names, batch.columns, strict=True)) | new
        names = [c.split()[0] for c in _RECIPE.split(", ")]
        yield pa.RecordBatch.from_arrays([named[c] for c in names], names=names)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recipes, whether each gives its own root and leaf."""
    for batch in slices(batches, 4096):
        whole = []
        for pos, doc_id, n, first, digests, ends, root, leaf in zip(*(batch.column(c).to_pylist() for c in ("pos", "doc_id", "n_tokens", "first", "digests", "ends", "root", "leaf")), strict=True):
            whole.append(len(digests) == DIGEST * len(ends) and ends[-1:] == [n] and _root(digests, ends) == root and _leaf(pos, doc_id, n, first, root) == leaf)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(whole, pa.bool_())], names=[*batch.schema.names, "whole"])


def _shard_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of equal shards, whose rows come in order; keeps one node for each level of the tree."""
    schema = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary())])
    shard, n_docs, n_tokens, spine = None, 0, 0, []

    def add(leaf: bytes) -> None:
        height = 0
        while spine and spine[-1][0] == height:
            leaf, height = _digest(b"\x01" + spine.pop()[1] + leaf), height + 1
        spine.append((height, leaf))

    def done() -> pa.RecordBatch:
        root = spine.pop()[1]
        while spine:
            root = _digest(b"\x01" + spine.pop()[1] + root)
        return pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": n_docs, "n_tokens": n_tokens, "root": root}], schema=schema)

    for batch in batches:
        for s, n, leaf in zip(*(batch.column(c).to_pylist() for c in ("shard", "n_tokens", "leaf")), strict=True):
            if s != shard and shard is not None:
                yield done()
                n_docs, n_tokens, spine = 0, 0, []
            shard, n_docs, n_tokens = s, n_docs + 1, n_tokens + n
            add(leaf)
    if shard is not None:
        yield done()


def _manifest(recipes: DataFrame) -> DataFrame:
    """shard, n_docs, n_tokens, root of every shard, from its leaves."""
    leaves = recipes.select("shard", "pos", "n_tokens", "leaf").repartition(shuffle_partitions(recipes.sparkSession), "shard").sortWithinPartitions("shard", "pos")
    return leaves.mapInArrow(_shard_roots, "shard int, n_docs long, n_tokens long, root binary")


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text whole, append end_id, and write the store's files below path.

    Null and empty texts have the end id alone. Repeated doc_ids keep a recipe each; a null doc_id
    sorts first. Further columns are not read. An empty table gives empty files.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    entries = source.mapInArrow(_entries(tokenizer, end_id), _ENTRY)
    # Chunks meet by digest; as each map task has kept one of each, they are dealt at once and sorted only where they meet. A recipe is alone under its key.
    kept = ("payload", "n_tokens", "digests", "ends")
    unique = entries.repartition(parts, "digest").groupBy("kind", "digest", "row", "doc_id").agg(*(F.first(c).alias(c) for c in kept), F.count(F.lit(1)).alias("copies"))
    unique.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/entries")
    recipes = spark.read.schema(f"{_ENTRY}, copies long").parquet(f"{path}/entries").where("kind = 'recipe'")
    # Tasks count rows on their own: equal rows of two tasks are one document repeated, and stay as many.
    recipes = recipes.select("doc_id", "n_tokens", "digests", "ends", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    ordered = recipes.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "digests")
    placed = ordered.withColumn("shard", F.spark_partition_id()).mapInArrow(_placed, _RECIPE)
    placed.write.option("compression", "zstd").parquet(f"{path}/recipes")
    listed = _manifest(_recipes(spark, path)).withColumn("id_bytes", F.lit(encoder(tokenizer).dtype.itemsize))
    listed.write.parquet(f"{path}/manifest")


# --- reading -------------------------------------------------------------------------------------

_POLY = 0xEDB88320


def _times_x(bits: int, n: int) -> int:
    """A polynomial times x**n modulo that of CRC-32, in its reflected bit order."""
    for _ in range(n):
        bits = (bits >> 1) ^ (_POLY if bits & 1 else 0)
    return bits


@lru_cache(maxsize=64)
def _append_table(power: int) -> np.ndarray:
    """What 2**power further bytes do to each byte of a CRC: a linear map as four tables of 256."""
    if power == 0:
        image = np.array([_times_x(1 << b, 8) for b in range(32)], dtype=np.uint32)
    else:
        half = _append_table(power - 1)
        image = _look_up(half, _look_up(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    tables = np.zeros((4, 256), dtype=np.uint32)
    for part in range(4):
        for b in range(8):
            tables[part] ^= np.where((np.arange(256) >> b) & 1, image[8 * part + b], 0).astype(np.uint32)
    return tables


def _look_up(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


def crc_after(crc: np.ndarray, bytes_after: np.ndarray) -> np.ndarray:
    """What parts with these CRCs add (by xor) to the CRC of a whole in which so many bytes follow."""
    out, power = crc.astype(np.uint32), 0
    while (bytes_after >> power).any():
        odd = ((bytes_after >> power) & 1) == 1
        out[odd] = _look_up(_append_table(power), out[odd])
        power += 1
    return out


def _chunk_facts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each chunk's CRC as 32-bit ids, its ids, and whether its digest is that of its payload."""
        wide, narrow = np.dtype("<u4"), np.dtype(f"<u{size}")
        for batch in batches:
            crcs, counts, sound = [], [], []
            for key, data in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                good = data is not None and len(data) % size == 0 and _digest(data) == key
                crcs.append(zlib.crc32(np.frombuffer(data, narrow).astype(wide)) if good else 0)
                counts.append(len(data) // size if good else 0)
                sound.append(good)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(crcs, pa.int64()), pa.array(counts, pa.int64()), pa.array(sound, pa.bool_())], names=["digest", "crc", "got", "sound"])

    return run


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("digest binary, payload binary, kind string").parquet(f"{path}/entries").where("kind = 'chunk'").select("digest", "payload")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RECIPE).parquet(f"{path}/recipes")


def _parts(recipes: DataFrame, *keep: str) -> DataFrame:
    """A row for each chunk of each document: the columns to keep, digest, end, n (ids) and after (the document's ids that follow)."""

    def part(end, k):
        before = F.when(k > 0, F.element_at("ends", k)).otherwise(0)
        return F.struct(F.substring(F.col("digests"), k * DIGEST + 1, F.lit(DIGEST)).alias("digest"), end.alias("end"), (end - before).alias("n"), (F.col("n_tokens") - end).alias("after"))

    return recipes.select(*keep, F.inline(F.transform("ends", part)))


def _shards(spark: SparkSession, path: str, recipes: DataFrame) -> DataFrame:
    """shard, sound (its leaves give the manifest's root and sizes) and before (ids of the shards before), from a row for each shard."""
    kept = spark.read.schema("shard int, n_docs long, n_tokens long, root binary").parquet(f"{path}/manifest")
    again = _manifest(recipes).select("shard", *(F.col(c).alias(f"{c}_again") for c in ("n_docs", "n_tokens", "root")))
    same = [F.col(c) == F.col(f"{c}_again") for c in ("n_docs", "n_tokens", "root")]
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return kept.join(again, "shard", "full").select("shard", F.coalesce(same[0] & same[1] & same[2], F.lit(False)).alias("sound"), before.alias("before"))


def verify_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each shard: shard, sound (its documents, recomputed from the recipes, give the manifest's root)."""
    recipes = _recipes(spark, path).mapInArrow(_checked, f"{_RECIPE}, whole boolean")
    whole = recipes.groupBy("shard").agg(F.min("whole").alias("whole"))
    return _shards(spark, path, recipes).join(whole, "shard", "left").select("shard", (F.col("sound") & F.coalesce("whole", F.lit(False))).alias("sound"))


def _id_bytes(spark: SparkSession, path: str) -> int:
    """How wide the store's ids are; a store without documents has none."""
    width = spark.read.schema("id_bytes int").parquet(f"{path}/manifest").agg(F.max("id_bytes").alias("n")).first()["n"]
    return width or 2


def _read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """Recipes with before (ids of the shards before theirs) and whole: they give their root and leaf, and their shard's leaves the manifest's root."""
    shards = _shards(spark, path, _recipes(spark, path)).withColumnRenamed("sound", "listed")
    docs = _recipes(spark, path).mapInArrow(_checked, f"{_RECIPE}, whole boolean").join(shards, "shard")
    return docs.withColumn("whole", F.col("whole") & F.col("listed"))


def _payloads(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks whose payload has their digest, and its ids; the others' payload is null."""
        for batch in batches:
            sound = [data if data is not None and len(data) % size == 0 and _digest(data) == key else None for key, data in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist(), strict=True)]
            counts = [None if data is None else len(data) // size for data in sound]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(sound, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "payload", "got"])

    return run


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_tokens, ids from the sorted payloads of a document; null if one is missing."""
    for batch in slices(batches):
        ids = [b"".join(p["payload"] for p in parts) if good else None for good, parts in zip(batch.column("good").to_pylist(), batch.column("parts").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned integers, as wide as in the store): every document, put together from its chunks.

    Chunks are checked against their digests, recipes against their roots and leaves, shards
    against the manifest. Where a check fails or a chunk is missing, ids is null, never short.
    """
    chunks = _chunks(spark, path).mapInArrow(_payloads(_id_bytes(spark, path)), "digest binary, payload binary, got long")
    found = _parts(_read_recipes(spark, path), "shard", "pos", "doc_id", "n_tokens", "whole").join(chunks, "digest", "left")
    good = F.col("whole") & F.coalesce(F.col("got") == F.col("n"), F.lit(False))
    listed = F.array_sort(F.collect_list(F.struct("end", "payload")))
    whole = found.groupBy("shard", "pos", "doc_id", "n_tokens").agg(listed.alias("parts"), F.min(good).alias("good"))
    return whole.select("doc_id", "n_tokens", "good", "parts").mapInArrow(_put_together, "doc_id long, n_tokens long, ids binary")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the store's files alone.

    Each unique chunk is read and checked against its digest once, each recipe against its root and
    leaf, and each shard's leaves against the manifest. A document's CRC is the xor of what its
    chunks add, so no payload is shuffled. Where a chunk, recipe or shard fails its check, or a
    chunk is missing, ids_crc32 is null.
    """
    facts = _chunks(spark, path).mapInArrow(_chunk_facts(_id_bytes(spark, path)), "digest binary, crc long, got long, sound boolean")
    docs = _read_recipes(spark, path).withColumn("start", F.col("before") + F.col("first"))

    @F.pandas_udf("long")
    def added(crc: pd.Series, after: pd.Series) -> pd.Series:
        bytes_after = np.maximum(after.to_numpy(dtype=np.int64), 0) * 4  # negative only in recipes that fail their check
        return pd.Series(crc_after(crc.to_numpy(dtype=np.uint32), bytes_after).astype(np.int64))

    found = _parts(docs, "shard", "pos", "doc_id", "start", "n_tokens", "whole").join(facts, "digest", "left")
    found = found.withColumns({"added": added(F.coalesce("crc", F.lit(0)), "after"), "good": F.col("whole") & F.coalesce(F.col("sound") & (F.col("got") == F.col("n")), F.lit(False))})
    whole = found.groupBy("shard", "pos", "doc_id", "start", "n_tokens").agg(F.bit_xor("added").alias("crc"), F.min("good").alias("good"))
    return whole.select("doc_id", "start", "n_tokens", F.when(F.col("good"), F.col("crc")).alias("ids_crc32"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the store and back."""
    scratch = Scratch(spark, "content-store")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    write_store(docs, scratch.root, "word_bpe_49k.json", 1)
    return read_digest(spark, scratch.root)
