"""SimHash near-duplicates: fingerprints of shingles, candidates by fuzzy hashing with the Golay code, components.

A fingerprint's 64 bits are three segments A, B, C of 21, 21 and 22 bits. If two fingerprints differ
in at most 3 bits, either A and B differ in at most one bit each, or C and one of A and B agree but
for one bit in one of them (the segment left out holds 2 or 3 of the errors). So a pair meets under
one of five keys: (A, B) both fuzzy, or one segment exact and the other fuzzy for (A, C), (C, A),
(B, C), (C, B). A fuzzy segment is indexed under the codeword it decodes to and probed under every
codeword within four bits, of which there are at most six; so one-bit neighbours always meet.
Candidates are verified inside the join: only links leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import golay
from tidemark.llm.common import Scratch, components, numbered, slices, table

SEED = 42
BITS = 3  # fingerprints link at so many differing bits or fewer
WORDS = 3  # in a shingle


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of all shingles of the ASCII-lower-cased text, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= WORDS:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1)[: len(words) - WORDS + 1].tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    packed = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(packed), 65536):
        ones += np.unpackbits(packed[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        bits = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long) of every row, whole texts."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_fingerprints, "doc_id long, fp long")


#: (kind of key, exact segment or None, fuzzy segments)
_KEYS = ((0, None, (0, 1)), (1, 0, (2,)), (2, 2, (0,)), (3, 1, (2,)), (4, 2, (1,)))


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    bits = fp.view(np.uint64)
    return [(bits >> np.uint64(43)).astype(np.int64), ((bits >> np.uint64(22)) & np.uint64((1 << 21) - 1)).astype(np.int64), (bits & np.uint64((1 << 22) - 1)).astype(np.int64)]


def _out(keys: list[np.ndarray], fps: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(fps))], names=["key", "fp"])


def _index_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each kind of key."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        parts = _segments(fp)
        near = [golay.index(x) for x in parts]
        keys = []
        for kind, exact, fuzzy in _KEYS:
            key = np.full(len(fp), kind, dtype=np.int64) if exact is None else (np.int64(kind) << 22) | parts[exact]
            for x in fuzzy:
                key = (key << 12) | near[x]
            keys.append(key)
        yield _out(keys, [fp] * len(keys))


def _probe_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each kind of key as many rows as codewords are near: at most 36 and four times 6."""
    for batch in slices(batches, 4096):
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        parts = _segments(fp)
        near = [golay.near_indices(x) for x in parts]
        keys, fps = [], []
        for kind, exact, fuzzy in _KEYS:
            key = np.full(len(fp), kind, dtype=np.int64) if exact is None else (np.int64(kind) << 22) | parts[exact]
            key, real = key[:, None], np.ones((len(fp), 1), dtype=bool)
            for x in fuzzy:
                index, counts = near[x]
                key = ((key[:, :, None] << 12) | index[:, None, :]).reshape(len(fp), -1)
                real = (real[:, :, None] & counts[:, None, :]).reshape(len(fp), -1)
            keys.append(key[real])
            fps.append(np.repeat(fp, real.sum(axis=1)))
        yield _out(keys, fps)


def links(fps: DataFrame) -> DataFrame:
    """(u, v): all pairs of different fingerprints of `fps` (fp: long, distinct) that differ in at most BITS bits."""
    index = fps.select("fp").mapInArrow(_index_keys, "key long, fp long").withColumnRenamed("fp", "u")
    probe = fps.select("fp").mapInArrow(_probe_keys, "key long, fp long").withColumnRenamed("fp", "v")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= BITS
    # Spark takes the keys, up to 60 a fingerprint, to be no larger than the fingerprints, and would broadcast them.
    met = index.join(probe.hint("merge"), (index["key"] == probe["key"]) & (F.col("u") < F.col("v")) & near)
    return met.select("u", "v").distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links lead to, the own included. Equal fingerprints
    (exact copies, and all texts without words) are one node, so a large group of copies makes no
    pairs. Null texts have no words. A null doc_id keeps its row and is never a component_id unless
    its whole component has none. Repeated rows stay. Further columns are not read.
    """
    marked = scratch.save(fingerprints(docs, id_col, text_col), "fingerprints")
    out = marked.join(_of_fingerprints(marked, scratch), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _of_fingerprints(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """fp, component (one of its fingerprints) and component_id, for every fingerprint of marked (fp, doc_id)."""
    nodes = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    edges = scratch.save(links(nodes), "links")
    joined = components(edges, scratch)
    grouped = nodes.join(joined, nodes["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return grouped.join(named, "component").select("fp", "component", "component_id")


def _marked(fields: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = np.array([fingerprint(t) for t in batch.column(text).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits.view(np.int64))], names=[*fields, "fp"])

    return run


def without_near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One whole row of docs for each near-duplicate component, with all its columns.

    It is the row with the smallest doc_id (null last), then the smallest fingerprint and hash of
    the text; of rows equal in all of these one stays. Rows are told apart by themselves, so
    different texts under one doc_id, or without one, are documents like others.
    """
    own, names, back = numbered(docs)
    text, doc_id = (names[docs.columns.index(c)] for c in (text_col, id_col))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    marked = scratch.save(own.mapInArrow(_marked(names, text), f"{fields}, fp long").withColumn("uid", F.monotonically_increasing_id()), "marked")
    slim = marked.select("fp", "uid", F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "hash", "uid")).alias("first")
    stays = slim.join(_of_fingerprints(slim, scratch), "fp").groupBy("component").agg(first).select("first.uid")
    return marked.join(stays, "uid", "left_semi").select(*back)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, Scratch(spark, "simhash"))
