"""Packing by linear grouping: pieces of documents into few sequences of bounded length.

Large lengths are rounded up within groups of equal cardinality. Over these few sizes, a linear
program finds the configurations (how many of each size share a sequence) that need the fewest
sequences; its columns are generated by a knapsack over its dual prices. Whole multiples of the
configurations are used, what is left over is filled up greedily, actual pieces take the places in
order, and small pieces then go where they fit best. Everything the driver plans with is a histogram of lengths (at most `capacity` entries), so
its work doesn't grow with the input; ranks and places of the rows are computed by Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, local_table, ranked, shuffle_partitions, slices, table
from tidemark.llm.tokens import encoder

CAPACITY = 2048
GROUPS = 128  # sizes that patterns are made of
SMALL = 8  # lengths up to capacity / SMALL are small

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"


def _pieces(tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
        for batch in slices(batches):
            rows = []
            encoded = enc.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc_id, data in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.append(np.frombuffer(data, dtype=enc.dtype), end)
                at, to = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while at < len(ids):
                    part = ids[at:to]
                    rows.append((doc_id, piece, at, len(part), zlib.crc32(part.astype("<u4").tobytes()), part.tobytes() if with_ids else None))
                    at, to, piece = to, to + capacity, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


@dataclass
class Plan:
    """places: (length, first rank, end rank, sequence of the first rank); rooms: what each run of sequences has left."""

    capacity: int
    places: list[tuple[int, int, int, int]] = field(default_factory=list)
    rooms: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # room: runs (first sequence, sequences)
    sequences: int = 0

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def leave(self, first: int, count: int, room: int) -> None:
        if count:
            self.rooms.setdefault(room, []).append((first, count))


def _pattern(sizes: list[int], left: list[int], capacity: int) -> dict[int, int]:
    """Of the groups that have pieces left: the largest, and others that fill the rest of a sequence best."""
    first = next(g for g, n in enumerate(left) if n)
    room = capacity - sizes[first]
    taken_by = np.full(room + 1, -1, dtype=np.int32)  # the group whose piece first reached a sum
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    for g in range(first, len(sizes)):
        spare = min(left[g] - (g == first), room // sizes[g])
        for _ in range(spare):
            new = np.zeros_like(reached)
            new[sizes[g] :] = reached[: room + 1 - sizes[g]]
            new &= ~reached
            if not new.any():
                break
            taken_by[new] = g
            reached |= new
    out, at = {first: 1}, int(np.flatnonzero(reached)[-1])
    while at:
        g = int(taken_by[at])
        out[g] = out.get(g, 0) + 1
        at -= sizes[g]
    return out


def _knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> list[np.ndarray]:
    """For each size the dearest configuration that has it; sizes may be repeated."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    rooms = np.arange(capacity + 1)
    while True:  # one more piece at a time, as many as the smallest size allows
        offers = np.stack([np.concatenate((np.full(x, -1.0), best[: capacity + 1 - x] + p)) for x, p in zip(sizes, prices, strict=True)])
        g = offers.argmax(axis=0)
        offer = offers[g, rooms]
        better = offer > best + 1e-12
        if not better.any():
            break
        best, last = np.where(better, offer, best), np.where(better, g, last)
    out = []
    for first, x in enumerate(sizes):
        column, room = np.zeros(len(sizes)), capacity - x
        column[first] = 1
        while room >= 0 and last[room] >= 0:
            column[last[room]] += 1
            room -= sizes[last[room]]
        out.append(column)
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 40) -> list[tuple[dict[int, int], int]]:
    """Configurations of the sizes and how often each is used (whole times only), by column generation.

    The simplex method starts from sequences of one size each. Its duals price the sizes, and the
    knapsack gives configurations that are worth more than the sequence they take, until there are
    none. Work follows the number of sizes, not the demand.
    """
    m = len(sizes)
    if not m:
        return []
    columns = np.diag([float(capacity // x) for x in sizes])
    basis, b = np.arange(m), np.asarray(demand, dtype=float)
    for _ in range(rounds):
        for _ in range(20 * m):
            matrix = columns[:, basis]
            prices = np.linalg.solve(matrix.T, np.ones(m))
            worth = prices @ columns
            enter = int(worth.argmax())
            if worth[enter] <= 1 + 1e-7:
                break
            step, now = np.linalg.solve(matrix, np.stack([columns[:, enter], b], axis=1)).T
            ratio = np.where(step > 1e-9, np.maximum(now, 0) / np.where(step > 1e-9, step, 1), np.inf)
            basis[int(ratio.argmin())] = enter
        found = [c for c in _knapsack(sizes, prices, capacity) if c @ prices > 1 + 1e-6]
        new = {tuple(c) for c in found} - set(map(tuple, columns.T))
        if not new:
            break
        columns = np.concatenate((columns, np.array(sorted(new)).T), axis=1)
    times = np.linalg.solve(columns[:, basis], b)
    left, out = np.asarray(demand, dtype=np.int64).copy(), []
    for k, x in zip(basis.tolist(), times.tolist(), strict=True):
        column = columns[:, k].astype(np.int64)
        n = min(int(x + 1e-6), *(int(left[g] // column[g]) for g in np.flatnonzero(column)), *[1 << 62])
        if n > 0:
            left -= n * column
            out.append(({int(g): int(column[g]) for g in np.flatnonzero(column)}, n))
    return out


def _groups(histogram: dict[int, int], count: int) -> list[list[tuple[int, int, int]]]:
    """Lengths in descending order as groups of equal cardinality: (length, first rank, end rank) runs."""
    total = sum(histogram.values())
    each = max(1, -(-total // count))
    out, room = [], 0
    for length in sorted(histogram, reverse=True):
        at = 0
        while at < histogram[length]:
            if not room:
                out.append([])
                room = each
            take = min(room, histogram[length] - at)
            out[-1].append((length, at, at + take))
            at, room = at + take, room - take
    return out


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> Plan:
    """Places for so many pieces of each length (0 < length <= capacity)."""
    plan = Plan(capacity)
    large = {x: n for x, n in histogram.items() if x * small > capacity}
    parts = _groups(large, groups)
    sizes = [g[0][0] for g in parts]  # rounded up to the group's largest
    left = [sum(b - a for _, a, b in g) for g in parts]
    cursor = [(0, 0) for _ in parts]  # run, and pieces of it that have places

    def take(g: int, count: int) -> list[tuple[int, int, int]]:
        """The next `count` actual pieces of a group, as runs."""
        out = []
        k, used = cursor[g]
        while count:
            length, a, b = parts[g][k]
            n = min(count, b - a - used)
            out.append((length, a + used, a + used + n))
            count, used = count - n, used + n
            if a + used == b:
                k, used = k + 1, 0
        cursor[g] = (k, used)
        return out

    optimal = iter(configurations(sizes, left, capacity))
    while any(left):
        pattern, times = next(optimal, (None, 0))
        if pattern is None:
            pattern = _pattern(sizes, left, capacity)
            times = min(left[g] // m for g, m in pattern.items())
        first = plan.open(times)
        filled = np.zeros(1, dtype=np.int64)
        starts = np.zeros(1, dtype=np.int64)  # runs of sequences that hold equal lengths so far
        for g, m in pattern.items():
            left[g] -= m * times
            for _ in range(m):
                at, edges, lengths = 0, [], []
                for length, a, b in take(g, times):
                    plan.places.append((length, a, b, first + at))
                    edges.append(at)
                    lengths.append(length)
                    at += b - a
                cuts = np.union1d(starts, edges)
                filled = filled[np.searchsorted(starts, cuts, "right") - 1] + np.array(lengths)[np.searchsorted(edges, cuts, "right") - 1]
                starts = cuts
        for at, to, used in zip(starts.tolist(), [*starts[1:].tolist(), times], filled.tolist(), strict=True):
            plan.leave(first + at, to - at, capacity - used)

    for length in sorted((x for x in histogram if x not in large), reverse=True):
        at, end = 0, histogram[length]
        while at < end:
            room = min((r for r, runs in plan.rooms.items() if r >= length and runs), default=None)
            if room is None:
                room = capacity
                plan.leave(plan.open(-(-(end - at) // (capacity // length))), -(-(end - at) // (capacity // length)), capacity)
            first, count = plan.rooms[room].pop()
            each = room // length
            whole = min(count, (end - at) // each)
            for j in range(each if whole else 0):
                plan.places.append((length, at + j * whole, at + (j + 1) * whole, first))
            plan.leave(first, whole, room - each * length)
            at += each * whole
            if whole < count:
                rest = min(end - at, each) if at < end else 0
                for j in range(rest):
                    plan.places.append((length, at + j, at + j + 1, first + whole))
                at += rest
                if rest:
                    plan.leave(first + whole, 1, room - rest * length)
                    whole += 1
                plan.leave(first + whole, count - whole, room)
    return plan


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, capacity: int = CAPACITY, groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with_ids, ids.

    A document is its ids and end_id; null and empty texts have end_id alone. Only documents over
    `capacity` are cut, so that all pieces but the first are full. Repeated rows are packed as often
    as they come; a null doc_id stays null. Further columns are not read. No document: no row.
    ids: little-endian unsigned integers as wide as the vocabulary needs.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoded = source.mapInArrow(_pieces(tokenizer, end_id, capacity, with_ids), _PIECES).withColumn("uid", F.monotonically_increasing_id())
    pieces = scratch.save(encoded, "pieces")
    open_ = pieces.where(F.col("length") < capacity).select("uid", "doc_id", "piece", "start", "length", "ids_crc32")
    histogram = {r["length"]: r["n"] for r in open_.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(histogram, capacity, groups)
    # Plan rows follow the lengths and patterns, not the documents; Spark knows how many they are.
    places = local_table(spark, plan.places, of=pa.int32(), first=pa.int64(), end=pa.int64(), at=pa.int64())
    at_rank = ranked(open_, ["length"], ["uid"], F.col("uid"), 2 * shuffle_partitions(spark), "rank")
    placed = at_rank.join(places, (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    placed = placed.select("uid", "doc_id", "piece", "start", "length", "ids_crc32", (F.col("at") + F.col("rank") - F.col("first")).alias("sequence_id"))
    before = W.partitionBy("sequence_id").orderBy(F.desc("length"), "uid").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    columns = ["uid", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset")]
    # Full pieces have sequences of their own, numbered from the other side of zero.
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0)})
    out = placed.select(*columns).unionByName(full.select(*columns))
    if with_ids:
        out = out.join(pieces.select("uid", "ids"), "uid")
    return out.drop("uid")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack(docs, Scratch(spark, "packing"), with_ids=False)
