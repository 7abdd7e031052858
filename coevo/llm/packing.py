"""Packing of token sequences: a global large-item matching plan, and local best-fit-decreasing id matrices.

``pack_pieces`` (large-item matching). Lengths are whole numbers up to the capacity, so a packing is
decided by how many pieces of each length there are: at most ``capacity`` numbers reach the driver,
whatever the input. Pieces above a third of the capacity are matched greedily, longest first, each
with the longest one that still fits; no bin holds more than two of them. Shorter ones then go, longest
first, into the smallest gap that fits. The plan says for the n-th piece of a length which bin and
offset it gets. Pieces are numbered within their length by a window over (length, bucket), where the
buckets split a length that many pieces share; no task holds a whole length.

``pack_matrices`` (best-fit decreasing with a segment tree). Each task packs its documents as they
come, ``buffer_tokens`` at a time, and writes id matrices with cumulative lengths and resets.

Defined results: null text is empty; an empty document is one piece of the end id alone; equal
lengths are placed in (doc_id, piece) order within a bucket; very long texts are cut into pieces of the capacity, and
nothing of them is lost; a null doc_id is packed like any other; repeated rows are packed as often as they
occur; an empty table gives no rows. Extra columns, whatever their names, are dropped before tokenizing.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoded_blocks
from .common import stored


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and the end id, cut into pieces of at most ``capacity``."""

    def run(batches):
        for batch in batches:
            key, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b, ids, counts in encoded_blocks(tokenizer, texts):
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                counts = counts + 1
                n = -(-counts // capacity)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(counts[doc] - start, capacity)
                offsets = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([key.slice(a, b - a).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), blob], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids binary")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, after rank, first bin, pieces of this length per bin, offset in the bin), by length and rank."""
    left = {s: n for s, n in counts.items() if n > 0}
    placed = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    runs, bins = [], 0

    def put(s: int, n: int, first: int, per: int, offset: int) -> None:
        if n:
            runs.append((s, placed[s], placed[s] + n, first, per, offset))
            placed[s] += n
            left[s] -= n

    def gap(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if size not in gaps:
                gaps[size] = []
                insort(order, size)
            gaps[size].append((first, n))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        k = bisect_right(large, capacity - s) - 1
        if k >= 0 and large[k] == s and left[s] == 1:
            k -= 1
        t = large[k] if k >= 0 else 0
        n = left[s] if not t else left[s] // 2 if t == s else min(left[s], left[t])
        put(s, n, bins, 1, 0)
        if t:
            put(t, n, bins, 1, s)
        gap(capacity - s - t, bins, n)
        bins += n
        for x in {s, t} - {0}:
            if not left[x]:
                large.pop(bisect_left(large, x))
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            k = bisect_left(order, s)
            if k < len(order):
                size = order[k]
                first, n = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size]
                    order.pop(k)
            else:
                size, first = capacity, bins
                n = -(-left[s] // (capacity // s))
                bins += n
            per = size // s
            full = min(n, left[s] // per)
            put(s, full * per, first, per, capacity - size)
            gap(size - per * s, first, full)
            if full < n:
                rest = left[s]
                if rest:
                    put(s, rest, first + full, rest, capacity - size)
                    gap(size - rest * s, first + full, 1)
                gap(size, first + full + (rest > 0), n - full - (rest > 0))
    return sorted(runs)


def pack_pieces(pieces: DataFrame, capacity: int = 4096, rows_per_bucket: int = 200_000) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset. Lengths must be 1 to ``capacity``."""
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(plan_bins(counts, capacity), np.int64).reshape(-1, 6)
    plan = spark.sparkContext.broadcast(runs)
    buckets = max(64, -(-sum(counts.values()) // rows_per_bucket))
    kept = [c for c in pieces.columns]
    numbered = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = numbered.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "_b", F.coalesce("_before", F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_b").orderBy("doc_id", "piece")
    ranked = numbered.withColumn("_k", F.row_number().over(order)).join(before, ["length", "_b"])
    ranked = ranked.select(*kept, (F.col("_before") + F.col("_k") - 1).alias("_rank"))
    place = kept.index("length")

    def run(batches):
        r = plan.value
        starts = (r[:, 0] << 44) | r[:, 1]
        for batch in batches:
            length, rank = batch.column(place).to_numpy(), batch.column(len(kept)).to_numpy()
            at = np.searchsorted(starts, (length << 44) | rank, side="right") - 1
            k = rank - r[at, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(r[at, 3] + k // r[at, 4]), pa.array(r[at, 5] + k % r[at, 4] * length)], names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


class Gaps:
    """Open bins by remaining capacity; a tree of counts finds the smallest gap that fits in O(log capacity)."""

    def __init__(self, capacity: int):
        self.base = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.base)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, gap: int, which: int) -> None:
        self.bins[gap].append(which)
        self._change(gap, 1)

    def _change(self, gap: int, by: int) -> None:
        k = gap + self.base
        while k:
            self.count[k] += by
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(gap, bin) of the smallest gap of at least ``least``, removed."""
        k = least + self.base
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.base:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        gap = k - self.base
        which = self.bins[gap].pop()
        self._change(gap, -1)
        return gap, which


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers, in the order of placing."""
    gaps, bins = Gaps(capacity), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = gaps.take(lengths[k])
        if found is None:
            found = (capacity, len(bins))
            bins.append([])
        gap, which = found
        bins[which].append(k)
        if gap > lengths[k]:
            gaps.add(gap - lengths[k], which)
    return bins


def pack_matrices(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, pad_id: int = 0, buffer_tokens: int = 4_000_000) -> DataFrame:
    """One row per packed sequence: sequence_id (any numbers), doc_ids, pieces, cu_seqlens (0 first), position_resets
    (where positions start anew; a later piece of a document goes on at ``starts``), input_ids (little-endian uint32,
    padded with ``pad_id`` to the capacity). ``buffer_tokens`` bounds memory: a task packs that many tokens at a time."""
    pieces = tokenize_pieces(docs, tokenizer, capacity, end_id)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held, tokens = [], 0

        def flush():
            nonlocal number
            bins = best_fit_decreasing([h[3] for h in held], capacity)
            for a in range(0, len(bins), 256):
                part = bins[a:a + 256]
                ends = [np.cumsum([0] + [held[k][3] for k in b]).tolist() for b in part]
                ids = [b"".join([held[k][4] for k in b]) for b in part]
                pad = int(pad_id).to_bytes(4, "little")
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(number, number + len(part)), pa.int64()),
                    pa.array([[held[k][0] for k in b] for b in part], pa.list_(key_type)),
                    pa.array([[held[k][1] for k in b] for b in part], pa.list_(pa.int32())),
                    pa.array([[held[k][2] for k in b] for b in part], pa.list_(pa.int64())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array([e[:-1] for e in ends], pa.list_(pa.int32())),
                    pa.array([x + pad * (capacity - len(x) // 4) for x in ids], pa.binary())],
                    names=["sequence_id", "doc_ids", "pieces", "starts", "cu_seqlens", "position_resets", "input_ids"])
                number += len(part)
            held.clear()

        key_type = pa.int64()
        for batch in batches:
            key_type = batch.column(0).type
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(row)
                tokens += row[3]
                if tokens >= buffer_tokens:
                    yield from flush()
                    tokens = 0
        yield from flush()

    key = dict(docs.dtypes)["doc_id"]
    return pieces.mapInArrow(run, f"sequence_id long, doc_ids array<{key}>, pieces array<int>, starts array<long>, cu_seqlens array<int>, position_resets array<int>, input_ids binary")


def write_matrices(packed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Parquet with one fixed-width id row per sequence; files of bounded size."""
    packed.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
