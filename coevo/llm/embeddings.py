"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to 64 bits, one sign per random direction, and orders all vectors by the bits in
turn; near vectors share long beginnings. Each task compares a sorted range in blocks with the block before
and verifies by cosine. Passes come in batches that grow with the logarithm of the input, since an order must then
agree on more bits; where vectors lie dense a window holds few of a vector's neighbours, so batches go on until the
last half of all passes has joined no two groups. What leaves a window is a spanning forest of its verified pairs; the union of all passes gives groups.
Within a group every pair is then compared exactly, in blocks of bounded size dealt over tasks, so links are counted in
full however large the group, not only those that a window showed; no pair list is ever written. This costs a group of
k different vectors k^2 comparisons and k^2 / ``BLOCK`` rows on their way; a link between two groups that no pass joined is
not counted. Equal vectors are one node.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths never link; a cosine of the threshold itself links; a null id links with nothing and has a
null component; repeated rows are copies of each other; extra columns, whatever their names, are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

WINDOW = 512
BLOCK = 1024


def _directions(dimensions: int, number: int) -> np.ndarray:
    return np.random.default_rng([dimensions, number]).standard_normal((dimensions, 64))


def sort_keys(unit: np.ndarray, number: int) -> np.ndarray:
    """int64 in the lexicographic order of 64 sign bits of pass ``number``."""
    bits = (unit @ _directions(unit.shape[1], number) > 0).astype(np.uint8)
    key = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def _unit(blobs: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) with vec as little-endian doubles, null where the vector can't link."""

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v], "<f8") if v else np.empty(0)
                good = len(x) and np.isfinite(x).all() and x.any()
                if good:
                    x = x / np.abs(x).max()  # no overflow or underflow in the norm
                out.append((x + 0.0).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "vec"])

    return df.select(id_col, vector_col).mapInArrow(run, "id long, vec binary")


def _forest(hits: np.ndarray) -> np.ndarray:
    """Smallest row reachable by hits (symmetric, with the diagonal) for each row."""
    label = np.arange(len(hits))
    while True:
        new = np.where(hits, label[None, :], len(hits)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _window_links(batches, threshold: float, window: int = WINDOW):
    """Links from rows sorted by (pass, key): each block against itself and the block before."""
    before: tuple = ()
    held: list[tuple] = []

    def compare(block):
        nonlocal before
        a, b = [], []
        for dim in {len(x[2]) for x in block}:
            rows = [x for x in (*before, *block) if len(x[2]) == dim]
            unit = _unit([x[2] for x in rows])
            hits = unit @ unit.T >= threshold
            np.fill_diagonal(hits, True)
            if hits.sum() > len(rows):
                root = _forest(hits | hits.T)
                for k in np.flatnonzero(root != np.arange(len(rows))).tolist():
                    a.append(rows[k][1])
                    b.append(rows[root[k]][1])
        before = tuple(block)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and (row[0] != held[0][0] or len(held) == window):
                yield compare(held)
                if row[0] != held[0][0]:
                    before = ()
                held = []
            held.append(row)
    if held:
        yield compare(held)


def _group_links(batches, threshold: float):
    """Rows (task, second, node, copies, vec) sorted by task: links of each row of the task's two blocks."""

    def count(rows):
        out_node, out_links = [], []
        for dim in {len(r[4]) for r in rows}:
            own = [r for r in rows if len(r[4]) == dim]
            unit = _unit([r[4] for r in own])
            copies = np.array([r[3] for r in own])
            half = np.array([r[1] for r in own])
            hits = unit @ unit.T >= threshold
            np.fill_diagonal(hits, False)
            if half.any():  # two different blocks: only pairs across
                hits &= half[:, None] != half[None, :]
            out_node += [r[2] for r in own]
            out_links += (hits @ copies).tolist()
        return pa.RecordBatch.from_arrays([pa.array(out_node, pa.int64()), pa.array(out_links, pa.int64())], names=["node", "links"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and row[0] != held[0][0]:
                yield count(held)
                held = []
            held.append(row)
    if held:
        yield count(held)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, passes: int | None = None, window: int = WINDOW) -> DataFrame:
    """(id, n_links, component_id) for every row."""
    every = stored(_vectors(df, id_col, vector_col).withColumn("h", F.sha2("vec", 256)), "vectors")
    able = every.where("vec IS NOT NULL AND id IS NOT NULL")
    nodes = stored(able.groupBy("h").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.max("vec").alias("vec")), "nodes")
    step = passes if passes is not None else max(12, int(nodes.count()).bit_length())

    def project(batches, first):
        for batch in batches:
            node, blobs = batch.column(0), batch.column(1).to_pylist()
            for dim in {len(b) for b in blobs}:
                at = [k for k, b in enumerate(blobs) if len(b) == dim]
                own = batch.take(pa.array(at))
                unit = _unit([blobs[k] for k in at])
                for p in range(first, first + step):
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(at), pa.int32()), own.column(0), own.column(1), pa.array(sort_keys(unit, p))], names=["pass", "node", "vec", "key"])

    def links_from(first):
        keyed = nodes.select("node", "vec").mapInArrow(lambda b: project(b, first), "pass int, node long, vec binary, key long")
        ordered = keyed.repartitionByRange("pass", "key", "node").sortWithinPartitions("pass", "key", "node").select("pass", "node", "vec")
        return ordered.mapInArrow(lambda b: _window_links(b, threshold, window), "a long, b long")

    grouped = stored(components(links_from(0)), "groups")
    done = last = step
    joined = grouped.where("node <> component").count()
    while passes is None and done < 2 * last:
        known = grouped.select(F.col("node").alias("a"), F.col("component").alias("b"))
        grouped = stored(components(known.union(links_from(done))), "groups")
        before, joined = joined, grouped.where("node <> component").count()
        done += step
        if joined > before:
            last = done
    blocks = grouped.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("n"))
    own = grouped.join(blocks, "component").join(nodes.select("node", "copies", "vec"), "node").withColumn("i", F.pmod(F.xxhash64("node"), F.col("n")))
    dealt = own.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    task = F.concat_ws(":", "component", F.least("i", "j"), F.greatest("i", "j"))
    dealt = dealt.select(task.alias("task"), (F.col("i") > F.col("j")).cast("int").alias("second"), "node", "copies", "vec")
    counted = dealt.repartition("task").sortWithinPartitions("task", "node").mapInArrow(lambda b: _group_links(b, threshold), "node long, links long")
    totals = counted.groupBy("node").agg(F.sum("links").alias("links"))
    owner = nodes.select("h", "node", "copies").join(grouped, "node", "left").join(totals, "node", "left")
    owner = owner.select("h", F.coalesce("component", "node").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = every.join(owner, "h", "left")
    alone = F.col("id").isNull()
    return out.select(F.col("id").alias(id_col), F.when(alone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), F.when(alone, None).otherwise(F.coalesce("component_id", "id")).alias("component_id"))
