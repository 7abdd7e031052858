"""Residue distances between chains, and scores held against them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

FAR = 50.0
#: Atoms in a block, the repeated ones included; a block has one residue at least.
BLOCK = 2816


def _square():
    """The squared distance of atoms (xa, ya, za) and (x, y, z); products, as POWER costs far more."""
    return sum((F.col(p) - F.col(q)) * (F.col(p) - F.col(q)) for p, q in (("xa", "x"), ("ya", "y"), ("za", "z")))


def _cells(atoms_a: DataFrame, atoms_b: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame]:
    """Atoms (res, x, y, z) in cells of the cutoff's size, those of the second chain in the 26 neighbours too, so only near
    atoms meet: (res_a, xa, ya, za) and (res, x, y, z), both with cx, cy, cz."""
    cell = lambda c: F.floor(F.col(c) / cutoff)
    around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    a = atoms_a.select(F.col("res").alias("res_a"), F.col("x").alias("xa"), F.col("y").alias("ya"), F.col("z").alias("za"), cell("x").alias("cx"), cell("y").alias("cy"), cell("z").alias("cz"))
    b = atoms_b.select("*", around("x").alias("cx")).select("*", around("y").alias("cy")).select("*", around("z").alias("cz"))
    return a, b


def contacts(atoms_a: DataFrame, atoms_b: DataFrame, cutoff: float) -> DataFrame:
    """(res_a, res_b, dist) of residues whose nearest atoms are nearer than cutoff."""
    a, b = _cells(atoms_a, atoms_b, cutoff)
    near = a.join(b, ["cx", "cy", "cz"]).select("res_a", F.col("res").alias("res_b"), F.sqrt(_square()).alias("d")).where(F.col("d") < cutoff)
    return near.groupBy("res_a", "res_b").agg(F.min("d").alias("dist"))


def touching(atoms: DataFrame, others: DataFrame, cutoff: float) -> DataFrame:
    """(res) of residues with an atom nearer than cutoff to one of the others. An atom's search ends with the first such one,
    so large groups of near atoms make no pairs."""
    a, b = _cells(atoms, others, cutoff)
    same = [a[c] == b[c] for c in ("cx", "cy", "cz")]
    return a.join(b, [*same, F.sqrt(_square()) < cutoff], "left_semi").select(F.col("res_a").alias("res")).distinct()


def surface(near: DataFrame, chain: str) -> DataFrame:
    return near.select(F.col(f"res_{chain}").alias("res")).distinct()


def _pack(batches):
    """Blocks of residues as (res, k, at): all have k atoms, their last one repeated, as this changes no least distance."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    names = pa.concat_arrays(t.column("res").chunks).dictionary_encode()
    code = names.indices.to_numpy()
    at = np.column_stack([t.column(c).to_numpy() for c in "xyz"])[np.argsort(code, kind="stable")]
    n = np.bincount(code)
    first, order = np.cumsum(n) - n, np.argsort(n, kind="stable")
    while len(order):
        m = max(1, int(np.searchsorted(n[order] * np.arange(1, len(order) + 1), BLOCK, "right")))
        own, order = order[:m], order[m:]
        k = n[own[-1]]
        places = at[first[own][:, None] + np.minimum(np.arange(k), n[own][:, None] - 1)]
        res = pa.array([names.dictionary.take(pa.array(own)).to_pylist()], pa.list_(names.dictionary.type))
        yield pa.RecordBatch.from_arrays([res, pa.array([k], pa.int64()), pa.array([places.tobytes()], pa.binary())], names=["res", "k", "at"])


def _least(a: np.ndarray) -> np.ndarray:
    """The minimum over the first axis, by halves and in place: whole halves compare much faster than single rows."""
    n = len(a)
    while n > 1:
        h = n // 2
        np.minimum(a[:h], a[n - h:n], out=a[:h])
        n -= h
    return a[0]


def _exact(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    square = sum((p[:, :, None, c] - q[:, None, :, c]) ** 2 for c in range(3))
    return np.sqrt(square.min((1, 2)))


def least_distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The least distances to one decimal, half to even, of the residues p (m, k, 3) to q (n, l, 3). Squares come from a
    matrix product; where its error could change the decimal, they are taken from the differences."""
    pp, qq = (p * p).sum(2), (q * q).sum(2).T
    left = np.concatenate([-2 * p, np.ones((*pp.shape, 1)), pp[:, :, None]], 2)
    right = np.concatenate([q.transpose(2, 1, 0), qq[None], np.ones((1, *qq.shape))]).reshape(5, -1)
    square, buffer = np.empty((len(p), len(q))), np.empty((p.shape[1], right.shape[1]))
    for i in range(len(p)):
        square[i] = _least(_least(np.matmul(left[i], right, out=buffer)).reshape(qq.shape))
    error = 1e-14 * (pp.max() + qq.max())
    out, high = np.rint(10 * np.sqrt(np.maximum(square - error, 0))), np.rint(10 * np.sqrt(np.maximum(square + error, 0)))
    i, j = np.nonzero(out != high)
    step = max(1, 500_000 // (p.shape[1] * q.shape[1]))
    for s in range(0, len(i), step):
        out[i[s:s + step], j[s:s + step]] = np.rint(10 * _exact(p[i[s:s + step]], q[j[s:s + step]]))
    return out / 10


def _compare(batches):
    for batch in batches:
        col = {c: batch.column(c) for c in ("res_a", "k_a", "at_a", "res_b", "k_b", "at_b")}
        for r in range(batch.num_rows):
            p, q = (np.frombuffer(col[f"at_{x}"][r].as_buffer()).reshape(-1, col[f"k_{x}"][r].as_py(), 3) for x in "ab")
            res_a, res_b = (col[f"res_{x}"][r].values for x in "ab")
            pairs = [res_a.take(pa.array(np.repeat(np.arange(len(p)), len(q)))), res_b.take(pa.array(np.tile(np.arange(len(q)), len(p))))]
            yield pa.RecordBatch.from_arrays([*pairs, pa.array(least_distances(p, q).ravel())], names=["res_a", "res_b", "dist"])


def distances(atoms_a: DataFrame, atoms_b: DataFrame, cutoff: float) -> DataFrame:
    """(res_a, res_b, dist to one decimal) of all pairs of surface residues, those with any contact. Both chains go in blocks
    of bounded size, each two of which are compared as matrices; neither atoms' pairs nor rows of the result are shuffled."""
    kind = atoms_a.schema["res"].dataType.simpleString(), atoms_b.schema["res"].dataType.simpleString()
    atoms_a, atoms_b = (d.where(" AND ".join(f"abs({c}) < double('infinity')" for c in "xyz")) for d in (atoms_a, atoms_b))

    def blocks(atoms: DataFrame, others: DataFrame, x: str, kind: str) -> DataFrame:
        own = atoms.join(touching(atoms, others, cutoff), "res", "left_semi").select("res", *[F.col(c).cast("double").alias(c) for c in "xyz"])
        out = stored(own.repartition("res").mapInArrow(_pack, f"res array<{kind}>, k long, at binary"), "blocks")
        return out.select(*[F.col(c).alias(f"{c}_{x}") for c in out.columns])

    a, b = blocks(atoms_a, atoms_b, "a", kind[0]), blocks(atoms_b, atoms_a, "b", kind[1])
    least = atoms_a.sparkSession.sparkContext.defaultParallelism
    # plain counts, as a few blocks are long work: a task holds some 4 of a against 64 of b
    pairs = a.repartition(max(least, a.count() // 4)).crossJoin(b.repartition(max(1, b.count() // 64)))
    return pairs.mapInArrow(_compare, f"res_a {kind[0]}, res_b {kind[1]}, dist double")


def distances_of(pairs: DataFrame, atoms_a: DataFrame, atoms_b: DataFrame, cutoff: float) -> DataFrame:
    """The rows of ``distances`` for some pairs (res_a, res_b): only their residues are held against the whole of the other
    chain, to see which are on the surface, so the work grows with the atoms and not with their pairs."""
    pairs = pairs.select("res_a", "res_b").distinct()
    side = lambda atoms, c: atoms.join(pairs.select(F.col(c).alias("res")).distinct(), "res", "left_semi")
    a, b = side(atoms_a, "res_a"), side(atoms_b, "res_b")
    a = a.join(surface(contacts(atoms_b, a, cutoff), "b"), "res", "left_semi").select(F.col("res").alias("res_a"), F.col("x").alias("xa"), F.col("y").alias("ya"), F.col("z").alias("za"))
    b = b.join(surface(contacts(atoms_a, b, cutoff), "b"), "res", "left_semi").withColumnRenamed("res", "res_b")
    return pairs.join(a, "res_a").join(b, "res_b").groupBy("res_a", "res_b").agg(F.bround(F.sqrt(F.min(_square())), 1).alias("dist"))


def with_distance(scores: DataFrame, interface: DataFrame, default: float | None = FAR) -> DataFrame:
    seen = interface.select(F.col("res_a").alias("pos1"), F.col("res_b").alias("pos2"), "dist")
    out = scores.join(seen, ["pos1", "pos2"], "left")
    return out if default is None else out.withColumn("dist", F.coalesce("dist", F.lit(default)))


def true_positives(scores: DataFrame, interface: DataFrame, cutoff: float) -> DataFrame:
    """One row (n, n_tp); pairs off the interface are no positives."""
    return with_distance(scores, interface, None).agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("dist") < cutoff).cast("long")), F.lit(0)).alias("n_tp"))


def classify(scores: DataFrame, interface: DataFrame, threshold: float, cutoff: float) -> DataFrame:
    """scores with dist and kind: TP above the threshold and nearer than the cutoff, FP above it and farther, else negative."""
    d = with_distance(scores, interface)
    above = F.col("score") > threshold
    return d.withColumn("kind", F.when(above & (F.col("dist") > cutoff), "FP").when(above & (F.col("dist") < cutoff), "TP").otherwise("negative"))


def benchmark_index(query: DataFrame, baseline: DataFrame, interface: DataFrame, cutoff: float) -> DataFrame:
    """One row: tp_baseline, tp_query, tpr_full, tpr, bi. Null where a ratio has no base."""
    q = true_positives(query, interface, cutoff).select(F.col("n").alias("_nq"), F.col("n_tp").alias("tp_query"))
    b = true_positives(baseline, interface, cutoff).select(F.col("n_tp").alias("tp_baseline"))
    both = b.crossJoin(q).withColumn("tpr_full", F.try_divide("tp_query", "tp_baseline")).withColumn("tpr", F.coalesce(F.try_divide("tp_query", "_nq"), F.lit(0.0)))
    return both.select("tp_baseline", "tp_query", "tpr_full", "tpr", (F.pow("tpr", F.lit(0.8)) * F.pow("tpr_full", F.lit(0.2))).alias("bi"))


def top_k_rate(top: DataFrame, interface: DataFrame, k: int, cutoff: float) -> DataFrame:
    """One row (n_tp, tpr); the rate divides by k even if there are fewer pairs."""
    return true_positives(top, interface, cutoff).select("n_tp", (F.col("n_tp") / k).alias("tpr"))


def monomer_classify(scores: DataFrame, interface: DataFrame, threshold: float, cutoff: float, separation: int = 0) -> DataFrame:
    """As ``classify`` within one chain: only pairs far enough apart in the sequence; a pair on the interface that is neither
    TP nor FP goes, and one off the interface is negative."""
    far = scores.where(F.abs(F.col("pos1") - F.col("pos2")) >= separation)
    d = with_distance(far, interface, None)
    above = F.col("score") > threshold
    kind = F.when(F.col("dist").isNull(), "negative").when(above & (F.col("dist") > cutoff), "FP").when(above & (F.col("dist") < cutoff), "TP")
    return d.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("dist", F.coalesce("dist", F.lit(FAR)))


def monomer_index(query: DataFrame, baseline: DataFrame, interface: DataFrame, cutoff: float) -> DataFrame:
    """One row: tp_baseline, tp_query, tpr_full, tpr, bi, and rho, the rank correlation of the two score sets."""
    from .couplings import spearman

    return benchmark_index(query, baseline, interface, cutoff).crossJoin(spearman(query, baseline).select("rho"))


def require_hits(index: DataFrame) -> DataFrame:
    """The row of a benchmark index; an error where the query has no true positive."""
    if not index.first().tp_query:
        raise ValueError("the query has no true positive")
    return index
