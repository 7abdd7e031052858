"""Coupling scores in long form (pos1, pos2, score) and their measures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def site_frequencies(rows: DataFrame) -> DataFrame:
    """(i, a, f): weighted share of code a in column i (from 1). rows has codes and weight."""
    total = rows.agg(F.sum("weight").alias("_b"))
    long = rows.select("weight", F.posexplode("codes").alias("i", "a")).groupBy((F.col("i") + 1).alias("i"), "a").agg(F.sum("weight").alias("w"))
    return long.crossJoin(F.broadcast(total)).select("i", "a", (F.col("w") / F.col("_b")).alias("f"))


def pair_frequencies(rows: DataFrame, columns: int = 64, rows_each: int = 4096) -> DataFrame:
    """(i, j, a, b, f) of all ordered column pairs, where f is not zero. Columns go in blocks and rows in parts; a task
    multiplies two one-hot blocks of a part, and only sums of weights per pair of codes leave it."""
    total = rows.agg(F.sum("weight").alias("_b"), F.ceil(F.count("*") / rows_each).cast("long").alias("_parts"), F.max(F.size("codes")).alias("_w"))
    held = rows.crossJoin(F.broadcast(total))
    last = F.greatest(F.ceil(F.col("_w") / columns) - 1, F.lit(0)).cast("int")
    cut = lambda k: F.slice("codes", F.col(k) * columns + 1, F.lit(columns))
    held = held.select("weight", "codes", "_w", F.pmod(F.xxhash64("codes", F.monotonically_increasing_id()), F.greatest("_parts", F.lit(1))).alias("part"), F.explode(F.sequence(F.lit(0), last)).alias("p"))
    held = held.select("weight", "codes", "part", "p", F.explode(F.sequence(F.col("p"), F.greatest(F.ceil(F.col("_w") / columns) - 1, F.lit(0)).cast("int"))).alias("q"))
    held = held.select("part", "p", "q", "weight", cut("p").alias("x"), cut("q").alias("y"))

    def count(t: pa.Table) -> pa.Table:
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        w = t.column("weight").to_numpy()
        sides = []
        for name, block in (("x", p), ("y", q)):
            flat = t.column(name).combine_chunks()
            codes = flat.flatten().to_numpy().reshape(len(flat), -1)
            states = np.unique(codes)
            one = (codes[:, :, None] == states).astype(np.float64)
            place = np.arange(codes.shape[1])[:, None] + block * columns + 1
            sides.append((one.reshape(len(codes), -1), np.broadcast_to(place, one.shape[1:]).ravel(), np.broadcast_to(states, one.shape[1:]).ravel()))
        (x, i, a), (y, j, b) = sides
        sums = (x * w[:, None]).T @ y
        k, m = np.nonzero(sums)
        other = i[k] != j[m]
        k, m = k[other], m[other]
        got = [i[k], j[m], a[k], b[m], sums[k, m]]
        if p != q:  # the other order
            got = [np.concatenate([x, y]) for x, y in zip(got, [got[1], got[0], got[3], got[2], got[4]])]
        return pa.table({n: pa.array(v.astype(np.float64 if n == "w" else np.int32)) for n, v in zip("ijabw", got)})

    sums = held.groupBy("part", "p", "q").applyInArrow(count, "i int, j int, a int, b int, w double").groupBy("i", "j", "a", "b").agg(F.sum("w").alias("w"))
    return sums.crossJoin(F.broadcast(total)).select("i", "j", "a", "b", (F.col("w") / F.col("_b")).alias("f"))


def covariance(rows: DataFrame) -> DataFrame:
    """(i, j, a, b, v) with v = f_ij(a, b) - f_i(a) f_j(b) for all code pairs of the columns."""
    f = site_frequencies(rows)
    grid = f.select("i", "a", F.col("f").alias("fi")).join(f.select(F.col("i").alias("j"), F.col("a").alias("b"), F.col("f").alias("fj")), F.col("i") != F.col("j"))
    return grid.join(pair_frequencies(rows), ["i", "j", "a", "b"], "left").select("i", "j", "a", "b", (F.coalesce("f", F.lit(0.0)) - F.col("fi") * F.col("fj")).alias("v"))


def zero_sum_gauge(blocks: DataFrame) -> DataFrame:
    """Each (i, j) block without its row and column means."""
    by = lambda *c: F.avg("v").over(Window.partitionBy("i", "j", *c))
    return blocks.select("i", "j", "a", "b", (F.col("v") - by("a") - by("b") + by()).alias("v"))


def frobenius(blocks: DataFrame, gap: int = 0) -> DataFrame:
    """(pos1, pos2, fn) over the symmetrised block without the gap state."""
    turned = blocks.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("b").alias("a"), F.col("a").alias("b"), "v")
    mean = blocks.unionByName(turned).where(f"a <> {gap} AND b <> {gap}").groupBy("i", "j", "a", "b").agg((F.sum("v") / 2).alias("v"))
    return mean.groupBy(F.col("i").alias("pos1"), F.col("j").alias("pos2")).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("fn"))


def product_correction(norms: DataFrame) -> DataFrame:
    """(pos1, pos2, score) with the diagonal (norm 0); means divide by N - 1. Row sums and the total have at most N rows."""
    norms = stored(norms, "norms")
    sites = norms.select(F.col("pos1").alias("pos")).distinct()
    full = norms.unionByName(sites.select(F.col("pos").alias("pos1"), F.col("pos").alias("pos2"), F.lit(0.0).alias("fn")))
    row = norms.groupBy(F.col("pos1").alias("_p")).agg(F.sum("fn").alias("_s"))
    total = row.agg(F.sum("_s").alias("_t"), F.count("*").alias("_n"))
    out = full.join(row.select(F.col("_p").alias("pos1"), F.col("_s").alias("_r")), "pos1").join(row.select(F.col("_p").alias("pos2"), F.col("_s").alias("_c")), "pos2").crossJoin(F.broadcast(total))
    n = F.col("_n")
    return out.select("pos1", "pos2", (F.col("fn") - F.col("_r") / (n - 1) * (F.col("_c") / (n - 1)) / (F.col("_t") / (n * (n - 1)))).alias("score"))


def one_based(scores: DataFrame) -> DataFrame:
    """Rows and columns shift by one each if their own smallest label is 0."""
    low = scores.agg(F.min("pos1").alias("_a"), F.min("pos2").alias("_b"))
    return scores.crossJoin(F.broadcast(low)).select((F.col("pos1") + (F.col("_a") == 0).cast("int")).alias("pos1"), (F.col("pos2") + (F.col("_b") == 0).cast("int")).alias("pos2"), "score")


def mirror_upper(scores: DataFrame) -> DataFrame:
    up = scores.where("pos1 < pos2")
    return scores.where("pos1 = pos2").unionByName(up).unionByName(up.select(F.col("pos2").alias("pos1"), F.col("pos1").alias("pos2"), "score"))


def interchain(scores: DataFrame, length_a: int) -> DataFrame:
    """Rows of chain A against columns of chain B, which count from 1."""
    return scores.where((F.col("pos1") <= length_a) & (F.col("pos2") > length_a)).withColumn("pos2", F.col("pos2") - length_a)


def switch_order(scores: DataFrame) -> DataFrame:
    return scores.select(F.col("pos2").alias("pos1"), F.col("pos1").alias("pos2"), "score")


def saved_only(scores: DataFrame, rows: DataFrame, cols: DataFrame) -> DataFrame:
    """Labels that are saved columns (0-based ``pos``) of their chain."""
    a, b = rows.select((F.col("pos") + 1).alias("pos1")), cols.select((F.col("pos") + 1).alias("pos2"))
    return scores.join(a, "pos1", "left_semi").join(b, "pos2", "left_semi")


def positives(scores: DataFrame, threshold: float = 0.7, separation: int = 0) -> DataFrame:
    return scores.where((F.col("score") >= threshold) & (F.abs(F.col("pos1") - F.col("pos2")) >= separation))


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The k largest; ties keep row order."""
    if not isinstance(k, int) or isinstance(k, bool) or k <= 0:
        raise ValueError("k must be a positive integer")
    return scores.dropna(subset=["score"]).orderBy(F.desc("score"), "pos1", "pos2").limit(k)


def overlap(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    return top_k(a, k).select("pos1", "pos2").intersect(top_k(b, k).select("pos1", "pos2"))


def _value_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """(column, out): the rank of each value, ties averaged, from counts per value. Values are in ranges whose numbers are
    stored with them; the cumulative counts are within ranges, after those of the ranges before, and no task sorts all rows."""
    per = df.groupBy(column).agg(F.count("*").alias("_c"))
    part = stored(per.repartitionByRange(column).withColumn("_p", F.spark_partition_id()), "ranges")
    sums = part.groupBy("_p").agg(F.sum("_c").alias("_s"))  # a row per range
    before = sums.select("_p", (F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_s")).alias("_before"))
    within = F.sum("_c").over(Window.partitionBy("_p").orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
    return part.withColumn("_in", within).join(F.broadcast(before), "_p").select(column, (F.col("_before") + F.col("_in") - (F.col("_c") - 1) / 2).alias(out))


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """df with the rank of a column's value, ties averaged."""
    return df.join(_value_ranks(df, column, out), column)


def spearman(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n, rho) over the pairs that both have."""
    both = stored(a.select("pos1", "pos2", F.col("score").alias("x")).join(b.select("pos1", "pos2", F.col("score").alias("y")), ["pos1", "pos2"]), "scores")
    ranked = both.join(_value_ranks(both, "x", "rx"), "x").join(_value_ranks(both, "y", "ry"), "y")
    return ranked.agg(F.count("*").alias("n"), F.corr("rx", "ry").alias("rho"))


def spearman_p(rho: float, n: int) -> float:
    """Two-sided p by Student's t with n - 2 degrees, by numeric integration."""
    if n < 3:
        return float("nan")
    if abs(rho) >= 1:
        return 0.0
    v = n - 2
    t = abs(rho) * (v / (1 - rho * rho)) ** 0.5
    u = np.linspace(0, np.arctan(t / v**0.5), 200_001)  # the density in t = sqrt(v) tan(u) is cos(u)^(v - 1)
    whole = np.linspace(0, np.pi / 2, 200_001)
    return float(max(0.0, 1 - np.trapezoid(np.cos(u) ** (v - 1), u) / np.trapezoid(np.cos(whole) ** (v - 1), whole)))


def ecdf(scores: DataFrame) -> DataFrame:
    """(score, share of scores at most that)."""
    held = stored(scores.select("score"), "scores")
    counts = held.groupBy("score").agg(F.count("*").alias("_c"))
    n = held.agg(F.count("*").alias("_n"))
    got = _value_ranks(held, "score", "_r").join(counts, "score").crossJoin(F.broadcast(n))
    return got.select("score", ((F.col("_r") + (F.col("_c") - 1) / 2) / F.col("_n")).alias("share"))


def normalised(scores: DataFrame, neff: float, length: int) -> DataFrame:
    """score / |smallest score| / (1 + (neff / length) ** -0.5); an error without scores or if the smallest is 0."""
    low = scores.agg(F.min("score")).first()[0]
    if not low:
        raise ValueError("the smallest score is missing or zero")
    return scores.withColumn("score", F.col("score") / abs(low) / (1 + (neff / length) ** -0.5))


def raw_sum(scores: DataFrame) -> DataFrame:
    return scores.agg(F.sum(F.nanvl(F.col("score").cast("double"), F.lit(0.0))).alias("total"))


def positions(scores: DataFrame) -> DataFrame:
    """(pos): every label of a row or a column, once."""
    return scores.select(F.col("pos1").alias("pos")).union(scores.select(F.col("pos2").alias("pos"))).distinct()


def row_breaks(scores: DataFrame) -> DataFrame:
    """(pos1, pos2) of each row's first column, where the columns begin anew."""
    return scores.groupBy("pos1").agg(F.min("pos2").alias("pos2"))


def by_position(scores: DataFrame) -> DataFrame:
    return scores.orderBy("pos1", "pos2")


def half_precision(x):
    """x rounded to the nearest number of 11 binary digits, ties to even, as half-precision storage does: below 2^-14 to
    multiples of 2^-24, above 65504 without end."""
    exponent = F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-14)) - 10
    step = F.pow(F.lit(2.0), exponent)
    near = F.rint(x / step) * step
    return F.when(x == 0, F.lit(0.0)).when(F.abs(near) > 65504.0, F.signum(x) * F.lit(float("inf"))).otherwise(near)
