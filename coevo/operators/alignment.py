"""Alignment cleaning, species pairing, sampling and sequence weights.

Rows are sequences: (row_idx, name, ox, codes) with one array of residue codes. Explosion to one row per
residue happens only inside aggregations that shrink it at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.residues import INVALID, gap_signs, gaps, half_even, invalid, matches
from ..sources.shared import stored

BLOCK = 1024


def drop_invalid(rows: DataFrame) -> DataFrame:
    """Rows without any invalid code; lower case is valid. Read from ``seq`` where the rows have it, before any code is made."""
    return rows.where(~invalid(F.col("seq")) if "seq" in rows.columns else F.array_max("codes") < INVALID)


def query_row(rows: DataFrame) -> DataFrame:
    """The one row with the smallest row_idx."""
    return rows.orderBy("row_idx").limit(1)


def keep_query_columns(rows: DataFrame) -> DataFrame:
    """Only the columns at which the query has no gap sign. A dot is a gap by its code, but no gap sign: rows with a ``seq``
    of the signs as read keep the columns of the query's dots. A query row is one array, so its broadcast is bounded by the width."""
    raw = "seq" in rows.columns
    sign = F.split("seq", "") if raw else F.col("codes")
    q = query_row(rows).select(sign.alias("_s")).select(F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda k: F.get(F.col("_s"), k) != F.lit("-" if raw else 0)).alias("_keep"))
    out = rows.crossJoin(F.broadcast(q)).withColumn("codes", F.transform("_keep", lambda k: F.get(F.col("codes"), k)))
    if raw:
        out = out.withColumn("seq", F.array_join(F.transform("_keep", lambda k: F.substr("seq", k + 1, F.lit(1))), ""))
    return out.drop("_keep")


def drop_gapped(rows: DataFrame, most: float) -> DataFrame:
    """Rows whose gap share is at most ``most`` (inclusive)."""
    share = gap_signs(F.col("seq")) / F.length("seq") if "seq" in rows.columns else gaps(F.col("codes")) / F.size("codes")
    return rows.where(share <= most)


def column_gaps(rows: DataFrame) -> DataFrame:
    """(pos from 0, gap_ratio) over all rows."""
    return rows.select(F.posexplode("codes").alias("pos", "code")).groupBy("pos").agg(F.avg((F.col("code") == 0).cast("double")).alias("gap_ratio"))


def column_mask(rows: DataFrame, below: float) -> DataFrame:
    """Columns whose gap share is below ``below`` (strict)."""
    return column_gaps(rows).where(F.col("gap_ratio") < below).select("pos")


def block_columns(mask: DataFrame, lengths: list[int], width: int | None = None) -> DataFrame:
    """Mask positions as (block, local position) of a concatenated alignment; one block if the lengths don't add up to its width."""
    if width is not None and sum(lengths) != width:
        lengths = [width]
    ends = np.cumsum(lengths).tolist()
    block, first = F.lit(len(lengths) - 1), F.lit(ends[-2] if len(ends) > 1 else 0)
    for k in range(len(ends) - 2, -1, -1):
        block = F.when(F.col("pos") < ends[k], F.lit(k)).otherwise(block)
        first = F.when(F.col("pos") < ends[k], F.lit(ends[k] - lengths[k])).otherwise(first)
    return mask.select(block.alias("block"), (F.col("pos") - first).alias("local_pos"))


def query_identity(rows: DataFrame, mask: DataFrame | None = None, rounded: bool = True) -> DataFrame:
    """rows with query_identity: columns outside the mask count as agreeing. The mask is one array of at most the width."""
    q = query_row(rows).select(F.col("codes").alias("_q"))
    if mask is None:
        kept = q.select("_q", F.sequence(F.lit(0), F.size("_q") - 1).alias("_m"))
    else:
        kept = q.crossJoin(mask.agg(F.sort_array(F.collect_list("pos")).alias("_m")))
    out = rows.crossJoin(F.broadcast(kept))
    pick = lambda c: F.transform("_m", lambda k: F.get(F.col(c), k))
    same = (matches(pick("codes"), pick("_q")) + F.size("codes") - F.size("_m")) / F.size("codes")
    return out.withColumn("query_identity", half_even(same, 3) if rounded else same).drop("_q", "_m")


def gap_filter(rows: DataFrame, row_keep: float, col_keep: float) -> tuple[DataFrame, DataFrame]:
    """(rows with query_identity, column mask): query columns, row filter, then column shares over the surviving rows."""
    kept = drop_gapped(keep_query_columns(rows), row_keep)
    mask = column_mask(kept, col_keep)
    return query_identity(kept, mask), mask


def best_per_species(rows: DataFrame) -> DataFrame:
    """The row of highest identity per ox; ties go to the first row; a null ox is dropped."""
    order = Window.partitionBy("ox").orderBy(F.desc("query_identity"), "row_idx")
    return rows.where("ox IS NOT NULL").withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def _one_hot(codes: np.ndarray) -> np.ndarray:
    """float32 rows whose products count the places at which two rows agree."""
    return (codes[:, :, None] == np.unique(codes)).reshape(len(codes), -1).astype(np.float32)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int8).reshape(len(flat), -1)


def closest(rows: DataFrame, others: DataFrame, mask: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(row_idx, identity): of each row the highest identity to any of the others, columns outside the mask counting as
    agreeing. Both sides go in blocks, each two blocks are one task that compares codes as matrices, and maxima leave it."""
    def masked(d: DataFrame) -> DataFrame:
        d = d.select("row_idx", "codes", F.size("codes").alias("width"))
        if mask is None:
            return d
        held = mask.agg(F.sort_array(F.collect_list("pos")).alias("_m"))
        return d.crossJoin(F.broadcast(held)).select("row_idx", F.transform("_m", lambda k: F.get(F.col("codes"), k)).alias("codes"), "width")

    sizes = rows.agg(F.ceil(F.count("*") / block).alias("_a")).crossJoin(others.agg(F.ceil(F.count("*") / block).alias("_b")))  # one row
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n) - 1, F.lit(0)).cast("long")))
    place = lambda n: F.pmod(F.xxhash64("row_idx"), F.greatest(F.col(n), F.lit(1)))
    left = masked(rows).crossJoin(F.broadcast(sizes)).withColumn("p", place("_a")).withColumn("q", up_to("_b")).withColumn("own", F.lit(True))
    right = masked(others).crossJoin(F.broadcast(sizes)).withColumn("q", place("_b")).withColumn("p", up_to("_a")).withColumn("own", F.lit(False))
    names = ["row_idx", "codes", "width", "p", "q", "own"]

    def compare(t: pa.Table) -> pa.Table:
        own = t.column("own").to_numpy()
        one = _one_hot(_codes(t.column("codes")))
        width = t.column("width").to_numpy()[own]
        if own.all() or not own.any():
            return pa.table({"row_idx": pa.array([], pa.int64()), "identity": pa.array([], pa.float64())})
        most = (one[own] @ one[~own].T).max(1)
        columns = len(t.column("codes")[0])
        return pa.table({"row_idx": t.column("row_idx").filter(pa.array(own)), "identity": pa.array((most + width - columns) / width)})

    pairs = left.select(*names).unionByName(right.select(*names)).groupBy("p", "q").applyInArrow(compare, "row_idx long, identity double")
    return pairs.groupBy("row_idx").agg(F.max("identity").alias("identity"))


def reciprocal_hits(rows: DataFrame, paralog_below: float = 0.9, margin: float = 0.02, mask: DataFrame | None = None) -> DataFrame:
    """Rows whose identity to the query is not beaten by that to any paralog of the query's species.

    rows has query_identity, name and ox; the mask is the one by which query_identity was taken, so that columns outside
    it count as agreeing on both sides. Unchanged if no other record has the query's name or no paralog
    qualifies. The query row always stays.
    """
    first = query_row(rows).select(F.substring_index("name", "/", 1).alias("_name"), F.col("row_idx").alias("_first"))
    named = rows.crossJoin(F.broadcast(first)).where("row_idx > _first AND contains(name, _name)")
    taxon = named.agg(F.min_by("ox", "row_idx").alias("_ox"))
    paralogs = rows.join(F.broadcast(taxon), F.col("ox") == F.col("_ox")).where(F.col("query_identity") < paralog_below)
    best = best_per_species(rows)
    near = closest(best, paralogs, mask).withColumnRenamed("identity", "paralog_identity")
    kept = best.select("row_idx", "query_identity").join(near, "row_idx").where(F.col("paralog_identity") < F.col("query_identity") + margin).select("row_idx")
    kept = kept.union(query_row(rows).select("row_idx")).distinct().withColumn("_kept", F.lit(True))
    some = paralogs.agg((F.count("*") > 0).alias("_some"))
    return rows.join(kept, "row_idx", "left").crossJoin(F.broadcast(some)).where("_kept OR NOT _some").drop("_kept", "_some")


def downsample(rows: DataFrame, to: int, seed: int = 42) -> DataFrame:
    """The query and to - 1 other rows in the order of a hash; unchanged if there are no more than ``to``."""
    order = F.md5(F.concat(F.lit(f"{seed}-"), F.col("row_idx").cast("string")))
    if rows.limit(to + 1).count() <= to:
        return rows
    q = query_row(rows)
    rest = rows.join(F.broadcast(q.select("row_idx")), "row_idx", "left_anti")
    return q.unionByName(rest.orderBy(order, "row_idx").limit(to - 1))


def _paired(a: DataFrame, b: DataFrame, one_each) -> DataFrame:
    side = lambda d, n: one_each(d.join(F.broadcast(query_row(d).select("row_idx")), "row_idx", "left_anti")).select("ox", F.col("codes").alias(n))
    both = side(a, "_a").join(side(b, "_b"), "ox").select("ox", F.concat("_a", "_b").alias("codes"))
    q = query_row(a).select(F.col("codes").alias("_a")).crossJoin(query_row(b).select(F.col("codes").alias("_b")))
    return q.select(F.lit(None).cast(dict(both.dtypes)["ox"]).alias("ox"), F.concat("_a", "_b").alias("codes")).unionByName(both)


def pair_species(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ox, codes): of each species in both the two rows of highest identity joined, and the two query rows (ox null)."""
    return _paired(a, b, best_per_species)


def pair_stored(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row_idx, ox, codes) of two stored alignments: of each species the row that stands first on each side, which is the
    one with most places equal to the query's. The query pair is row 0, the others follow by ascending ox."""
    first = lambda d: d.where("ox IS NOT NULL").withColumn("_k", F.row_number().over(Window.partitionBy("ox").orderBy("rank_in_species", "row_idx"))).where("_k = 1").drop("_k")
    both = _paired(a, b, first)
    # at most one row per species, and a species is an id of a fixed table: the numbering is one small task
    return both.select((F.row_number().over(Window.orderBy(F.asc_nulls_first("ox"))) - 1).alias("row_idx"), "ox", "codes")


def saved_columns(a: list[int], b: list[int], length_a: int) -> list[int]:
    """Saved columns of a concatenation, from 0."""
    return [*a, *(length_a + k for k in b)]


def alphabet_size(rows: DataFrame) -> DataFrame:
    """One row (q): the largest code and one."""
    return rows.agg((F.max(F.array_max("codes")) + 1).alias("q"))


def species_offsets(rows: DataFrame) -> DataFrame:
    """(ox, first, n) of rows that stand by species in the order of their first row: where each species begins."""
    sizes = rows.where("ox IS NOT NULL").groupBy("ox").agg(F.min("row_idx").alias("_f"), F.count("*").alias("n"))
    before = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)  # one row per species
    return sizes.select("ox", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n")


def common_species(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.where("ox IS NOT NULL").select("ox").intersect(b.where("ox IS NOT NULL").select("ox"))


def all_pairs(names: DataFrame, key: str) -> DataFrame:
    """Every unordered pair of keys with its name; the result is quadratic by definition."""
    a, b = names.select(F.col(key).alias("pid1")), names.select(F.col(key).alias("pid2"))
    return a.join(b, F.col("pid1") < F.col("pid2")).withColumn("name", F.concat_ws("-", "pid1", "pid2"))


def neighbour_counts(rows: DataFrame, tenths: int = 8, block: int = 2 * BLOCK) -> DataFrame:
    """(row_idx, n): rows that agree with each row at a share of tenths / 10 or more of the columns, itself included.

    Rows are dealt to blocks, and each pair of blocks is one task of bounded size that compares codes as
    matrices; only counts leave it.
    """
    size = rows.agg(F.greatest(F.ceil(F.count("*") / block), F.lit(1)).cast("long").alias("_n"))  # one row
    own = rows.select("row_idx", "codes").crossJoin(F.broadcast(size)).withColumn("i", F.pmod(F.xxhash64("row_idx"), F.col("_n")))
    dealt = own.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    dealt = dealt.select("row_idx", "codes", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), (F.col("i") > F.col("j")).alias("second"))

    def count(t: pa.Table) -> pa.Table:
        codes = _codes(t.column("codes"))
        one, width = _one_hot(codes), codes.shape[1]
        second = t.column("second").to_numpy()
        n = np.empty(len(codes), np.int64)
        if t.column("p")[0] == t.column("q")[0]:
            n[:] = (10 * (one @ one.T) >= tenths * width).sum(1)
        else:
            near = 10 * (one[~second] @ one[second].T) >= tenths * width
            n[~second], n[second] = near.sum(1), near.sum(0)
        return pa.table({"row_idx": t.column("row_idx"), "n": pa.array(n)})

    return dealt.groupBy("p", "q").applyInArrow(count, "row_idx long, n long").groupBy("row_idx").agg(F.sum("n").alias("n"))


def with_weights(rows: DataFrame, tenths: int = 8) -> DataFrame:
    """rows with weight 1 / number of near rows, stored: many measures begin with it."""
    rows = stored(rows, "rows")
    out = rows.join(neighbour_counts(rows, tenths).select("row_idx", (1 / F.col("n")).alias("weight")), "row_idx")
    return stored(out, "weighted")
