"""Alignments, structures and job rows made from the test tables by the same rule in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.residues import ALPHABET, encode

SRC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ \n"
DST = "ANCDEFGHILKLMNQPQRSTCVWAYQ" * 2 + "--"
#: Width and species rule of each proxy alignment. A whole text becomes consecutive rows of that width, the last one filled up.
SHAPE = {"a": (48, 1, 97), "b": (32, 7, 101)}
#: Row number of a text's k-th row: doc_id times this, and k.
STEP = 1_000_000
SPLIT = 24  # columns of chain A in alignment a
SCALE, CUTOFF = 500.0, 8.0
#: Where the atoms of a residue begin in its vector of 64 elements.
ATOMS = [*range(0, 63, 3), 61]
#: Sequences that go into weights and fits, as in the reference's own configuration: more are sampled down.
SAMPLE = 30_000


def sequences(spark: SparkSession, sf_dir: str, which: str = "a") -> DataFrame:
    width, times, species = SHAPE[which]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.translate(F.coalesce("text", F.lit("")), SRC, DST).alias("t"))
    pieces = F.regexp_extract_all("t", F.lit(f"(?s).{{1,{width}}}"), F.lit(0))  # one walk over the text
    rows = docs.select("doc_id", F.posexplode_outer(pieces).alias("k", "piece"))
    rows = rows.select("doc_id", (F.col("doc_id") * STEP + F.coalesce("k", F.lit(0))).alias("row_idx"), F.rpad(F.coalesce("piece", F.lit("")), width, "-").alias("seq"))
    name = F.concat(F.lit("prot"), (F.col("doc_id") % 7).cast("string"), F.lit("/"), F.col("row_idx").cast("string"))
    return rows.select("row_idx", name.alias("name"), (F.col("doc_id") * times % species).alias("ox"), "seq")


def alignment(spark: SparkSession, sf_dir: str, which: str = "a") -> DataFrame:
    return sequences(spark, sf_dir, which).withColumn("codes", encode(F.col("seq")))


def clean(spark: SparkSession, sf_dir: str, which: str = "a") -> DataFrame:
    """Rows without invalid codes and with at most half gaps."""
    from ..operators.alignment import drop_gapped, drop_invalid

    return drop_gapped(drop_invalid(alignment(spark, sf_dir, which)), 0.5)


def atoms(spark: SparkSession, sf_dir: str, chain: int) -> DataFrame:
    """The atoms of one chain: vectors with even ids are chain 0, with odd ids chain 1, and residues count from 1 in id order.
    Every element is a coordinate: three in turn make an atom, and the last three once more, as 64 is no multiple of three."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("vec_id") % 2 == chain)
    place = lambda k: F.struct(*[(F.col("embedding")[k + i].cast("double") * SCALE).alias(n) for i, n in enumerate("xyz")])
    return rows.select((F.floor(F.col("vec_id") / 2) + 1).cast("int").alias("res"), F.explode(F.array(*map(place, ATOMS))).alias("at")).select("res", "at.*")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", -1).otherwise(0)
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("pid"), status.alias("status"), F.lit(None).cast("string").alias("job_id"), F.lit(None).cast("double").alias("claimed_at"))


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 3 == 0, 3).otherwise(1)
    owner = F.concat(F.lit("job"), (F.col("o_custkey") % 10).cast("string"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), status.alias("status"), owner.alias("job_id"), F.lit(1.0).alias("claimed_at"))


def sql_alignment(which: str = "a") -> str:
    """CTEs seq_, msa_ (long form, pos from 1) and ok_ (ids of clean rows) of a proxy alignment."""
    width, times, species = SHAPE[which]
    return f"""
text_{which} AS (SELECT doc_id, translate(coalesce(text, ''), '{SRC}', '{DST}') AS t FROM documents),
cut_{which} AS (SELECT doc_id, t, unnest(range(0, greatest(1, CAST(ceil(length(t) / {width}) AS BIGINT)))) AS k FROM text_{which}),
seq_{which} AS (SELECT doc_id * {STEP} + k AS row_idx, doc_id * {times} % {species} AS ox,
  'prot' || (doc_id % 7) || '/' || (doc_id * {STEP} + k) AS name,
  rpad(substr(t, k * {width} + 1, {width}), {width}, '-') AS seq FROM cut_{which}),
msa_{which} AS (SELECT row_idx, ox, name, pos, substr(seq, pos, 1) AS raw,
  CASE WHEN substr(seq, pos, 1) = '.' THEN 0 WHEN instr('{ALPHABET}', substr(seq, pos, 1)) = 0 THEN 21
  ELSE instr('{ALPHABET}', substr(seq, pos, 1)) - 21 END AS code
  FROM seq_{which}, (SELECT CAST(range AS INTEGER) AS pos FROM range(1, {width + 1}))),
ok_{which} AS MATERIALIZED (SELECT row_idx, ox, name FROM msa_{which} GROUP BY ALL
  HAVING max(code) <= 20 AND 2 * count(*) FILTER (code = 0) <= {width}),
clean_{which} AS MATERIALIZED (SELECT m.* FROM msa_{which} m JOIN ok_{which} USING (row_idx)),
used_{which} AS MATERIALIZED (SELECT row_idx, translate(seq, '.', '-') AS seq FROM seq_{which} JOIN ok_{which} USING (row_idx)
  ORDER BY row_idx <> (SELECT min(row_idx) FROM ok_{which}), md5('42-' || row_idx), row_idx LIMIT {SAMPLE})"""
