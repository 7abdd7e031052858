"""Writers."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.residues import decode, matches


def alignment(rows: DataFrame, path: str, overwrite: bool = False, lengths: list[int] | None = None, saved_columns: list[int] | None = None) -> None:
    """<path>/rows: one row per sequence, grouped by species: in each the row with most places equal to the query's first,
    then file order. Rows without ox go, but for the query, which is row 0. A weight column is kept. <path>/meta: one JSON
    line with lengths of the joined alignments, saved columns, and beff, the sum of the weights."""
    spark = rows.sparkSession
    q = rows.orderBy("row_idx").limit(1).select(F.col("codes").alias("_q"), F.col("row_idx").alias("_first"))
    m = rows.crossJoin(F.broadcast(q)).withColumn("query_matches", matches(F.col("codes"), F.col("_q"))).withColumn("is_query", F.col("row_idx") == F.col("_first")).drop("_q", "_first")
    m = m.where("is_query OR ox IS NOT NULL")
    best = F.row_number().over(Window.partitionBy("is_query", "ox").orderBy(F.desc("query_matches"), "row_idx")) == 1
    rank = F.row_number().over(Window.partitionBy("is_query", "ox").orderBy(F.desc("_best"), "row_idx"))
    mode = "overwrite" if overwrite else "errorifexists"
    m.withColumn("_best", best).withColumn("rank_in_species", rank).drop("_best").write.mode(mode).parquet(f"{path}/rows")
    beff = spark.read.parquet(f"{path}/rows").agg(F.sum("weight")).first()[0] if "weight" in rows.columns else None
    meta = [(lengths, saved_columns, beff)]
    spark.createDataFrame(meta, "lengths array<int>, saved_columns array<int>, beff double").write.mode(mode).json(f"{path}/meta")


def with_gaps(rows: DataFrame, saved_columns: list[int], width: int) -> DataFrame:
    """rows of the saved columns only, at their places in ``width`` columns, all others gaps."""
    place = F.array(*[F.lit(saved_columns.index(k) if k in saved_columns else -1) for k in range(width)])
    return rows.withColumn("codes", F.transform(place, lambda k: F.when(k < 0, F.lit(0)).otherwise(F.get(F.col("codes"), k))))


def fasta(rows: DataFrame, path: str, saved_columns: list[int] | None = None, width: int | None = None) -> None:
    """FASTA records in row order; a description that the readers find again. With saved_columns and width, gaps are restored."""
    rows = rows if saved_columns is None else with_gaps(rows, saved_columns, width)
    line = F.concat(F.lit(">"), F.col("row_idx").cast("string"), F.when(F.col("ox").isNotNull(), F.concat(F.lit(" OS=- OX="), F.col("ox").cast("string"))).otherwise(""), F.lit("\n"), decode(F.col("codes")))
    rows.repartitionByRange("row_idx").sortWithinPartitions("row_idx").select(line.alias("value")).write.text(path)


def codes_npy(rows: DataFrame, path: str) -> None:
    """The codes of one alignment as an int8 matrix in row order; an alignment that one process fits anyway."""
    table = rows.orderBy("row_idx").select("codes").toArrow()
    np.save(path, np.array(table.column("codes").to_pylist(), np.int8))


def scores(df: DataFrame, path: str) -> None:
    """Scores of many pairs, in folders by two bytes of the name's hash; a rerun replaces the folders it writes."""
    h = F.sha2("pair", 256)
    out = df.withColumn("h1", F.substring(h, 1, 2)).withColumn("h2", F.substring(h, 3, 2)).repartition("h1", "h2")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("h1", "h2").parquet(path)


def npy(scores_of_pair: DataFrame, path: str) -> None:
    """One pair's square matrix; its size is the alignment's width, squared."""
    rows = scores_of_pair.select("pos1", "pos2", "score").collect()
    n = max((max(r.pos1, r.pos2) for r in rows), default=0)
    m = np.zeros((n, n), np.float64)
    for r in rows:
        m[r.pos1 - 1, r.pos2 - 1] = r.score
    np.save(path, m)


def flat_binary(codes: np.ndarray, weights: np.ndarray, directory: str, q: int = 21) -> None:
    os.makedirs(directory, exist_ok=True)
    with open(f"{directory}/meta.bin", "wb") as f:
        f.write(np.array([*codes.shape, q], "<i4").tobytes() + np.array([weights.sum()], "<f8").tobytes())
    codes.astype("<i4").tofile(f"{directory}/msa.bin")
    weights.astype("<f8").tofile(f"{directory}/weights.bin")


def append_events(events: DataFrame, path: str) -> None:
    """Job events; ``operators.jobs.latest`` reads them back as states."""
    events.write.mode("append").parquet(path)


def project_config(path: str, values: dict, overwrite: bool = False) -> None:
    import yaml

    if os.path.exists(path) and not overwrite:
        raise FileExistsError(path)
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(values, f, sort_keys=False)


class ResultBuffer:
    """Collects results of tasks on the driver and appends them as one file when there are ``most`` of them or the oldest
    has waited ``seconds``; a with block flushes the rest."""

    def __init__(self, spark, path: str, schema: str, most: int = 64, seconds: float = 300.0, clock=None):
        import time

        self.spark, self.path, self.schema, self.most, self.seconds = spark, path, schema, most, seconds
        self.clock, self.rows, self.since = clock or time.monotonic, [], None

    def add(self, *row) -> None:
        self.since = self.clock() if self.since is None else self.since
        self.rows.append(row)
        if len(self.rows) >= self.most or self.clock() - self.since >= self.seconds:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            append_events(self.spark.createDataFrame(self.rows, self.schema).coalesce(1), self.path)
        self.rows, self.since = [], None

    def __enter__(self):
        return self

    def __exit__(self, *error) -> None:
        self.flush()


def submit_script(path: str, command: str, directives: dict[str, str] | None = None, modules: list[str] | None = None) -> None:
    """A shell script for a batch scheduler: header, directives, modules, command."""
    lines = ["#!/bin/bash", *(f"#SBATCH --{k}={v}" for k, v in (directives or {}).items()), *(f"module load {m}" for m in modules or []), command, ""]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
