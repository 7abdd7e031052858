"""The whole way from alignment files to scored pairs: what the command line calls, one function per step."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.residues import INVALID, encode
from ..operators import alignment as A
from ..operators import fit
from ..sources import readers, writers
from ..sources.shared import stored

DEFAULTS = {
    "align": {"row_gap": 0.5, "column_gap": 0.5, "paralog_below": 0.9, "margin": 0.02},
    "couple": {"downsample": 30_000, "reweighting": {"enabled": True, "tenths": 8}, "column_gap": 0.5, "method": "plm"},
}


def align_protein(spark: SparkSession, source: str, target: str, options: dict | None = None, overwrite: bool = False) -> None:
    """An alignment file, cleaned and without paralogs, stored with its saved columns."""
    o = readers.merged_config(DEFAULTS["align"], options or {})
    rows = readers.alignment(spark, source).select("row_idx", "name", "ox", "seq").withColumn("codes", encode(F.col("seq")))
    rows, mask = A.gap_filter(stored(A.drop_invalid(rows), "read"), o["row_gap"], o["column_gap"])
    rows, mask = stored(rows, "rows"), stored(mask, "mask")
    kept = A.reciprocal_hits(rows, o["paralog_below"], o["margin"], mask).drop("seq")
    width = rows.select(F.size("codes")).first()
    if width is None:
        raise ValueError(f"no row of {source} is left")
    writers.alignment(kept, target, overwrite, [width[0]], sorted(r.pos for r in mask.collect()))  # at most the width


def couple_pair(spark: SparkSession, first: str, second: str, target: str, name: str, options: dict | None = None) -> DataFrame:
    """Scores of two stored alignments, paired by species; written to the target's folder of the pair and returned."""
    o = readers.merged_config(DEFAULTS["couple"], options or {})
    (a, _), (b, _) = (readers.stored_alignment(spark, p) for p in (first, second))
    rows = A.downsample(stored(A.pair_stored(a, b), "paired"), o["downsample"])
    weighing = o["reweighting"]
    rows = A.with_weights(rows, weighing["tenths"]) if weighing["enabled"] else rows.withColumn("weight", F.lit(1.0))
    wrong = rows.where((F.array_min("codes") < 0) | (F.array_max("codes") >= INVALID))
    if not wrong.isEmpty():
        raise ValueError("lower-case or invalid residues can't be fitted")
    scores = fit.SCORERS[o["method"]](rows.withColumn("pair", F.lit(name)).select("pair", "codes", "weight"))
    writers.scores(scores, target)
    return readers.stored_scores(spark, target, name)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="coevo", description="Sequence co-evolution on Spark")
    steps = parser.add_subparsers(dest="step", required=True)
    one = steps.add_parser("align", help="clean one alignment file")
    two = steps.add_parser("couple", help="score two stored alignments")
    for p, names in ((one, ("source", "target")), (two, ("first", "second", "target", "name"))):
        for n in names:
            p.add_argument(n)
        p.add_argument("--config", action="append", default=[], help="YAML files, later ones over earlier ones")
    one.add_argument("--overwrite", action="store_true")
    given = parser.parse_args(arguments)
    options = readers.yaml_config(*given.config).get(given.step, {})
    spark = SparkSession.builder.appName("coevo").getOrCreate()
    if given.step == "align":
        align_protein(spark, given.source, given.target, options, given.overwrite)
    else:
        couple_pair(spark, given.first, given.second, given.target, given.name, options)
    return 0
