"""Readers: each returns a DataFrame with a fixed schema."""

from __future__ import annotations

import io
import os
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.residues import describe


def require(spark: SparkSession, path: str) -> str:
    """path, which must exist (a glob must match something)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    if not found:
        raise FileNotFoundError(path)
    return path


def _checked(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    if rows.isEmpty():
        raise ValueError(f"no sequences in {path}")
    return rows


def record(spark: SparkSession, name: str, seq: str, description: str | None = None) -> DataFrame:
    """An alignment of one record, with the columns of ``alignment``."""
    row = [("", 0, name, name, description or name, seq)]
    df = spark.createDataFrame(row, "aln_id string, row_idx int, id string, name string, description string, seq string")
    return df.withColumn("_d", describe(F.col("description"))).select("*", "_d.*").drop("_d")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(aln_id, row_idx, id, name, description, seq) of FASTA or A2M files; file order gives row_idx."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("aln_id"), F.concat(F.lit("\n"), F.regexp_replace("value", "\r", "")).alias("v"))
    parts = text.select("aln_id", F.posexplode(F.split("v", "\n>")).alias("k", "r")).where("k > 0")
    head = F.substring_index("r", "\n", 1)
    body = F.regexp_replace(F.expr("substring(r, length(substring_index(r, '\n', 1)) + 1)"), r"\s", "")
    name = F.regexp_extract(head, r"^(\S*)", 1)
    return parts.select("aln_id", (F.col("k") - 1).alias("row_idx"), name.alias("id"), name.alias("name"), head.alias("description"), body.alias("seq"))


def stockholm(spark: SparkSession, path: str) -> DataFrame:
    """Same columns from Stockholm files: blocks are joined per name, #=GS name DE lines give the description."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("aln_id"), "value")
    lines = text.select("aln_id", F.posexplode(F.split("value", "\r?\n")).alias("k", "line"))
    named = r"^#=GS\s+(\S+)\s+DE\s+(.*)$"
    notes = lines.where(F.col("line").rlike(named)).select("aln_id", F.regexp_extract("line", named, 1).alias("name"), F.regexp_extract("line", named, 2).alias("note")).groupBy("aln_id", "name").agg(F.first("note").alias("note"))
    rows = lines.where("line <> '' AND NOT startswith(line, '#') AND NOT startswith(line, '//')").select("aln_id", "k", F.split("line", r"\s+").alias("p"))
    whole = rows.groupBy("aln_id", F.col("p")[0].alias("name")).agg(F.min("k").alias("k"), F.sort_array(F.collect_list(F.struct("k", F.col("p")[1].alias("s")))).alias("b"))
    seqs = whole.select("aln_id", "name", "k", F.array_join(F.col("b.s"), "").alias("seq")).join(notes, ["aln_id", "name"], "left")
    order = F.row_number().over(Window.partitionBy("aln_id").orderBy("k")) - 1
    return seqs.select("aln_id", order.alias("row_idx"), F.col("name").alias("id"), "name", F.concat_ws(" ", "name", "note").alias("description"), "seq")


def alignment(spark: SparkSession, path: str) -> DataFrame:
    """By extension; description parts as columns os, ox, gn, pe, sv."""
    ext = os.path.splitext(path)[1].lower()
    if ext != ".sto" and ext != ".a2m" and not ext.startswith(".fa"):
        raise NotImplementedError(f"no reader for {ext or path}")
    require(spark, path)
    if ext == ".sto":
        rows = stockholm(spark, path)
    else:
        rows = fasta(spark, path)
    return _checked(spark, rows.withColumn("_d", describe(F.col("description"))).select("*", "_d.*").drop("_d"), path)


def swissprot(spark: SparkSession, path: str) -> DataFrame:
    """(id, accession, ox, seq) of flat files."""
    v = F.col("value")
    entry = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?m)^//\s*$")).alias("value")).where(v.rlike(r"(?m)^ID\s"))
    return entry.select(
        F.regexp_extract(v, r"(?m)^ID\s+(\S+)", 1).alias("id"), F.regexp_extract(v, r"(?m)^AC\s+([^;]+);", 1).alias("accession"),
        F.regexp_extract(v, r"(?m)^OX\s+NCBI_TaxID=(\d+)", 1).try_cast("int").alias("ox"),
        F.regexp_replace(F.regexp_extract(v, r"(?ms)^SQ [^\n]*\n(.*)$", 1), r"\s", "").alias("seq"))


def _flat_sequence(value):
    return F.regexp_replace(F.regexp_extract(value, r"(?ms)^SQ [^\n]*\n(.*?)(?:^//|\z)", 1), r"\s", "")


def fetch_local(pids: DataFrame, directory: str) -> DataFrame:
    """(pid, status, seq) per id from <directory>/<pid>.txt, read by Spark: -1 where it is there, 4 where not."""
    spark = pids.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(directory)  # a folder without any is fine
    seen = files.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("pid"), F.col("content").cast("string").alias("value"))
    return pids.join(seen.select("pid", _flat_sequence("value").alias("seq")), "pid", "left").select("pid", F.when(F.col("seq").isNull(), 4).otherwise(-1).alias("status"), "seq")


def fetch(pids: DataFrame, load: Callable[[str], str], tasks: int = 4) -> DataFrame:
    """(pid, status, seq, error) by a function from id to flat-file text, called in ``tasks`` parallel tasks: -1 where it
    gave a sequence, 4 where it failed. A lost task is run again, so the function must bear repeated calls."""

    def run(batches):
        for batch in batches:
            ids, texts, errors = batch.column(0).to_pylist(), [], []
            for pid in ids:
                try:
                    texts.append(load(pid))
                    errors.append(None)
                except Exception as e:  # whatever the connector raises is that id's state
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["pid", "value", "error"])

    got = pids.select(F.col("pid").cast("string")).repartition(tasks, "pid").mapInArrow(run, "pid string, value string, error string")
    seq = F.nullif(_flat_sequence("value"), F.lit(""))
    return got.select("pid", F.when(seq.isNull(), 4).otherwise(-1).alias("status"), seq.alias("seq"), "error")


def search(pids: DataFrame, command: list[str], tasks: int = 4) -> DataFrame:
    """(pid, seconds) after running an external homologue search per protein: ``{pid}`` in the command's words is replaced by
    the id. A command that fails ends the job with its message; its files are then read by ``alignment``."""

    def run(batches):
        import subprocess
        import time

        for batch in batches:
            took = []
            for pid in batch.column(0).to_pylist():
                start = time.time()
                done = subprocess.run([w.replace("{pid}", pid) for w in command], capture_output=True, text=True, check=False)
                if done.returncode:
                    raise RuntimeError(f"search for {pid} ended with {done.returncode}: {done.stderr[-500:]}")
                took.append(time.time() - start)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(took, pa.float64())], names=["pid", "seconds"])

    return pids.select(F.col("pid").cast("string")).repartition(tasks, "pid").mapInArrow(run, "pid string, seconds double")


def coupling_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True)
    missing = {"res1", "res2", "score"} - set(df.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    return df.select(F.col("res1").cast("int").alias("pos1"), F.col("res2").cast("int").alias("pos2"), F.col("score").try_cast("double").alias("score"))


def coupling_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``pos1 aa1 pos2 aa2 number score``."""
    p = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("trim(value) <> ''").select(p.alias("p"))
    return rows.select(F.get("p", 0).cast("int").alias("pos1"), F.get("p", 2).cast("int").alias("pos2"), F.get("p", 5).cast("double").alias("score"))


def _matrices(spark: SparkSession, path: str, load) -> DataFrame:
    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                m = load(content)
                for a in range(0, len(m), 64):
                    i, j = np.indices(m[a:a + 64].shape)
                    yield pa.RecordBatch.from_arrays([pa.array((i + a).ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(m[a:a + 64].ravel().astype(float))], names=["pos1", "pos2", "score"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "pos1 int, pos2 int, score double")


def npy(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a square matrix, labels from 0."""
    return _matrices(spark, path, lambda b: np.load(io.BytesIO(b), allow_pickle=False))


def couplings(spark: SparkSession, source) -> DataFrame:
    """Scores by file type, or from a pandas frame or array in memory."""
    from ..operators.couplings import mirror_upper, one_based

    if isinstance(source, np.ndarray):
        i, j = np.indices(source.shape)
        return one_based(spark.createDataFrame(list(zip(i.ravel().tolist(), j.ravel().tolist(), source.ravel().astype(float).tolist())), "pos1 int, pos2 int, score double"))
    if isinstance(source, pd.DataFrame):
        named = source.rename(columns={"res1": "pos1", "res2": "pos2"})[["pos1", "pos2", "score"]]
        return one_based(spark.createDataFrame(named.astype({"pos1": "int32", "pos2": "int32", "score": "float64"})))
    if isinstance(source, DataFrame):
        return one_based(source)
    ext = os.path.splitext(str(source))[1].lower()
    if ext == ".csv":
        return mirror_upper(one_based(coupling_csv(spark, source)))
    if ext == ".npy":
        return one_based(npy(spark, source))
    if ext == ".txt":
        return mirror_upper(one_based(coupling_text(spark, source)))
    if ext == ".parquet":
        return spark.read.parquet(source)
    raise NotImplementedError(f"no reader for {ext or source}")


def protein_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("pid")).where("pid <> ''")


def pair_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="pid1 string, pid2 string", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).dropna()


AMINO = "ALA ARG ASN ASP CYS GLN GLU GLY HIS ILE LEU LYS MET PHE PRO SER THR TRP TYR VAL MSE".split()


def atoms(spark: SparkSession, path: str, chain: str | None = None) -> DataFrame:
    """(chain, res, icode, atom, x, y, z) of the peptide residues in PDB files: the first model, and of an atom's alternate
    places the first. icode is the insertion code, empty mostly."""
    v = F.col("line")
    cut = lambda a, n: F.trim(F.substring(v, a, n))
    model = F.substring_index("value", "\nENDMDL", 1)
    lines = spark.read.text(require(spark, path), wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split(model, "\r?\n")).alias("k", "line"))
    rows = lines.where((cut(1, 6) == "ATOM") | ((cut(1, 6) == "HETATM") & (cut(18, 3) == "MSE"))).where(cut(18, 3).isin(AMINO))
    rows = rows.select("file", "k", F.substring(v, 22, 1).alias("chain"), cut(23, 4).cast("int").alias("res"), cut(27, 1).alias("icode"), cut(13, 4).alias("atom"), *[cut(a, 8).cast("double").alias(n) for a, n in ((31, "x"), (39, "y"), (47, "z"))])
    rows = rows if chain is None else rows.where(F.col("chain") == chain)
    place = F.min_by(F.struct("x", "y", "z"), "k")
    return rows.groupBy("file", "chain", "res", "icode", "atom").agg(place.alias("p")).select("chain", "res", "icode", "atom", "p.*")


def stored_alignment(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(rows, meta) as ``writers.alignment`` stored them: rows in query-first, best-of-species-first order by
    ``rank_in_species``, with weight where it was known; meta has lengths, saved_columns and beff."""
    require(spark, f"{path}/rows")
    meta = spark.read.json(require(spark, f"{path}/meta"), schema="lengths array<int>, saved_columns array<int>, beff double").first()
    return spark.read.parquet(f"{path}/rows"), meta.asDict()


def stored_scores(spark: SparkSession, path: str, pair: str | None = None) -> DataFrame:
    """Scores of all pairs, or of one, for which only the folder of its name's hash is read."""
    df = spark.read.parquet(require(spark, path))
    if pair is not None:
        h = sha256(pair.encode()).hexdigest()
        df = df.where((F.col("h1") == h[:2]) & (F.col("h2") == h[2:4]) & (F.col("pair") == pair))
    return df.drop("h1", "h2")


def flat_binary(spark: SparkSession, directory: str) -> DataFrame:
    """(row_idx, codes, weight) of meta.bin (three int32, one double), msa.bin (int32) and weights.bin (double)."""
    files = {k: spark.read.format("binaryFile").load(f"{directory}/{k}.bin").select(F.col("content").alias(k)) for k in ("meta", "msa", "weights")}

    def run(batches):
        for batch in batches:
            for meta, msa, weights in zip(*[c.to_pylist() for c in batch.columns]):
                b, n, _ = np.frombuffer(meta, "<i4", 3)
                codes = np.frombuffer(msa, "<i4").reshape(b, n)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(b)), pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(np.frombuffer(weights, "<f8"))], names=["row_idx", "codes", "weight"])

    one = files["meta"].crossJoin(files["msa"]).crossJoin(files["weights"])  # one row each
    return one.mapInArrow(run, "row_idx long, codes array<int>, weight double")


def jobs_jdbc(spark: SparkSession, url: str, name: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def merged_config(base: dict, over: dict) -> dict:
    """over wins, mapping by mapping."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def yaml_config(*paths: str) -> dict:
    """The merged mappings of the files, later ones over earlier ones."""
    import yaml

    out: dict = {}
    for p in paths:
        with open(p if p.endswith((".yml", ".yaml")) else f"{p}.yml", encoding="utf-8") as f:
            got = yaml.safe_load(f) or {}
        if not isinstance(got, dict):
            raise ValueError(f"{p} is no mapping")
        out = merged_config(out, got)
    return out
