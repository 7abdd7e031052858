"""Tables in the folder that all executors share: they cut lineage, survive lost executors and are computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local folder only where that is unset and the master is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="coevo-")
    return _OWN_DIR[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/coevo-tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_tables(spark: SparkSession) -> None:
    """Delete this application's stored tables, when no DataFrame needs them any more."""
    jvm, root = spark.sparkContext._jvm, f"{shared_dir(spark)}/coevo-tables/{spark.sparkContext.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
