"""Alignments that arrive over time: each micro-batch is worked once, finished keys are skipped on restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_arrivals(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "pair", seconds: int = 300, once: bool = False):
    """Start a query that applies ``work`` to new rows and appends its result to ``target``, without keys
    that are there; of rows that share a key in a micro-batch one is worked."""

    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batch(df: DataFrame, number: int) -> None:
        df = df.dropDuplicates([key])
        if files.exists(where):
            df = df.join(spark.read.parquet(target).select(key).distinct(), key, "left_anti")
        work(df).write.mode("append").parquet(target)

    writer = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")).start()
