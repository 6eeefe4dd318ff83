"""Tables that an operator writes and reads back, and what executors need to run the operators."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the folder of a table from ``stored`` that nothing reads any more."""
    spark: SparkSession = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def prepare(spark: SparkSession) -> None:
    """Name the place of this package to the Python workers, and keep Arrow batches small so that very long texts stay bounded in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
