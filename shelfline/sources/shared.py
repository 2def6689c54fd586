"""The folder that all executors can read and write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or by ``setCheckpointDir``.

    There is no default: a folder chosen here would be one machine's own, and the other machines
    could not read it.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getConf().get(SETTING) or context.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that a lost executor costs a
    read and not a recomputation. Parquet, so later steps read only the columns they use."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``store`` wrote, once nothing reads them any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
