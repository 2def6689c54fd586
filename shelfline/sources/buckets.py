"""Tables stored in buckets on a key: rows with equal keys are in one file group, so sums per key
and joins of two tables with equally many buckets need no shuffle.

Bucketed tables are known to the session by name; ``attach`` gives a table that an earlier session
wrote its name again. A key's rows are read by one task, so this is for tables in which a key has a
bounded number of rows, like one per day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from shelfline.functions.dates import PARTITION, partition_of

ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 32_768  # above, buckets grow and their tasks spill
OPEN_FILES, MOST_OPEN_MONTHS = "spark.sql.maxConcurrentOutputFileWriters", 240


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Tasks write all their months, or their bucket, side by side; else they would sort their rows first."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(MOST_OPEN_MONTHS))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return min(MOST_BUCKETS, max(1, -(-rows // rows_per_bucket)))


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, day: str | None = None, dealt: bool = False) -> DataFrame:
    """``df`` written to ``path`` in ``buckets`` on ``key`` and read back; with ``day`` also
    partitioned by month. ``dealt`` says that ``df`` comes in that many hash partitions on the key
    already: every task then holds one bucket, and nothing is shuffled or sorted to write it."""
    rows = df if dealt else df.repartition(buckets, key)
    if day:
        rows = rows.withColumn(PARTITION, partition_of(day))
    writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, key).option("path", path)
    writer = writer if dealt else writer.sortBy(key)
    name = _new_name()
    with open_files(df.sparkSession) if dealt else nullcontext():
        (writer.partitionBy(PARTITION) if day else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def attach(spark: SparkSession, path: str, schema: str, key: str, buckets: int, monthly: bool = False) -> DataFrame:
    """The bucketed table at ``path``, with the columns of ``schema`` (without the month)."""
    name = _new_name()
    month = f", {PARTITION} STRING" if monthly else ""
    by = f"PARTITIONED BY ({PARTITION}) " if monthly else ""
    spark.sql(f"CREATE TABLE {name} ({schema}{month}) USING parquet {by}CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if monthly:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _new_name() -> str:
    return f"shelfline_{uuid.uuid4().hex}"
