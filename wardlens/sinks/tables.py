"""Batch writers of the lake's zones."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.sources.lake import Lake

#: Years whose files a task of an unshuffled write holds open, and bytes that each of them buffers at most.
OPEN_YEARS, ROW_GROUP = 32, 16 * 1024 * 1024
#: Parquet of the batch run. Ids hardly repeat, so that a dictionary of them is built in vain.
PARQUET = {"compression": "zstd", "parquet.enable.dictionary#id": "false"}


def with_audit(df: DataFrame) -> DataFrame:
    return df.withColumn("indexed_at", F.current_timestamp())


@contextmanager
def _open_writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Tasks keep so many partitions' files open while they write, and only sort what goes beyond."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_silver(incidents: DataFrame, lake: Lake, rebalance: bool = True) -> None:
    """Cleaned incidents as Parquet, one folder per year of occurrence.

    ``rebalance`` shuffles once into files of the advisory partition size; adaptive execution
    splits a year that holds much of the data over many tasks. Without it, every input task writes
    its own files, a file per year: whole incidents are neither shuffled nor sorted, and nothing spills.
    """
    if rebalance:
        incidents.hint("rebalance", "occurrence_year").write.mode("overwrite").partitionBy("occurrence_year").parquet(lake.silver)
        return
    with _open_writers(incidents.sparkSession, OPEN_YEARS):
        (incidents.write.mode("overwrite").partitionBy("occurrence_year")
         .option("parquet.block.size", ROW_GROUP).options(**PARQUET).parquet(lake.silver))


def write_metrics(df: DataFrame, lake: Lake, name: str) -> None:
    df.write.mode("overwrite").options(**PARQUET).parquet(lake.metrics(name))


def write_gold(df: DataFrame, lake: Lake, name: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a gold collection: a folder, or a connector's collection with ``options``.

    Parquet is compressed by zstd, unless ``options`` name another ``compression``.
    """
    if fmt == "parquet":
        options = PARQUET | options
    writer = with_audit(df).write.format(fmt).mode("overwrite").options(**options)
    if fmt in ("parquet", "orc", "json", "csv"):
        writer.save(lake.gold(name))
    else:
        writer.option("collection", name).save()


def write_daily_csv(flat_calls: DataFrame, path: str) -> None:
    """Append flat calls as CSV, one folder per day of their timestamp; unreadable days share one."""
    day = F.date_format(F.substring("timestamp", 1, 10).try_cast("date"), "yyyyMMdd")
    (flat_calls.withColumn("call_date", day)
     .write.mode("append").partitionBy("call_date").option("header", True).csv(path))
