"""Daily CSV of a stream of calls: one folder per day, and files that a replay replaces.

    path/call_date=20240101/batch_id=7/part-...csv
    path/_batches/batch_id=7                        written last: the batch is complete

A batch writes below its own ``batch_id`` in every day that it has calls of. A replayed batch first deletes what an
earlier attempt left in any day, so nothing is doubled, also if the attempt had got further. Readers take
the files of complete batches only.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardlens.sinks.changelog import _delete, _glob, _number
from wardlens.streaming.topology import refuse_foreign, start_batches


def call_day(timestamp: Column) -> Column:
    """Day of a timestamp's text as yyyyMMdd; null if it can't be read."""
    return F.date_format(F.substring(timestamp, 1, 10).try_cast("date"), "yyyyMMdd")


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(_number(folder, "batch_id") for folder in _glob(spark, f"{path}/_batches/batch_id=*"))


def _mark_complete(spark: SparkSession, path: str, batch_id: int) -> None:
    context = spark.sparkContext
    marker = context._jvm.org.apache.hadoop.fs.Path(f"{path}/_batches/batch_id={batch_id}")
    marker.getFileSystem(context._jsc.hadoopConfiguration()).create(marker, True).close()


def write_daily_batch(flat_calls: DataFrame, batch_id: int, path: str) -> None:
    """``foreachBatch`` writer of flat calls; a replay of the batch leaves what one run leaves."""
    spark = flat_calls.sparkSession
    _delete(spark, f"{path}/_batches/batch_id={batch_id}")
    for folder in _glob(spark, f"{path}/call_date=*/batch_id={batch_id}"):
        _delete(spark, folder)
    dated = flat_calls.withColumns({"call_date": call_day(F.col("timestamp")), "batch_id": F.lit(batch_id)})
    dated.write.mode("append").partitionBy("call_date", "batch_id").option("header", True).csv(path)
    _mark_complete(spark, path, batch_id)


def read_daily_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Calls of complete batches with ``call_date`` and ``batch_id``; unreadable days have null."""
    full = T.StructType([*schema.fields, T.StructField("call_date", T.StringType()), T.StructField("batch_id", T.LongType())])
    done = complete_batches(spark, path)
    rows = spark.read.schema(full).option("header", True).option("recursiveFileLookup", False).csv(path)
    return rows.filter(F.col("batch_id").isin(done)) if done else rows.limit(0)


def start_daily_csv(flat_calls: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream of flat calls to daily CSV folders as they arrive."""
    refuse_foreign(flat_calls, path, checkpoint)
    return start_batches(flat_calls, partial(write_daily_batch, path=path), "daily_csv", checkpoint, "append",
                         trigger or {"processingTime": "5 seconds"})
