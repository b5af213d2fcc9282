"""Keyed changelog that streams upsert into, with an incremental, bucketed base.

A changelog is a folder with one ``batch_id=N`` folder per micro-batch. ``compact_log`` keeps a base beside
it: the rows of each key, dealt over hash buckets of the key. A compaction reads the batches since the last one
and rewrites only the buckets in which their keys lie; the other buckets stay where an earlier compaction
wrote them. Readers take the newest version of every bucket and the batches after it; ``expire_log`` deletes
what no reader needs any more.

    path/batch_id=7/...
    path.base/buckets=64/upto=6/bucket=3/...      complete once upto=6 has its _SUCCESS

Rows are merged in one of two ways: the latest row of a key wins, or, with ``sums``, the rows of a key are
added up (logs of increments).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.functions import rules as R
from wardlens.session import materialize

BUCKETS = 64


def write_upserts(batch: DataFrame, batch_id: int, path: str, key: str, fmt: str = "parquet",
                  **options: str) -> None:
    """``foreachBatch`` writer of keyed rows with their processing time and version.

    On files, a batch replaces its own ``batch_id`` folder, so a replayed batch changes nothing.
    A connector that replaces by key gets the key as ``_id`` and needs no changelog.
    """
    rows = batch.withColumns({
        "processed_at": F.current_timestamp(),
        "processing_version": F.lit(R.PROCESSING_VERSION),
    })
    if fmt == "parquet":
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    else:
        (rows.withColumn("_id", F.col(key)).write.format(fmt).mode("append")
         .options(**options).save())


# ---- folders ------------------------------------------------------------------------------------

def _glob(spark: SparkSession, pattern: str) -> list[str]:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path) or []
    return [status.getPath().toString() for status in found]


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _number(folder: str, name: str) -> int:
    """The value of the part ``name=value`` of a path."""
    return int(next(part for part in reversed(folder.split("/")) if part.startswith(f"{name}=")).split("=")[1])


def logged_batches(spark: SparkSession, path: str) -> list[int]:
    """Ascending ids of the batches whose folders are still there."""
    return sorted(_number(folder, "batch_id") for folder in _glob(spark, f"{path}/batch_id=*"))


def compacted_batches(spark: SparkSession, path: str) -> list[int]:
    """Ascending batch ids up to which ``compact_log`` has completed a base."""
    return sorted(_number(folder, "upto") for folder in _glob(spark, f"{path}.base/buckets=*/upto=*/_SUCCESS"))


def _bucket_versions(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Bucket -> its folders in complete bases, newest last."""
    complete = set(compacted_batches(spark, path))
    found: dict[int, list[str]] = {}
    for folder in sorted(_glob(spark, f"{path}.base/buckets=*/upto=*/bucket=*"), key=lambda f: _number(f, "upto")):
        if _number(folder, "upto") in complete:
            found.setdefault(_number(folder, "bucket"), []).append(folder)
    return found


# ---- reading ------------------------------------------------------------------------------------

def _base(spark: SparkSession, path: str, only: set[int] | None = None) -> DataFrame | None:
    """Rows of the newest version of each bucket (of ``only`` those buckets), with the column ``bucket``."""
    newest = {bucket: folders[-1] for bucket, folders in _bucket_versions(spark, path).items()}
    if not newest:
        return None
    # The last base has all columns that any earlier one has; it needs no look into the others' files.
    last = max(newest.values(), key=lambda folder: _number(folder, "upto"))
    root = last.rsplit("/upto=", 1)[0]
    schema = spark.read.option("basePath", root).parquet(last).schema
    folders = [folder for bucket, folder in newest.items() if only is None or bucket in only]
    if not folders:
        return spark.createDataFrame([], schema).drop("upto")
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).drop("upto")


def _tail(spark: SparkSession, path: str, after: int | None, upto: int | None = None) -> DataFrame | None:
    """Rows of the batches after ``after``, with their ``batch_id``."""
    batches = logged_batches(spark, path)
    if not batches:
        return None
    # Columns may be added while a log grows: the last batch has them all.
    schema = spark.read.option("basePath", path).parquet(f"{path}/batch_id={batches[-1]}").schema
    log = spark.read.schema(schema).parquet(path)
    if after is not None:
        log = log.filter(F.col("batch_id") > after)
    return log if upto is None else log.filter(F.col("batch_id") <= upto)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _latest(rows: DataFrame, key: str | Sequence[str], order: str | None) -> DataFrame:
    """The last row of each key; of those of one batch the one with the highest ``order``."""
    recency = [F.desc("batch_id"), *([F.col(order).desc_nulls_last()] if order else [])]
    place = F.row_number().over(Window.partitionBy(*_keys(key)).orderBy(*recency))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def _reduced(rows: DataFrame, key: str | Sequence[str], order: str | None, sums: Sequence[str]) -> DataFrame:
    if not sums:
        return _latest(rows, key, order)
    totals = [F.sum(name).alias(name) for name in sums]
    return rows.groupBy(*_keys(key)).agg(*totals, F.max("batch_id").alias("batch_id"))


def _replaced(base: DataFrame, fresh: DataFrame, key: str | Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``base`` with the rows of ``fresh``, both one row per key.

    A base row is only looked up among the fresh keys: no aggregation carries whole rows.
    """
    if sums:
        return _reduced(base.unionByName(fresh, allowMissingColumns=True), key, None, sums)
    news = fresh.select(*[F.col(name).alias(f"_new_{name}") for name in _keys(key)])
    same = F.lit(True)
    for name in _keys(key):
        same = same & base[name].eqNullSafe(F.col(f"_new_{name}"))
    return base.join(news, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


def latest_view(spark: SparkSession, path: str, key: str | Sequence[str], order: str | None = None,
                sums: Sequence[str] = ()) -> DataFrame:
    """Last written row per key, or sums per key; ``order`` decides between rows of one batch."""
    done = compacted_batches(spark, path)
    base, tail = _base(spark, path), _tail(spark, path, done[-1] if done else None)
    if tail is None and base is None:
        raise FileNotFoundError(f"{path} holds no batches and no base")
    if tail is None:
        return base.drop("bucket", "batch_id")
    fresh = _reduced(tail, key, order, sums)
    rows = fresh if base is None else _replaced(base.drop("bucket"), fresh, key, sums)
    return rows.drop("batch_id")


# ---- compaction and retention -------------------------------------------------------------------

def compact_log(spark: SparkSession, path: str, key: str | Sequence[str], order: str | None = None,
                upto: int | None = None, sums: Sequence[str] = (), buckets: int = BUCKETS) -> int | None:
    """Merge the batches since the last compaction into the base; later reads scan base and newer batches.

    Returns the last batch id in the base. While the stream runs, ``upto`` names its last finished
    batch. The number of buckets is that of the first compaction.
    """
    done = compacted_batches(spark, path)
    before = done[-1] if done else None
    batches = [n for n in logged_batches(spark, path)
               if (before is None or n > before) and (upto is None or n <= upto)]
    if not batches:
        return before
    held = _glob(spark, f"{path}.base/buckets=*")
    buckets = _number(held[0], "buckets") if held else buckets
    bucket = F.pmod(F.xxhash64(*_keys(key)), F.lit(buckets)).cast("int")
    fresh = materialize(_reduced(_tail(spark, path, before, batches[-1]), key, order, sums)
                        .withColumn("bucket", bucket), "changelog-fresh")
    changed = {row.bucket for row in fresh.select("bucket").distinct().collect()}  # ``buckets`` at most
    base = _base(spark, path, changed)
    merged = fresh if base is None else _replaced(base.drop("bucket"), fresh.drop("bucket"), key, sums).withColumn("bucket", bucket)
    # Large buckets are split over several files.
    (merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{path}.base/buckets={buckets}/upto={batches[-1]}"))
    return batches[-1]


def expire_log(spark: SparkSession, path: str, before: int | None = None, keep_versions: int = 1) -> list[int]:
    """Delete batches that the base covers (below ``before``, if given) and replaced versions of buckets.

    Returns the ids of deleted batches. Readers that started earlier may still need what goes: give them
    time, or leave them ``keep_versions`` of each bucket.
    """
    done = compacted_batches(spark, path)
    if not done:
        return []
    last = done[-1] if before is None else min(done[-1], before - 1)
    gone = [n for n in logged_batches(spark, path) if n <= last]
    for n in gone:
        _delete(spark, f"{path}/batch_id={n}")
    for folders in _bucket_versions(spark, path).values():
        for folder in folders[:-max(1, keep_versions)]:
            _delete(spark, folder)
    return gone


def compact(spark: SparkSession, path: str, key: str, target: str, order: str | None = None) -> None:
    """Write the latest rows of a changelog to a table of its own."""
    latest_view(spark, path, key, order).write.mode("overwrite").parquet(target)
