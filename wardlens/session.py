"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes. Generated code of wide projections exceeds
    # that and would be interpreted; with this limit, Spark splits it into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state lives off-heap and is written as changelogs, so it can exceed executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """Session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def limit_generated_methods(spark: SparkSession) -> None:
    """Set the method limit above on a session that others built, unless they chose one."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, SETTINGS[key])


#: Temporary folders of local applications that name no folder.
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, unique to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder: on a cluster, a machine-local path is lost with its executor.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="wardlens-")
        base = _LOCAL[context.applicationId]
    return f"{base.rstrip('/')}/wardlens-{context.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used for per-key aggregates that several later steps read: the facts are scanned once, lineage
    is cut in storage that outlives executors, and the file sizes give Catalyst true statistics.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
