"""Three-zone lake: raw CSV in bronze, cleaned and derived Parquet in silver, results in gold."""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.session import materialize
from wardlens.sources.heads import files_by_header
from wardlens.sources.schemas import RAW_INCIDENT

#: Raw text is gzip of a low level, which takes half the time of the default one for an eighth more bytes.
RAW_TEXT = {"compression": "gzip", "zlib.compress.level": "FOUR"}


@dataclass(frozen=True)
class Lake:
    """Folder layout below one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/incidents"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/incidents"

    def metrics(self, name: str) -> str:
        return f"{self.root}/silver/metrics/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def land_raw(spark: SparkSession, source: str, lake: Lake) -> None:
    """Copy the lines of raw CSV files into bronze, replacing what was there.

    Nothing is parsed: quotes and surplus fields arrive as they are. A large file is split over many
    tasks, and each part starts with the header line of its file. Parts are compressed.
    """
    landed = None
    for header, files in files_by_header(spark, source).items():
        lines = spark.read.text(files).filter(F.col("value") != header)
        # The low 33 bits of the id number the rows of a partition.
        lines = lines.withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        part = lines.select(F.explode(F.when(F.col("at") == 0, F.array(F.lit(header), "value"))
                                      .otherwise(F.array("value"))).alias("value"))
        landed = part if landed is None else landed.unionAll(part)
    if landed is not None:  # a union keeps its parts' partitions apart, so headers stay in front
        landed.write.mode("overwrite").options(**RAW_TEXT).text(lake.bronze)


def read_raw(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Raw incident CSV with declared types; columns are mapped by the header of each file.

    Columns that a file lacks are null. Fields that do not parse become null. ``options`` go to the
    CSV reader, such as ``escape='"'`` for doubled quotes.
    """
    declared = {field.name: field.dataType for field in RAW_INCIDENT}
    found = None
    for header, files in files_by_header(spark, path).items():
        names = next(csv.reader([header.removeprefix("\ufeff")], delimiter=options.get("sep", ",")), [])
        schema = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in names])
        part = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", enforceSchema=True, **options).csv(files)
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], RAW_INCIDENT) if found is None else found


def silver_schema(spark: SparkSession) -> T.StructType:
    """Columns of cleaned incidents; the partition column comes last, as in files."""
    from wardlens.operators.incidents import clean_incidents

    schema = clean_incidents(spark.createDataFrame([], RAW_INCIDENT)).schema
    return T.StructType([f for f in schema if f.name != "occurrence_year"] + [schema["occurrence_year"]])


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Cleaned incidents; the declared schema also holds where a drop had no rows or no dates."""
    return spark.read.schema(silver_schema(spark)).parquet(lake.silver)


def read_metrics(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return spark.read.parquet(lake.metrics(name))


def load_area_stats(spark: SparkSession, lake: Lake, fmt: str = "parquet", **options: str) -> DataFrame:
    """Per-area lookup built from the two published gold tables; fails if they are missing.

    ``fmt`` and ``options`` are those that the gold tables were written with.

    It is written to the shared folder, so that a stream's micro-batches only scan the result. A
    running stream keeps the lookup it was started with.
    """
    from wardlens.operators.area_stats import area_stats

    def gold(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        if fmt in ("parquet", "orc", "json", "csv"):
            return reader.load(lake.gold(name))
        return reader.option("collection", name).load()

    stats = area_stats(gold("gold_bm_area_summary"), gold("gold_bm_yoy_crime_trends"))
    return materialize(stats, "area_stats")
