"""Batch pipeline from raw CSV to gold collections, in one application."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from wardlens.operators import incidents as I
from wardlens.operators import metrics as M
from wardlens.sinks import write_gold, write_metrics, write_silver
from wardlens.sources import Lake, land_raw, read_metrics, read_raw, read_silver

#: Gold collections that are written at once.
WRITERS = 3


def build_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Clean bronze into silver; each part of bronze writes its own files."""
    write_silver(I.clean_incidents(read_raw(spark, lake.bronze)), lake, rebalance=False)
    return read_silver(spark, lake)


def build_metrics(spark: SparkSession, lake: Lake, enriched: bool = True) -> None:
    """Write the metrics tables; the fact-sized enriched table can be left out."""
    silver = read_silver(spark, lake)
    area_years, summary = M.metric_tables(silver)
    write_metrics(M.yoy_stats(area_years), lake, "yoy_stats")
    write_metrics(summary, lake, "area_summary")
    if enriched:
        write_metrics(M.enrich_incidents(silver, area_years), lake, "enriched")


def publish(spark: SparkSession, lake: Lake, collections: Mapping[str, Callable[[], DataFrame]], **gold: str) -> None:
    """Write gold collections that don't need each other, a few at once.

    Tasks of the next ones take the cores that the last tasks of one leave idle. After a failure, none that
    still waits is begun.
    """
    def write(name: str) -> None:
        write_gold(collections[name](), lake, name, **gold)

    with ThreadPoolExecutor(WRITERS) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write), name) for name in collections]
        try:
            for written in running:
                written.result()
        finally:
            pool.shutdown(wait=False, cancel_futures=True)


def metric_collections(spark: SparkSession, lake: Lake) -> dict[str, Callable[[], DataFrame]]:
    """Gold collections of the metrics tables; live-call enrichment reads the last two."""
    def enriched() -> DataFrame:
        return read_metrics(spark, lake, "enriched")

    return {
        "gold_business_metrics": enriched,
        "gold_bm_reporting_lag": lambda: M.reporting_lag(enriched()),
        "gold_bm_reporting_speed": lambda: M.reporting_speed_share(enriched()),
        "gold_bm_area_summary": lambda: read_metrics(spark, lake, "area_summary"),
        "gold_bm_yoy_crime_trends": lambda: read_metrics(spark, lake, "yoy_stats"),
    }


def publish_metrics(spark: SparkSession, lake: Lake, **gold: str) -> None:
    publish(spark, lake, metric_collections(spark, lake), **gold)


def run_batch(spark: SparkSession, lake: Lake, source: str, **gold: str) -> None:
    """Land, clean, derive and publish everything; ``gold`` options go to ``write_gold``."""
    land_raw(spark, source, lake)
    silver = build_silver(spark, lake)
    build_metrics(spark, lake)
    publish(spark, lake, {
        "gold_geographic_enrichment": lambda: I.geo_enrich(silver),
        "gold_time_dimensions": lambda: I.time_dimensions(silver),
        "gold_data_quality": lambda: I.assess_quality(silver),
        "gold_crime_categorization": lambda: I.categorize(silver),
        "gold_categorical_standardization": lambda: I.standardize(silver),
        "gold_crime_count_by_year": lambda: M.incidents_by_year(silver),
    } | metric_collections(spark, lake), **gold)
