"""Registered queries: name -> callable(spark, table folder) -> DataFrame.

Dates and timestamps are returned as text.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acceptance import testbed as T
from wardlens.operators import calls as C
from wardlens.operators import incidents as I
from wardlens.operators import metrics as M
from wardlens.operators import monitors as N
from wardlens.plans import run_batch
from wardlens.session import limit_generated_methods, materialize, scratch_dir
from wardlens.sinks import compact_log, expire_log, latest_view, logged_batches, write_daily_csv
from wardlens.sources import (
    CALL_DOCUMENT, Lake, accepted_documents, decode_text, land_raw, parse_calls, read_raw, rejected_documents,
)
from wardlens.sources.heads import files_by_header
from wardlens import streaming as live
from wardlens.streaming import start_statistics, start_streams, upsert_sink, with_event_time

Query = Callable[[SparkSession, str], DataFrame]

# Warm-up of spike detection counts from here, the first instant of the calls.
CALLS_START = datetime(2024, 1, 1)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        limit_generated_methods(spark)
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = run
    return run


def counted(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


# ---- incidents ------------------------------------------------------------------------------

@query
def incidents_by_year(spark, sf_dir):
    return M.incidents_by_year(T.silver(spark, sf_dir))


@query
def resolution_by_area(spark, sf_dir):
    return M.resolution_stats(M.area_year_counts(T.silver(spark, sf_dir)))


@query
def density_percentile(spark, sf_dir):
    counts = materialize(M.area_year_counts(T.silver(spark, sf_dir)), "area_year_counts")
    areas = M.area_profile(counts)
    return areas.select("area_id", "total_cases", "crime_density_percentile",
                                "crime_density_category")


@query
def yoy_trends(spark, sf_dir):
    return M.yoy_change(M.area_year_counts(T.silver(spark, sf_dir))).drop("resolved_count")


@query
def area_risk(spark, sf_dir):
    return T.metrics(spark, sf_dir, "yoy_stats")


@query
def area_summary(spark, sf_dir):
    return T.metrics(spark, sf_dir, "area_summary")


@query
def enriched_incidents(spark, sf_dir):
    enriched, _, _ = M.business_metrics(T.silver(spark, sf_dir))
    return enriched.select(
        "id", "area_id", "area_name", "occurrence_year", "resolution_rate", "area_performance_tier",
        "crime_density_percentile", "crime_density_category", "reporting_lag_days",
        "reporting_speed", "yearly_crime_count", "yoy_crime_change_pct", "crime_trend",
        "area_risk_score", "area_risk_level")


@query
def reporting_lag(spark, sf_dir):
    return M.reporting_lag(M.with_reporting(T.silver(spark, sf_dir)))


@query
def reporting_speed_share(spark, sf_dir):
    return M.reporting_speed_share(M.with_reporting(T.silver(spark, sf_dir)))


@query
def status_resolution(spark, sf_dir):
    return counted(T.silver(spark, sf_dir), "status", "status_resolution")


@query
def raw_csv_cleaned(spark, sf_dir):
    """All incidents written as raw CSV, landed in bronze, read back and cleaned."""
    base = f"{scratch_dir(spark)}/raw-{uuid.uuid4().hex}"
    T.write_raw(T.raw_incidents(spark, sf_dir), f"{base}/source")
    lake = Lake(base)
    land_raw(spark, f"{base}/source", lake)
    return I.clean_incidents(read_raw(spark, lake.bronze)).select(
        "id", "area_id", "area_name", text("date_reported"), text("date_occured"), "time_occured",
        "crime_description", "victim_age", "victim_sex", "street_address", "lat", "lon",
        "occurrence_year", "report_year", "status_resolution")


@query
def batch_gold(spark, sf_dir):
    """The whole batch run, from raw CSV to its eleven gold collections: their rows and a sum of each."""
    base = f"{scratch_dir(spark)}/batch-{uuid.uuid4().hex}"
    T.write_raw(T.raw_incidents(spark, sf_dir), f"{base}/source")
    lake = Lake(base)
    run_batch(spark, lake, f"{base}/source")
    sums = {
        "gold_business_metrics": "id", "gold_crime_categorization": "id", "gold_categorical_standardization": "id",
        "gold_data_quality": "id", "gold_geographic_enrichment": "id", "gold_time_dimensions": "id",
        "gold_bm_area_summary": "area_id", "gold_bm_yoy_crime_trends": "yearly_crime_count",
        "gold_bm_reporting_lag": "total_records", "gold_bm_reporting_speed": "count", "gold_crime_count_by_year": "count",
    }
    found = None
    for name, column in sums.items():
        rows = spark.read.parquet(lake.gold(name)).agg(
            F.lit(name).alias("collection"), F.count("indexed_at").alias("n"), F.sum(column).cast("long").alias("total"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def published_trends(spark, sf_dir):
    """The published yearly trends with their audit column."""
    T.stats(spark, sf_dir)
    gold = spark.read.parquet(T.lake_of(spark, sf_dir).gold("gold_bm_yoy_crime_trends"))
    return gold.withColumn("indexed_at", F.col("indexed_at").between(F.expr("current_timestamp() - INTERVAL '1' DAY"), F.current_timestamp()))


@query
def raw_csv_headers(spark, sf_dir):
    """Raw files with different headers, told apart by their first lines and read by them."""
    base = f"{scratch_dir(spark)}/headers-{uuid.uuid4().hex}"
    raw = T.raw_incidents(spark, sf_dir)
    for k, names in enumerate(T.RAW_LAYOUTS):
        mine = raw.filter(F.col("DR_NO") % len(T.RAW_LAYOUTS) == k).select(*names)
        T.write_raw(mine, f"{base}/source")
    found = None
    for header, files in files_by_header(spark, f"{base}/source").items():
        raw = read_raw(spark, files)
        status = F.count("Status") if "Status" in raw.columns else F.lit(0).cast("long")
        rows = raw.agg(F.lit(header).alias("header"), F.count("*").alias("n"), F.sum("DR_NO").alias("ids"), status.alias("statuses"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def crime_category_counts(spark, sf_dir):
    return counted(I.categorize(T.silver(spark, sf_dir)), "crime_description", "crime_category")


@query
def crime_severity_counts(spark, sf_dir):
    return counted(I.categorize(T.silver(spark, sf_dir)), "crime_category", "crime_severity")


@query
def crime_flags(spark, sf_dir):
    return counted(I.categorize(T.silver(spark, sf_dir)), "crime_description", "premise_description",
                   "is_domestic_violence", "is_violent_crime", "is_property_crime")


@query
def victim_sex_counts(spark, sf_dir):
    return counted(I.standardize(T.silver(spark, sf_dir)), "victim_sex", "victim_sex_clean")


@query
def victim_descent_counts(spark, sf_dir):
    return counted(I.standardize(T.silver(spark, sf_dir)), "victim_descent", "victim_descent_clean")


@query
def weapon_category_counts(spark, sf_dir):
    return counted(I.standardize(T.silver(spark, sf_dir)), "weapon_description", "weapon_category")


@query
def age_groups(spark, sf_dir):
    return counted(I.assess_quality(T.silver(spark, sf_dir)), "victim_age", "victim_age_clean",
                   "victim_age_group")


@query
def address_standardized(spark, sf_dir):
    incidents = I.locate(I.assess_quality(T.silver(spark, sf_dir)))
    return incidents.select("id", "street_address_standardized", "street_address_clean")


@query
def quality_scores(spark, sf_dir):
    return counted(I.assess_quality(T.silver(spark, sf_dir)), "has_victim_info", "has_location_info",
                   "has_weapon_info", "has_premise_info", "data_completeness_score",
                   "data_quality_flag")


@query
def data_issues(spark, sf_dir):
    return counted(I.assess_quality(T.silver(spark, sf_dir)), "area_id", "has_data_issues")


@query
def valid_coordinates(spark, sf_dir):
    return counted(I.locate(T.silver(spark, sf_dir)), "area_id", "has_valid_coordinates")


@query
def geo_zones(spark, sf_dir):
    return I.locate(T.silver(spark, sf_dir)).select("id", "distance_from_center_km",
                                                    "geographic_zone")


@query
def geo_points(spark, sf_dir):
    return I.locate(T.silver(spark, sf_dir)).select(
        "id", F.col("location.lat").alias("location_lat"), F.col("location.lon").alias("location_lon"))


@query
def area_density(spark, sf_dir):
    return I.geo_enrich(T.silver(spark, sf_dir)).select("id", "area_id", "area_density_category",
                                                        "geographic_zone")


@query
def time_dimensions(spark, sf_dir):
    return I.time_dimensions(T.silver(spark, sf_dir)).select(
        "id", F.date_format("datetime_occurred", "yyyy-MM-dd HH:mm:ss").alias("datetime_occurred"),
        "occurrence_year", "occurrence_month", "occurrence_day", "occurrence_hour", "time_of_day",
        "day_of_week", "day_of_week_num", "is_weekend", "season")


@query
def area_stats(spark, sf_dir):
    return T.stats(spark, sf_dir)


# ---- calls ----------------------------------------------------------------------------------

_PARSED = ["call_id", "call_type", "incident_type", "priority", "address", "area_name", "latitude",
           "longitude", "phone_number", "is_anonymous", "is_dispatched", "response_time_minutes",
           "status"]


def _parsed_columns(calls: DataFrame) -> DataFrame:
    return calls.select(
        *_PARSED, F.unix_micros("ts").alias("ts_micros"),
        F.concat_ws(",", "units_dispatched").alias("units"),
    )


@query
def calls_parsed(spark, sf_dir):
    """Calls encoded as JSON documents and decoded again."""
    documents = C.encode_json(C.nest_calls(T.calls(spark, sf_dir).drop("ts")))
    return _parsed_columns(parse_calls(documents).filter(F.col("_corrupt").isNull()))


@query
def calls_rejected(spark, sf_dir):
    """Reasons why documents are no calls, one row each."""
    rejected = rejected_documents(T.faulty_documents(spark, sf_dir), CALL_DOCUMENT)
    return rejected.select("event_id", F.explode("reasons").alias("reason"))


@query
def calls_accepted(spark, sf_dir):
    """Calls whose documents keep to the schema, parsed."""
    kept = accepted_documents(T.faulty_documents(spark, sf_dir), CALL_DOCUMENT)
    return _parsed_columns(parse_calls(kept.drop("event_id")).filter("_corrupt IS NULL"))


@query
def props_parsed(spark, sf_dir):
    from pyspark.sql import types as S
    schema = S.StructType([S.StructField("k", S.IntegerType())])
    props = T.table(spark, sf_dir, "events").select("event_type", F.col("props").alias("value"))
    return decode_text(props, schema).groupBy("record_event_type").agg(
        F.count("*").alias("n"), F.sum("k").alias("k_sum"),
        F.count("_corrupt").alias("corrupt")).withColumnRenamed("record_event_type", "event_type")


@query
def calls_enriched(spark, sf_dir):
    enriched = C.enrich_calls(T.calls(spark, sf_dir), T.stats(spark, sf_dir))
    return enriched.select("call_id", "area_name", "area_risk_level", "area_performance_tier",
                           "crime_density_category", "resolution_rate")


@query
def escalated_calls(spark, sf_dir):
    return C.escalate_calls(C.enrich_calls(T.calls(spark, sf_dir), T.stats(spark, sf_dir)))


@query
def spike_detection(spark, sf_dir):
    return N.spike_detection(T.calls(spark, sf_dir), start_ts=CALLS_START)


@query
def response_degradation(spark, sf_dir):
    return N.response_degradation(T.calls(spark, sf_dir), T.stats(spark, sf_dir))


@query
def unit_utilization(spark, sf_dir):
    return N.with_result_key(N.unit_utilization(T.calls(spark, sf_dir)))


@query
def dispatch_failures(spark, sf_dir):
    return N.dispatch_failures(T.calls(spark, sf_dir), T.stats(spark, sf_dir))


@query
def call_priority_stats(spark, sf_dir):
    return C.call_stats(T.calls(spark, sf_dir), "priority")


@query
def incident_type_stats(spark, sf_dir):
    return C.call_stats(T.calls(spark, sf_dir), "incident_type")


@query
def top_incident_types(spark, sf_dir):
    return C.top_incident_types(T.calls(spark, sf_dir))


@query
def calls_flat(spark, sf_dir):
    return C.flatten_calls(T.calls(spark, sf_dir))


@query
def high_priority_calls(spark, sf_dir):
    return C.high_priority_calls(T.calls(spark, sf_dir))


@query
def daily_call_csv(spark, sf_dir):
    """Flat calls appended to daily CSV folders and read back."""
    path = f"{scratch_dir(spark)}/daily-{uuid.uuid4().hex}"
    flat = C.flatten_calls(T.calls(spark, sf_dir))
    write_daily_csv(flat, path)
    back = spark.read.schema(flat.schema).option("header", True).csv(path)
    return back.groupBy(F.col("call_date").cast("string").alias("call_date"), "status").agg(
        F.count("*").alias("n"), F.sum("units_count").alias("units"))


# ---- streams: the events table replayed through a file stream and keyed sinks ---------------

NOW = {"availableNow": True}


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events at once."""
    events = T.table(spark, sf_dir, "events")
    # A glob, because a file stream takes a plain path for a directory.
    return T.calls_of(spark.readStream.schema(events.schema).parquet(f"{sf_dir}/{{events.parquet}}"))


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events time slice by time slice, one per micro-batch."""
    return T.calls_of(T.event_files(spark, sf_dir))


def _restarted(start: Callable[[dict], StreamingQuery], between: Callable[[], None] = lambda: None) -> None:
    """Run a stream by time trigger, stop it in the middle, and finish it from its checkpoint."""
    running = start({"processingTime": "0 seconds"})
    while running.isActive and (running.lastProgress is None or running.lastProgress["batchId"] < 1):
        time.sleep(0.05)
    running.stop()
    if running.exception() is not None:
        raise running.exception()
    between()
    start(NOW).awaitTermination()


def _replay(stream: DataFrame, key: str, mode: str = "update", restart: bool = True) -> DataFrame:
    spark = stream.sparkSession
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    start = lambda trigger: upsert_sink(stream, f"{base}/out", key, f"{base}/checkpoint", mode, trigger)
    if restart:
        _restarted(start)
    else:
        start(NOW).awaitTermination()
    return latest_view(spark, f"{base}/out", key).drop("processed_at", "processing_version")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(_sliced(spark, sf_dir))


def _at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For windows that are reported while they exceed a limit and not taken back: one batch, one report."""
    return with_event_time(_stream(spark, sf_dir))


@query
def stream_calls(spark, sf_dir):
    return _parsed_columns(_replay(_sliced(spark, sf_dir), "call_id", "append"))


@query
def stream_calls_enriched(spark, sf_dir):
    enriched = C.enrich_calls(_sliced(spark, sf_dir), T.stats(spark, sf_dir))
    return _replay(enriched.select("call_id", "area_name", "area_risk_level", "resolution_rate"),
                   "call_id", "append")


@query
def stream_escalated_calls(spark, sf_dir):
    enriched = C.enrich_calls(_sliced(spark, sf_dir), T.stats(spark, sf_dir))
    return _replay(C.escalate_calls(enriched), "call_id", "append")


@query
def stream_area_spikes(spark, sf_dir):
    spikes = N.spike_detection(_timed(spark, sf_dir), start_ts=CALLS_START)
    return _replay(N.with_result_key(spikes), "result_key", "append")


@query
def stream_spikes_updated(spark, sf_dir):
    """Spikes as they happen: windows still open count too."""
    spikes = N.spike_detection(_at_once(spark, sf_dir), start_ts=CALLS_START, final_only=False)
    return _replay(N.with_result_key(spikes), "result_key", restart=False)


@query
def stream_response_windows(spark, sf_dir):
    averages = N.response_averages(_timed(spark, sf_dir), final_only=False)
    return _replay(N.with_result_key(averages), "result_key")


@query
def stream_response_degradation(spark, sf_dir):
    slow = N.response_degradation(_at_once(spark, sf_dir), T.stats(spark, sf_dir), final_only=False)
    return _replay(N.with_result_key(slow), "result_key", restart=False)


@query
def stream_unit_utilization(spark, sf_dir):
    used = N.unit_utilization(_timed(spark, sf_dir))
    return _replay(N.with_result_key(used), "result_key")


@query
def stream_dispatch_windows(spark, sf_dir):
    windows = N.dispatch_windows(_timed(spark, sf_dir), final_only=False)
    return _replay(N.with_result_key(windows), "result_key")


@query
def stream_dispatch_failures(spark, sf_dir):
    """Windows that event time has closed, each written once."""
    failures = N.dispatch_failures(_timed(spark, sf_dir), T.stats(spark, sf_dir), final_only=True)
    return _replay(N.with_result_key(failures), "result_key", "append")


@query
def stream_call_counts(spark, sf_dir):
    return _replay(C.call_counts(_sliced(spark, sf_dir), "priority"), "priority", "complete")


@query
def stream_incident_type_stats(spark, sf_dir):
    """Running statistics as of the last micro-batch."""
    base = f"{scratch_dir(spark)}/statistics-{uuid.uuid4().hex}"
    started = start_statistics(_stream(spark, sf_dir), base, f"{base}/checkpoint", NOW)
    for running in started.values():
        running.awaitTermination()
    view = latest_view(spark, f"{base}/stream_stats_incident_type", "incident_type")
    return view.select("incident_type", "count", "pct")


@query
def stream_topology(spark, sf_dir):
    """All outputs of the live topology, counted."""
    base = f"{scratch_dir(spark)}/topology-{uuid.uuid4().hex}"
    started = start_streams(_stream(spark, sf_dir), T.stats(spark, sf_dir), f"{base}/out",
                            f"{base}/checkpoint", NOW, start_ts=CALLS_START)
    for running in started.values():
        running.awaitTermination()
    outputs = {"stream_calls_enriched": "call_id", "stream_escalated_calls": "call_id",
               **{name: "result_key" for name in started}, "stream_calls": "call_id"}
    counts = None
    for name, key in outputs.items():
        rows = latest_view(spark, f"{base}/out/{name}", key).agg(
            F.lit(name).alias("output"), F.count("*").alias("n"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


# ---- streams over several micro-batches: time slices as files, stopped and started again ------------

@query
def stream_compacted(spark, sf_dir):
    """Running dispatch windows; between two runs and after them, the log is compacted and expired."""
    base = f"{scratch_dir(spark)}/compacted-{uuid.uuid4().hex}"
    calls = with_event_time(_sliced(spark, sf_dir))
    windows = N.with_result_key(N.dispatch_windows(calls, final_only=False))

    def tidy() -> None:
        last = logged_batches(spark, f"{base}/out")[-1]
        compact_log(spark, f"{base}/out", "result_key", upto=last - 1, buckets=8)  # the last may be unfinished
        expire_log(spark, f"{base}/out")

    _restarted(lambda trigger: upsert_sink(windows, f"{base}/out", "result_key", f"{base}/checkpoint", trigger=trigger), tidy)
    tidy()
    return latest_view(spark, f"{base}/out", "result_key").drop("processed_at", "processing_version")


def _slot_topology(spark: SparkSession, sf_dir: str, calls: DataFrame) -> str:
    base = f"{scratch_dir(spark)}/slots-{uuid.uuid4().hex}"
    stats = T.stats(spark, sf_dir)
    _restarted(lambda trigger: live.start_slot_monitors(calls, stats, f"{base}/out", f"{base}/checkpoint", trigger, CALLS_START))
    return f"{base}/out"


@query
def stream_slot_monitors(spark, sf_dir):
    """Rows of all outputs of the live topology that reads its source once, in one shape."""
    root = _slot_topology(spark, sf_dir, _sliced(spark, sf_dir))
    shapes = {
        "stream_area_spikes": ("call_count", "spike_ratio"),
        "stream_response_degradation": ("live_avg_minutes", "degradation_ratio"),
        "stream_unit_utilization": ("lapd_units", "utilization_pct"),
        "stream_dispatch_failures": ("failure_count", "failure_rate"),
    }
    frames = {name: (live.monitor_view(spark, root, name), "result_key", *measures) for name, measures in shapes.items()}
    frames["stream_calls_enriched"] = live.calls_view(spark, root), "call_id", "priority", "resolution_rate"
    frames["stream_escalated_calls"] = live.escalated_view(spark, root), "call_id", "original_priority", "escalated_priority"
    rows = None
    for name, (df, key, first, second) in frames.items():
        part = df.select(F.lit(name).alias("output"), F.col(key).alias("key"), F.col(first).cast("double").alias("first"),
                         F.col(second).cast("double").alias("second"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def stream_daily_csv(spark, sf_dir):
    """Flat calls written to daily CSV folders as they arrive, with a restart, and read back."""
    base = f"{scratch_dir(spark)}/daily-stream-{uuid.uuid4().hex}"
    flat = C.flatten_calls(_sliced(spark, sf_dir))
    _restarted(lambda trigger: live.start_daily_csv(flat, f"{base}/csv", f"{base}/checkpoint", trigger))
    return live.read_daily_csv(spark, f"{base}/csv", flat.schema).groupBy("call_date", "status").agg(
        F.count("*").alias("n"), F.sum("units_count").alias("units"))


@query
def stream_late_calls(spark, sf_dir):
    """Late calls by the event time of their own area, while another area runs hours ahead."""
    root = _slot_topology(spark, sf_dir, T.out_of_order(_sliced(spark, sf_dir)))
    return live.late_view(spark, root).select("call_id", "location.area_name", F.unix_micros("ts").alias("ts_micros"),
                                              "arrived_in")


@query
def stream_late_counts(spark, sf_dir):
    """Late and timely calls of each micro-batch and area."""
    root = _slot_topology(spark, sf_dir, T.out_of_order(_sliced(spark, sf_dir)))
    return live.late_counts(spark, root)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
