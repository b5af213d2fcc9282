"""Windowed monitors over calls, for batch and streaming frames.

Calls need ``area_name`` and ``ts``; streams also need a watermark on ``ts``. Sizes are minutes.
Each monitor first reduces calls to counts per (area, slot) on the map side, so a hot area costs
one row per slot and task in the shuffle. Hopping windows are then built from slots, not calls,
which avoids one copy of every call per overlapping window. Streams can only chain two windows in
append mode, so ``final_only=False`` lets a stream use direct hopping windows in update mode.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions import rules as R
from wardlens.operators.lookup import attach


def _minutes(n: int) -> str:
    return f"{n} minutes"


def _millis(column: str) -> Column:
    return F.unix_millis(F.col(column))


def slot_sums(calls: DataFrame, sums: dict[str, Column], slot: int) -> DataFrame:
    """Aggregates per area and tumbling window, in struct column ``slot``."""
    return (calls.filter(F.col("area_name").isNotNull())
            .groupBy("area_name", F.window("ts", _minutes(slot)).alias("slot"))
            .agg(*[value.alias(name) for name, value in sums.items()]))


def hopping_sums(calls: DataFrame, sums: dict[str, Column], size: int, slide: int,
                 final_only: bool = True) -> DataFrame:
    """Additive aggregates per area and hopping window, in struct column ``span``."""
    if size % slide:
        raise ValueError("window size must be a multiple of its slide")
    if calls.isStreaming and not final_only:
        return (calls.filter(F.col("area_name").isNotNull())
                .groupBy("area_name", F.window("ts", _minutes(size), _minutes(slide)).alias("span"))
                .agg(*[value.alias(name) for name, value in sums.items()]))
    spans = F.window(F.window_time("slot"), _minutes(size), _minutes(slide)).alias("span")
    return (slot_sums(calls, sums, slide)
            .groupBy("area_name", spans)
            .agg(*[F.sum(name).alias(name) for name in sums]))


def spike_detection(calls: DataFrame, slot: int = 5, background: int = 60,
                    factor: float = R.SPIKE_FACTOR, warmup: int = 60,
                    start_ts: datetime | None = None, final_only: bool = True) -> DataFrame:
    """Slots with more than ``factor`` times the mean slot of the background window they end.

    Both counts come out of one aggregation: a slot counts for every background window over it,
    and as the detection count of the one that ends with it. With ``start_ts``, slots that begin
    less than ``warmup`` minutes after it are left out. A stream with ``final_only=False`` counts calls in
    background windows directly, so that it can report spikes in update mode, while windows are open.
    """
    slot_start = F.col("span.end") - F.expr(f"INTERVAL '{slot}' MINUTE")
    if calls.isStreaming and not final_only:
        spans = F.window("ts", _minutes(background), _minutes(slot))
        counted = (calls.filter(F.col("area_name").isNotNull()).select("area_name", "ts", spans.alias("span"))
                   .groupBy("area_name", "span")
                   .agg(F.count("*").alias("background_count"),
                        F.count_if(F.col("ts") >= slot_start).alias("call_count")))
    else:
        counted = _slot_backgrounds(calls, slot, background)
    baseline = F.col("background_count") / (background / slot)
    found = counted.filter(F.col("call_count") > factor * baseline)
    if start_ts is not None:
        found = found.filter(slot_start >= F.lit(start_ts) + F.expr(f"INTERVAL '{warmup}' MINUTE"))
    return found.select(
        "area_name",
        F.unix_millis(slot_start).alias("window_start"),
        _millis("span.end").alias("window_end"),
        "call_count",
        baseline.alias("baseline"),
        (F.col("call_count") / baseline).alias("spike_ratio"))


def _slot_backgrounds(calls: DataFrame, slot: int, background: int) -> DataFrame:
    """Calls per area and background window, and those in the slot that ends with it."""
    slots = slot_sums(calls, {"calls": F.count("*")}, slot)
    spans = F.window(F.window_time("slot"), _minutes(background), _minutes(slot)).alias("span")
    own = F.when(F.col("slot.end") == F.col("span.end"), F.col("calls"))
    return (slots.select("area_name", "slot", "calls", spans)
            .groupBy("area_name", "span")
            .agg(F.sum("calls").alias("background_count"), F.sum(own).alias("call_count")))


def response_averages(calls: DataFrame, size: int = 30, slide: int = 5,
                      final_only: bool = True) -> DataFrame:
    """Mean response time of dispatched calls per area and window."""
    answered = calls.filter(F.col("is_dispatched") & (F.col("response_time_minutes") > 0))
    sums = {"minutes": F.sum("response_time_minutes"), "calls": F.count("*")}
    return hopping_sums(answered, sums, size, slide, final_only).select(
        "area_name", _millis("span.start").alias("window_start"),
        (F.col("minutes") / F.col("calls")).alias("live_avg_minutes"))


def response_degradation(calls: DataFrame, stats: DataFrame, size: int = 30, slide: int = 5,
                         factor: float = R.RESPONSE_FACTOR, default: float = R.RESPONSE_DEFAULT,
                         final_only: bool = True) -> DataFrame:
    """Windows whose mean response time exceeds ``factor`` times the area's historical one."""
    averages = response_averages(calls, size, slide, final_only)
    compared = attach(averages, stats.select("area_key", "historical_avg_minutes"),
                      {"area_key": F.upper("area_name")}, spread_by="window_start")
    live, historical = F.col("live_avg_minutes"), F.col("historical_avg_minutes")
    return (compared.fillna(default, "historical_avg_minutes")
            .filter(live > factor * historical)
            .withColumn("degradation_ratio", live / historical))


def unit_utilization(calls: DataFrame, size: int = 15, capacity: int = R.UNIT_CAPACITY) -> DataFrame:
    """Dispatched units by service per area and window, as a percentage of ``capacity``.

    Units of other services count for none, but their window still appears.
    """
    units = (calls.filter(F.col("is_dispatched") & F.col("area_name").isNotNull())
             .select("area_name", "ts", F.explode("units_dispatched").alias("unit"))
             .filter(F.col("unit").isNotNull()))
    unit = F.upper("unit")
    sums = {name: F.count_if(unit.startswith(prefix)) for name, prefix in R.UNIT_PREFIXES.items()}
    total = sum((F.col(name) for name in sums), F.lit(0))
    return slot_sums(units, sums, size).select(
        "area_name", _millis("slot.start").alias("window_start"), *sums,
        (total / F.lit(float(capacity)) * 100).alias("utilization_pct"))


def dispatch_windows(calls: DataFrame, size: int = 15, slide: int = 5,
                     final_only: bool = True) -> DataFrame:
    """Undispatched calls, all calls and their ratio per area and window."""
    failed = ~F.coalesce("is_dispatched", F.lit(False))
    sums = {"failure_count": F.count_if(failed), "total_calls": F.count("*")}
    return hopping_sums(calls, sums, size, slide, final_only).select(
        "area_name", _millis("span.start").alias("window_start"), *sums,
        (F.col("failure_count") / F.col("total_calls")).alias("failure_rate"))


def dispatch_failures(calls: DataFrame, stats: DataFrame, size: int = 15, slide: int = 5,
                      threshold: float = R.FAILURE_LIMIT, risks: list[str] = R.FAILURE_RISKS,
                      final_only: bool = True) -> DataFrame:
    """Windows of risky areas in which too many calls were not dispatched."""
    risky = (stats.filter(F.col("area_risk_level").isin(list(risks)))
             .select("area_key", "area_risk_level"))
    windows = dispatch_windows(calls, size, slide, final_only)
    return attach(windows.filter(F.col("failure_rate") > threshold), risky,
                  {"area_key": F.upper("area_name")}, spread_by="window_start", how="inner")


def with_result_key(df: DataFrame) -> DataFrame:
    """Key of a windowed result: area and window start."""
    return df.withColumn("result_key", F.concat_ws("_", "area_name", "window_start"))
