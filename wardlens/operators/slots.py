"""One table of counters per (area, slot) from which all windowed monitors are derived.

Calls are reduced once, to sums per area and 5-minute slot. Every monitor's windows are whole slots, so spikes,
response times, dispatch failures and unit utilization are sums of slots: the calls themselves are
neither read again nor copied into overlapping windows. Functions take batch frames of slots (one row per
area and slot) and return the columns of the monitors in ``monitors``, plus ``window_stop`` (epoch ms).

``active`` tells whether a window exceeds its limit. Monitors return active windows only, unless
``everything`` asks for all: then a store of windows can be corrected when more calls arrive.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions import rules as R
from wardlens.operators.lookup import attach

SLOT_MINUTES = 5
KEY = ["area_name", "slot_start"]
COUNTERS = ["calls", "failures", "answered", "answered_minutes", "units", *R.UNIT_PREFIXES, "late_calls"]
#: Minutes of calls before a slot that a window over it can hold.
REACH = 60


def slot_start(ts: Column, slot: int = SLOT_MINUTES) -> Column:
    return F.window(ts, f"{slot} minutes").start


def _units(test: Callable[[Column], Column]) -> Column:
    """Dispatched units of a call that pass ``test``; missing ones don't count."""
    return F.coalesce(F.size(F.filter("units_dispatched", lambda unit: unit.isNotNull() & test(unit))), F.lit(0))


def slot_counters(calls: DataFrame, slot: int = SLOT_MINUTES) -> DataFrame:
    """Counters per area and slot; calls without an area or time are left out.

    Calls with a true ``is_late`` only count as ``late_calls``; without that column none is late.
    """
    late = F.coalesce("is_late", F.lit(False)) if "is_late" in calls.columns else F.lit(False)
    dispatched = F.coalesce("is_dispatched", F.lit(False))
    answered = dispatched & F.coalesce(F.col("response_time_minutes") > 0, F.lit(False))
    units = {name: (lambda unit, prefix=prefix: F.upper(unit).startswith(prefix)) for name, prefix in R.UNIT_PREFIXES.items()}
    values = {
        "calls": F.lit(1),
        "failures": (~dispatched).cast("int"),
        "answered": answered.cast("int"),
        "answered_minutes": F.when(answered, F.col("response_time_minutes")).otherwise(0.0),
        "units": F.when(dispatched, _units(lambda unit: F.lit(True))).otherwise(0),
        **{name: F.when(dispatched, _units(test)).otherwise(0) for name, test in units.items()},
    }
    timely = {name: F.sum(F.when(late, F.lit(0)).otherwise(value)).alias(name) for name, value in values.items()}
    return (calls.filter(F.col("area_name").isNotNull() & F.col("ts").isNotNull())
            .groupBy("area_name", slot_start(F.col("ts"), slot).alias("slot_start"))
            .agg(*timely.values(), F.count_if(late).alias("late_calls")))


def _windows(slots: DataFrame, names: list[str], size: int, slide: int) -> DataFrame:
    """Sums of slots per area and window; a slot's start lies in the windows that hold the slot."""
    if size % slide or slide % SLOT_MINUTES:
        raise ValueError("windows must consist of whole slots")
    span = F.window("slot_start", f"{size} minutes", f"{slide} minutes").alias("span")
    return (slots.filter("calls > 0").select("area_name", "slot_start", *names, span)
            .groupBy("area_name", "span").agg(*[F.sum(name).alias(name) for name in names]))


def _result(windows: DataFrame, active: Column, everything: bool, *columns: str | Column) -> DataFrame:
    kept = windows if everything else windows.filter(active)
    flag = [F.coalesce(active, F.lit(False)).alias("active")] if everything else []
    return kept.select("area_name", F.unix_millis("span.start").alias("window_start"), *columns,
                       F.unix_millis("span.end").alias("window_stop"), *flag)


def slot_spikes(slots: DataFrame, factor: float = R.SPIKE_FACTOR, background: int = REACH, warmup: int = 60,
                start_ts: datetime | None = None, everything: bool = False) -> DataFrame:
    """Slots with more than ``factor`` times the mean slot of the background window that they end."""
    length = F.expr(f"INTERVAL '{SLOT_MINUTES}' MINUTE")
    span = F.window("slot_start", f"{background} minutes", f"{SLOT_MINUTES} minutes").alias("span")
    own = F.when(F.col("slot_start") + length == F.col("span.end"), F.col("calls"))
    counted = (slots.filter("calls > 0").select("area_name", "slot_start", "calls", span).groupBy("area_name", "span")
               .agg(F.sum("calls").alias("background_count"), F.sum(own).alias("call_count")))
    baseline = F.col("background_count") / (background / SLOT_MINUTES)
    active = F.col("call_count") > factor * baseline
    slot = F.col("span.end") - length
    if start_ts is not None:
        active = active & (slot >= F.lit(start_ts) + F.expr(f"INTERVAL '{warmup}' MINUTE"))
    # The window of a result is the slot under test.
    tested = counted.filter("call_count IS NOT NULL").withColumns({"baseline": baseline, "spike_ratio": F.col("call_count") / baseline})
    found = tested if everything else tested.filter(active)
    flag = [F.coalesce(active, F.lit(False)).alias("active")] if everything else []
    end = F.unix_millis("span.end")
    return found.select("area_name", F.unix_millis(slot).alias("window_start"), end.alias("window_end"), "call_count", "baseline",
                        "spike_ratio", end.alias("window_stop"), *flag)


def slot_degradation(slots: DataFrame, stats: DataFrame, size: int = 30, factor: float = R.RESPONSE_FACTOR,
                     default: float = R.RESPONSE_DEFAULT, everything: bool = False) -> DataFrame:
    """Windows whose mean response time exceeds ``factor`` times the area's historical one."""
    windows = _windows(slots, ["answered", "answered_minutes"], size, SLOT_MINUTES).filter("answered > 0")
    compared = attach(windows, stats.select("area_key", "historical_avg_minutes"), {"area_key": F.upper("area_name")},
                      spread_by="span").fillna(default, "historical_avg_minutes")
    live, historical = F.col("answered_minutes") / F.col("answered"), F.col("historical_avg_minutes")
    return _result(compared, live > factor * historical, everything, live.alias("live_avg_minutes"),
                   "historical_avg_minutes", (live / historical).alias("degradation_ratio"))


def slot_utilization(slots: DataFrame, size: int = 15, capacity: int = R.UNIT_CAPACITY, everything: bool = False) -> DataFrame:
    """Dispatched units by service per area and tumbling window, as a percentage of ``capacity``."""
    windows = _windows(slots, ["units", *R.UNIT_PREFIXES], size, size).filter("units > 0")
    total = sum((F.col(name) for name in R.UNIT_PREFIXES), F.lit(0))
    return _result(windows, F.lit(True), everything, *R.UNIT_PREFIXES,
                   (total / F.lit(float(capacity)) * 100).alias("utilization_pct"))


def slot_failures(slots: DataFrame, stats: DataFrame, size: int = 15, threshold: float = R.FAILURE_LIMIT,
                  risks: list[str] = R.FAILURE_RISKS, everything: bool = False) -> DataFrame:
    """Windows of risky areas in which too many calls were not dispatched."""
    risky = stats.filter(F.col("area_risk_level").isin(list(risks))).select("area_key", "area_risk_level")
    windows = _windows(slots, ["failures", "calls"], size, SLOT_MINUTES)
    rate = F.col("failures") / F.col("calls")
    found = attach(windows, risky, {"area_key": F.upper("area_name")}, spread_by="span", how="inner")
    return _result(found, rate > threshold, everything, F.col("failures").alias("failure_count"),
                   F.col("calls").alias("total_calls"), rate.alias("failure_rate"), "area_risk_level")
