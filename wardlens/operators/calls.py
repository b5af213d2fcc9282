"""Emergency-call operators without time windows; all but the counters also run on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions import expressions as X
from wardlens.functions import rules as R
from wardlens.operators.lookup import attach


def nest_calls(calls: DataFrame) -> DataFrame:
    """Flat call columns back in document shape; further columns are kept at top level."""
    groups = {
        "location": ["address", "area_name", "latitude", "longitude"],
        "caller_info": ["phone_number", "is_anonymous"],
        "dispatch_info": ["units_dispatched", "response_time_minutes", "is_dispatched"],
    }
    nested = {name for members in groups.values() for name in members}
    structs = [F.struct(*members).alias(name) for name, members in groups.items()]
    return calls.select(*[c for c in calls.columns if c not in nested], *structs)


def encode_json(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON text column from all columns."""
    return df.select(F.to_json(F.struct("*")).alias(column))


AREA_COLUMNS = ["area_risk_level", "area_performance_tier", "crime_density_category",
                "resolution_rate"]


def enrich_calls(calls: DataFrame, stats: DataFrame, fill_rate: bool = False) -> DataFrame:
    """Calls with risk level, performance tier, density and resolution rate of their area.

    Areas match in any case. Calls without a known area keep nulls; ``fill_rate`` makes their
    resolution rate 0.
    """
    enriched = attach(calls, stats.select("area_key", *AREA_COLUMNS), {"area_key": F.upper("area_name")}, spread_by="call_id")
    if fill_rate:
        enriched = enriched.fillna(0.0, "resolution_rate")
    return enriched


def escalate_calls(enriched: DataFrame, min_priority: int = R.ESCALATION_MIN_PRIORITY,
                   types: list[str] = R.ESCALATION_TYPES) -> DataFrame:
    """Low-priority violent calls from high-risk areas, one priority step up."""
    return (
        enriched.filter((F.col("priority") >= min_priority)
                        & (F.col("area_risk_level") == R.RISK_LABELS[-1])
                        & F.upper("incident_type").isin(types))
        .select("call_id",
                F.col("priority").alias("original_priority"),
                (F.col("priority") - 1).alias("escalated_priority"),
                "incident_type", "area_name", "area_risk_level",
                F.lit(R.ESCALATION_REASON).alias("escalation_reason"))
    )


def high_priority_calls(calls: DataFrame, max_priority: int = R.HIGH_PRIORITY) -> DataFrame:
    """Alert rows for urgent calls; a call without priority has the lowest one."""
    urgent = F.coalesce("priority", F.lit(R.DEFAULT_PRIORITY)) <= max_priority
    return calls.filter(urgent).select("call_id", "incident_type", "area_name", "priority")


def flatten_calls(calls: DataFrame) -> DataFrame:
    """The 13 report columns of a call."""
    return calls.select(
        "call_id", "timestamp", "call_type", "incident_type", "priority",
        "address", "area_name", "latitude", "longitude", "status", "is_dispatched",
        F.size("units_dispatched").alias("units_count"),
        F.col("response_time_minutes").alias("response_time"))


_STAT_DEFAULTS = {"priority": R.DEFAULT_PRIORITY, "incident_type": R.DEFAULT_INCIDENT_TYPE}


def call_counts(calls: DataFrame, by: str) -> DataFrame:
    """Calls per value of ``by``; on a stream, a running count for complete or update mode."""
    key = F.coalesce(F.col(by), F.lit(_STAT_DEFAULTS[by])).alias(by)
    return calls.groupBy(key).agg(F.count("*").alias("count"))


def call_stats(calls: DataFrame, by: str) -> DataFrame:
    """Calls per value of ``by`` with their percentage of all calls (batch)."""
    return X.with_share(call_counts(calls, by), "count")


def top_incident_types(calls: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent incident types with their share; ties are in name order."""
    return call_stats(calls, "incident_type").orderBy(F.desc("count"), "incident_type").limit(k)
