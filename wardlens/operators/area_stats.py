"""Lookup of live-call enrichment: one row per upper-case area name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions import rules as R


def area_stats(summary: DataFrame, yoy: DataFrame) -> DataFrame:
    """Area summary with the risk level of each area's latest year.

    Areas found on one side only are kept. Several areas with one name give one row: the highest
    area_id speaks for the summary, the latest year and then the highest area_id for the risk. A
    missing percentile or rate is 0.
    """
    fields = ["area_performance_tier", "crime_density_category", "resolution_rate",
              "crime_density_percentile"]
    key = F.upper("area_name").alias("area_key")
    profile = (summary.filter(F.col("area_name").isNotNull())
               .groupBy(key)
               .agg(F.max_by(F.struct(*fields), F.struct("area_id")).alias("profile"))
               .select("area_key", "profile.*"))
    risk = (yoy.filter(F.col("area_name").isNotNull())
            .groupBy(key)
            .agg(F.max_by("area_risk_level", F.struct("occurrence_year", "area_id"))
                 .alias("area_risk_level")))
    percentile = F.coalesce("crime_density_percentile", F.lit(0.0))
    return (profile.join(risk, "area_key", "full")
            .withColumns({
                "resolution_rate": F.coalesce("resolution_rate", F.lit(0.0)),
                "crime_density_percentile": percentile,
                "historical_avg_minutes": R.RESPONSE_BASE + percentile / 100 * R.RESPONSE_SPAN,
            }))
