"""Per-area, per-year and per-label business metrics.

The facts are aggregated once, to counts per (area, year); every metric is derived from those
counts. Only the enriched incident table goes back to the facts, through ``attach``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions import expressions as X
from wardlens.functions import rules as R
from wardlens.operators.lookup import attach
from wardlens.session import materialize


def area_year_counts(incidents: DataFrame) -> DataFrame:
    """Incidents and closed incidents per (area_id, occurrence_year).

    The name is grouped on first and reduced afterwards: a text minimum over the facts would turn
    their hash aggregation into a sort.
    """
    by_name = incidents.groupBy("area_id", "area_name", "occurrence_year").agg(
        F.count("*").alias("cases"),
        F.count_if(F.col("status_resolution") == "Closed").alias("closed"),
    )
    return by_name.groupBy("area_id", "occurrence_year").agg(
        F.min("area_name").alias("area_name"),
        F.sum("cases").alias("yearly_crime_count"),
        F.sum("closed").alias("resolved_count"),
    )


def resolution_stats(counts: DataFrame) -> DataFrame:
    """Resolution rate and performance tier per area."""
    rate = F.round(F.col("resolved_cases") / F.col("total_cases") * 100, 2)
    return (
        counts.groupBy("area_id").agg(
            F.min("area_name").alias("area_name"),
            F.sum("yearly_crime_count").alias("total_cases"),
            F.sum("resolved_count").alias("resolved_cases"))
        .withColumn("resolution_rate", rate)
        .withColumn("area_performance_tier", X.bucketize(
            F.col("resolution_rate"), R.TIER_BOUNDS, R.TIER_LABELS, null_label=R.TIER_LABELS[0]))
    )


def ranked_below(counts: DataFrame, value: str, weight: str) -> tuple[DataFrame, int]:
    """(``counts`` with the sum of ``weight`` over smaller values in ``below``, the sum over all).

    Values are distinct. They are dealt into ranges, each range is summed up by itself, and what the ranges
    before it hold is added: as a running total over all values, but in as many tasks as there are ranges.
    Nulls come first.
    """
    # Where a range lies in the order of ranges is the number of the task that writes it.
    ranges = materialize(counts.repartitionByRange(F.col(value)).withColumn("range", F.spark_partition_id()), "rank-ranges")
    offsets, total = {}, 0
    # As many rows as ranges.
    for row in ranges.groupBy("range").agg(F.sum(weight).alias("held")).orderBy("range").collect():
        offsets[row.range], total = total, total + row.held
    before = Window.partitionBy("range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])[F.col("range")] if offsets else F.lit(0)
    below = offset.cast("long") + F.coalesce(F.sum(weight).over(before), F.lit(0))
    return ranges.withColumn("below", below).drop("range"), total


def density_percentile(areas: DataFrame, count_col: str = "total_cases") -> DataFrame:
    """Add each area's percent rank (0-100) by number of incidents, and its density label.

    ``areas`` should derive from a written table, as it is read more than once. Areas of equal count share
    a rank, which comes from running totals over the distinct counts.
    """
    ranked, total = ranked_below(areas.groupBy(count_col).agg(F.count("*").alias("areas")), count_col, "areas")
    percentile = F.lit(0.0) if total == 1 else F.col("below") / (total - 1) * 100
    ranks = ranked.select(count_col, percentile.alias("crime_density_percentile"))
    ranked = attach(areas, ranks, {count_col: F.col(count_col)}, spread_by="area_id")
    return ranked.withColumn(
        "crime_density_category", X.bucketize(
            F.col("crime_density_percentile"), R.CRIME_DENSITY_BOUNDS, R.CRIME_DENSITY_LABELS,
            null_label=R.CRIME_DENSITY_LABELS[0]))


def yoy_change(counts: DataFrame) -> DataFrame:
    """Percent change against the area's previous year that has incidents, and the trend.

    A window partition holds one row per year of an area.
    """
    change, count, previous = (F.col("yoy_crime_change_pct"), F.col("yearly_crime_count"),
                               F.col("prev_year_count"))
    by_year = Window.partitionBy("area_id").orderBy("occurrence_year")
    return (
        counts
        .withColumn("prev_year_count", F.lag("yearly_crime_count", 1).over(by_year))
        .withColumn("yoy_crime_change_pct", F.round((count - previous) / previous * 100, 2))
        .withColumn("crime_trend",
                    F.when(change > R.TREND_LIMIT, F.lit("Increasing"))
                    .when(change < -R.TREND_LIMIT, F.lit("Decreasing"))
                    .when(change.isNotNull(), F.lit("Stable"))
                    .otherwise(F.lit(R.UNKNOWN)))
    )


def risk_score(percentile: Column, resolution_rate: Column, trend: Column) -> Column:
    """Weighted 0-100 score of density, unresolved share and trend; null without a percentile."""
    weight = F.lit(R.TREND_WEIGHT_DEFAULT)
    for label, value in R.TREND_WEIGHTS.items():
        weight = F.when(trend == label, F.lit(value)).otherwise(weight)
    unresolved = 100 - F.coalesce(resolution_rate, F.lit(R.RESOLUTION_DEFAULT))
    return F.round((percentile / 100 * R.DENSITY_WEIGHT
                    + unresolved / 100 * R.UNRESOLVED_WEIGHT + weight) * 100, 1)


def risk_level(score: Column) -> Column:
    return X.bucketize(score, R.RISK_BOUNDS, R.RISK_LABELS, null_label=R.RISK_LABELS[0])


_AREA_COLUMNS = ["resolution_rate", "area_performance_tier",
                 "crime_density_percentile", "crime_density_category"]
_YEAR_COLUMNS = ["yearly_crime_count", "yoy_crime_change_pct", "crime_trend"]


def area_profile(counts: DataFrame) -> DataFrame:
    """Resolution and density per area, also for the null area."""
    return density_percentile(materialize(resolution_stats(counts), "resolution_stats"))


def area_summary(counts: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """One row per area. Incidents without an area get no area metrics."""
    known = F.col("area_id").isNotNull()
    profile = area_profile(counts) if profile is None else profile
    return profile.select("area_id", "area_name", *[F.when(known, F.col(c)).alias(c) for c in _AREA_COLUMNS])


def area_year_metrics(counts: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """One row per (area_id, occurrence_year) with area, year and risk columns.

    Year metrics need both keys and area metrics need the area, as in a join on those keys.
    """
    dated = F.col("area_id").isNotNull() & F.col("occurrence_year").isNotNull()
    years = yoy_change(counts).select(
        "area_id", "occurrence_year", "area_name",
        *[F.when(dated, F.col(c)).alias(c) for c in _YEAR_COLUMNS])
    score = risk_score(F.col("crime_density_percentile"), F.col("resolution_rate"),
                       F.col("crime_trend"))
    profile = area_profile(counts) if profile is None else profile
    return (years.join(profile.select("area_id", *_AREA_COLUMNS), "area_id", "left")
            .withColumn("area_risk_score", score)
            .withColumn("area_risk_level", risk_level(F.col("area_risk_score"))))


def yoy_stats(area_years: DataFrame) -> DataFrame:
    """Published year-over-year table, from ``area_year_metrics``."""
    return area_years.select("area_id", "area_name", "occurrence_year", *_YEAR_COLUMNS,
                             "area_risk_score", "area_risk_level")


def with_reporting(incidents: DataFrame) -> DataFrame:
    """Days between incident and report, and the speed label; a negative lag counts as Next Day."""
    lag = F.col("reporting_lag_days")
    speed = X.bucketize(lag, R.SPEED_BOUNDS, R.SPEED_LABELS, null_label=R.UNKNOWN, closed="right")
    return (incidents
            .withColumn("reporting_lag_days", F.datediff("date_reported", "date_occured"))
            .withColumn("reporting_speed", F.when(lag == 0, F.lit(R.SAME_DAY)).otherwise(speed)))


def enrich_incidents(incidents: DataFrame, area_years: DataFrame) -> DataFrame:
    """Incidents with reporting, area, year and risk columns, in one lookup join."""
    joined = attach(with_reporting(incidents), area_years.drop("area_name"),
                    {"area_id": F.col("area_id"), "occurrence_year": F.col("occurrence_year")},
                    spread_by="id", null_safe=("occurrence_year",))
    return joined.withColumn("area_risk_level",
                             F.coalesce("area_risk_level", F.lit(R.RISK_LABELS[0])))


def metric_tables(incidents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``area_year_metrics``, ``area_summary``) from one pass over the incidents.

    The counts, the areas' profile and the year metrics are written to the shared folder, because
    several results are derived from each.
    """
    counts = materialize(area_year_counts(incidents), "area_year_counts")
    profile = materialize(area_profile(counts), "area_profile")
    return materialize(area_year_metrics(counts, profile), "area_year_metrics"), area_summary(counts, profile)


def business_metrics(incidents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(enriched incidents, yoy_stats, area_summary)."""
    area_years, summary = metric_tables(incidents)
    return enrich_incidents(incidents, area_years), yoy_stats(area_years), summary


def incidents_by_year(incidents: DataFrame) -> DataFrame:
    """Incidents per year of occurrence, in order of year.

    Where silver is partitioned by that year, its scan reads no data columns.
    """
    year = (F.col("occurrence_year") if "occurrence_year" in incidents.columns
            else F.year("date_occured"))
    return incidents.groupBy(year.alias("year")).agg(F.count("*").alias("count")).orderBy("year")


def reporting_lag(reported: DataFrame) -> DataFrame:
    """Mean lag and share of late reports per area, over lags of 0 to 365 days."""
    lag = F.col("reporting_lag_days")
    late = F.count_if(lag > R.LAG_DELAYED) / F.count("*") * 100
    return (reported.filter(lag.between(*R.LAG_RANGE))
            .groupBy("area_name").agg(
                F.round(F.avg(lag), 1).alias("avg_lag_days"),
                F.round(late, 1).alias("pct_delayed"),
                F.count("*").alias("total_records"))
            .orderBy(F.desc("avg_lag_days")))


def reporting_speed_share(reported: DataFrame) -> DataFrame:
    """Incidents and percentage per reporting speed."""
    return X.with_share(reported.groupBy("reporting_speed").agg(F.count("*").alias("count")), "count")
