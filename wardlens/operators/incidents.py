"""Row-level incident operators: cleaning, categories, codes, quality, geography and time."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions import expressions as X
from wardlens.functions import rules as R
from wardlens.operators.lookup import attach
from wardlens.session import materialize


# ---- cleaning -----------------------------------------------------------------------------

def rename_raw(raw: DataFrame) -> DataFrame:
    """Clean column names; raw columns that are missing are skipped."""
    return raw.withColumnsRenamed(R.RAW_TO_CLEAN)


def status_resolution(status: Column) -> Column:
    return (F.when(status.rlike(R.CLOSED_STATUS_PATTERN), F.lit("Closed"))
            .when(status == R.ONGOING_STATUS, F.lit("Ongoing"))
            .otherwise(F.lit(R.UNKNOWN)))


def parse_dates(incidents: DataFrame) -> DataFrame:
    """Both dates from raw text; unreadable text becomes null."""
    return incidents.withColumns({name: F.try_to_date(F.col(name), R.RAW_DATE_FORMAT)
                                  for name in ("date_reported", "date_occured")})


def with_case_columns(incidents: DataFrame) -> DataFrame:
    """Years of both dates and the case status."""
    return incidents.withColumns({
        "occurrence_year": F.year("date_occured"),
        "report_year": F.year("date_reported"),
        "status_resolution": status_resolution(F.col("status")),
    })


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Raw rows with clean names, parsed dates, their years and the case status."""
    return with_case_columns(parse_dates(rename_raw(raw)))


# ---- categories ---------------------------------------------------------------------------

_CATEGORIES = [label for _, label in R.CATEGORY_RULES] + [R.CATEGORY_DEFAULT]


def _severity_of(category: str) -> str:
    return next((label for pattern, label in R.SEVERITY_RULES if re.search(pattern, category)),
                R.SEVERITY_DEFAULT)


def _categories_with(pattern: str) -> list[str]:
    return [label for label in _CATEGORIES if re.search(pattern, label)]


def _with_folded(incidents: DataFrame, *names: str) -> DataFrame:
    """Case-folded copies, as columns: inlined, they would be folded again for every word."""
    return incidents.withColumns({f"_folded_{name}": X.fold_case(F.col(name)) for name in names})


def categorize(incidents: DataFrame) -> DataFrame:
    """Category and severity of the description, and the domestic, violent and property flags.

    Categories are a closed set, so what follows from a category is looked up, not matched again.
    A dwelling as the premise is enough for the domestic flag.
    """
    texts = ["crime_description", "premise_description"]
    (description, premise), category = map(F.col, texts), F.col("crime_category")
    folded, folded_premise = (F.col(f"_folded_{name}") for name in texts)
    domestic = (X.contains_any(description, R.DOMESTIC_PATTERN, folded)
                | X.contains_any(premise, R.DWELLING_PATTERN, folded_premise))
    return _with_folded(incidents, *texts).withColumns({
        "crime_category": X.classify(description, R.CATEGORY_RULES, R.CATEGORY_DEFAULT,
                                     folded=folded),
        "is_domestic_violence": X.null_safe_flag(domestic),
    }).withColumns({
        "crime_severity": X.map_codes(category, {c: _severity_of(c) for c in _CATEGORIES},
                                      R.SEVERITY_DEFAULT),
        "is_violent_crime": category.isin(_categories_with(R.VIOLENT_PATTERN)),
        "is_property_crime": category.isin(_categories_with(R.PROPERTY_PATTERN)),
    }).drop(*(f"_folded_{name}" for name in texts))


# ---- coded values -------------------------------------------------------------------------

def standardize(incidents: DataFrame) -> DataFrame:
    """Readable victim sex and descent, and a weapon group."""
    return _with_folded(incidents, "weapon_description").withColumns({
        "victim_sex_clean": X.map_codes(F.upper(F.trim("victim_sex")), R.SEX_CODES, R.UNKNOWN),
        "victim_descent_clean": X.map_codes(F.col("victim_descent"), R.DESCENT_CODES, R.UNKNOWN),
        "weapon_category": X.classify(F.col("weapon_description"), R.WEAPON_RULES, "Other",
                                      null_value=R.UNKNOWN,
                                      folded=F.col("_folded_weapon_description")),
    }).drop("_folded_weapon_description")


# ---- data quality -------------------------------------------------------------------------

def _all_present(*names: str) -> Column:
    condition = F.col(names[0]).isNotNull()
    for name in names[1:]:
        condition = condition & F.col(name).isNotNull()
    return condition


def assess_quality(incidents: DataFrame) -> DataFrame:
    """Usable age and its group, full address, presence flags, completeness and error flag."""
    age = F.col("victim_age").try_cast("double")
    flags = ["has_victim_info", "has_location_info", "has_weapon_info", "has_premise_info"]
    score = sum((F.col(name).cast("int") for name in flags), F.lit(0)) / F.lit(float(len(flags)))
    low, high = R.AGE_RANGE
    issues = ((F.col("date_occured") > F.col("date_reported"))
              | (age < low) | (age > high)
              | ((F.col("lat") == 0) & (F.col("lon") == 0)))
    return (
        incidents
        .withColumns({
            "victim_age_clean": F.when(age.between(low, high), age.cast("int")),
            "street_address_standardized": X.standardize_address(F.col("street_address"),
                                                                 expand_ave=True),
            "has_location_info": _all_present("lat", "lon", "street_address"),
            "has_weapon_info": _all_present("weapon_description"),
            "has_premise_info": _all_present("premise_description"),
            "has_data_issues": X.null_safe_flag(issues),
        })
        .withColumns({
            "victim_age_group": X.bucketize(F.col("victim_age_clean"), R.AGE_BOUNDS, R.AGE_LABELS,
                                            null_label=R.UNKNOWN),
            "has_victim_info": _all_present("victim_age_clean", "victim_sex", "victim_descent"),
        })
        .withColumn("data_completeness_score", score)
        .withColumn("data_quality_flag", X.bucketize(
            F.col("data_completeness_score"), R.QUALITY_BOUNDS, R.QUALITY_LABELS,
            null_label=R.QUALITY_LABELS[0]))
    )


# ---- geography ----------------------------------------------------------------------------

def area_density(incidents: DataFrame) -> DataFrame:
    """One row per area with its number of incidents and density group."""
    return (incidents.filter(F.col("area_id").isNotNull())
            .groupBy("area_id").agg(F.count("*").alias("crime_count"))
            .withColumn("area_density_category", X.bucketize(
                F.col("crime_count"), R.DENSITY_BOUNDS, R.DENSITY_LABELS,
                null_label=R.DENSITY_LABELS[0])))


def locate(incidents: DataFrame) -> DataFrame:
    """The row-level part of ``geo_enrich``."""
    valid, distance = F.col("has_valid_coordinates"), F.col("distance_from_center_km")
    return (
        incidents
        .withColumn("has_valid_coordinates", X.bbox_valid(F.col("lat"), F.col("lon"), R.CITY_BOUNDS))
        .withColumns({
            "distance_from_center_km": F.when(valid, X.planar_km(F.col("lat"), F.col("lon"))),
            "street_address_clean": X.standardize_address(F.col("street_address")),
            "location": F.when(valid, F.struct("lat", "lon")),
        })
        .withColumn("geographic_zone", X.bucketize(distance, R.ZONE_BOUNDS, R.ZONE_LABELS,
                                                   null_label=R.UNKNOWN, closed="right"))
    )


def geo_enrich(incidents: DataFrame, density: DataFrame | None = None) -> DataFrame:
    """Coordinate check, distance and zone, clean address, point, and the area's density group."""
    if density is None:
        density = materialize(area_density(incidents), "area_density")
    return attach(locate(incidents), density.select("area_id", "area_density_category"),
                  {"area_id": F.col("area_id")}, spread_by="id")


# ---- time ---------------------------------------------------------------------------------

def time_dimensions(incidents: DataFrame) -> DataFrame:
    """Timestamp of the incident and its calendar and day-part columns.

    The time is HHmm as a number, so its text is padded to four digits; a time that does not exist
    gives no timestamp. Date patterns are avoided: formatting and parsing text costs more than all
    other columns here.
    """
    date, hour, month = F.col("date_occured"), F.col("occurrence_hour"), F.col("occurrence_month")
    clock = F.lpad(F.col("time_occured").cast("string"), 4, "0")
    day = F.dayofweek(date)
    day_part = F.when(hour.isNull(), F.lit(R.DAY_PART_DEFAULT))
    for start, end, label in R.DAY_PARTS:
        day_part = day_part.when((hour >= start) & (hour < end), F.lit(label))
    season = F.when(month.isNull(), F.lit(R.SEASON_DEFAULT))
    for label, months in R.SEASONS.items():
        season = season.when(month.isin(*months), F.lit(label))
    return (
        incidents
        .withColumns({
            "occurrence_year": F.year(date),
            "occurrence_month": F.month(date),
            "occurrence_day": F.dayofmonth(date),
            "day_of_week": F.element_at(F.array(*map(F.lit, R.DAY_NAMES)), day),
            "day_of_week_num": day,
            "is_weekend": X.null_safe_flag(day.isin(*R.WEEKEND_DAYS)),
        })
        .withColumn("datetime_occurred", F.try_make_timestamp(
            "occurrence_year", month, "occurrence_day",
            F.substring(clock, 1, 2).try_cast("int"), F.substring(clock, 3, 2).try_cast("int"),
            F.lit(0)))
        .withColumn("occurrence_hour", F.hour("datetime_occurred"))
        .withColumns({
            "time_of_day": day_part.otherwise(F.lit(R.DAY_PART_DEFAULT)),
            "season": season.otherwise(F.lit(R.SEASON_DEFAULT)),
        })
    )
