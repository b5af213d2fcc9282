"""Row-level operators on hand-made rows: one per rule, plus nulls, bounds and shadowed rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions import bucketize, classify, contains_any, fold_case
from wardlens.functions import rules as R
from wardlens.operators import incidents as I


def column(spark, values, name, kind):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, kind)]))


def test_categories(spark):
    cases = {
        "MANSLAUGHTER, NEGLIGENT": ("Violent - Homicide", "Critical"),
        "Sodomy": ("Violent - Sexual", "High"),
        "ROBBERY": ("Violent - Robbery", "High"),
        "ASSAULT WITH DEADLY WEAPON": ("Violent - Robbery", "High"),
        "BATTERY - SIMPLE ASSAULT": ("Violent - Assault", "Medium"),
        "KIDNAPPING": ("Violent - Kidnapping", "High"),
        "BURGLARY FROM VEHICLE": ("Property - Burglary", "Medium"),
        "VEHICLE THEFT": ("Property - Theft", "Low"),
        "VEHICLE - STOLEN": ("Other", "Minor"),
        "VANDALISM - FELONY": ("Property - Vandalism", "Low"),
        "ARSON": ("Property - Arson", "Medium"),
        "DRUGS, TO A MINOR": ("Drug", "Low"),
        "EMBEZZLEMENT": ("White Collar", "Minor"),
        "INTIMATE PARTNER": ("Domestic Violence", "Minor"),
        "TRESPASSING": ("Public Order", "Minor"),
        "DRUNK ROLL": ("Alcohol Related", "Minor"),
        "": ("Other", "Minor"),
        None: ("Other", "Minor"),
    }
    df = column(spark, cases, "crime_description", T.StringType())
    df = I.categorize(df.withColumn("premise_description", F.lit(None).cast("string")))
    rows = {r.crime_description: r for r in df.collect()}
    assert {d: (r.crime_category, r.crime_severity) for d, r in rows.items()} == cases
    assert rows["ROBBERY"].is_violent_crime and not rows["ROBBERY"].is_property_crime
    assert rows["ARSON"].is_property_crime and not rows["ARSON"].is_violent_crime
    assert not rows["INTIMATE PARTNER"].is_violent_crime


@pytest.mark.parametrize("description,premise,expected", [
    ("SPOUSE ABUSE", None, True), (None, "Apartment", True), ("THEFT", "STREET", False),
    ("THEFT", None, False), (None, None, False), (None, "STREET", False),
])
def test_domestic_flag(spark, description, premise, expected):
    df = spark.createDataFrame([(description, premise)],
                               "crime_description string, premise_description string")
    assert I.categorize(df).first().is_domestic_violence is expected


def test_codes(spark):
    df = spark.createDataFrame(
        [(" m ", "H", "HAND GUN"), ("female", "h", "Machete"), ("h", "X", "ROCK/THROWN OBJECT"),
         ("-", "Z", "STRONG-ARM (HANDS, FIST)"), (None, None, None), ("X", " W", "VEHICLE"),
         ("MALE", "G", "FIRE"), ("F", "-", "DRUGS"), ("", "", "VERBAL THREAT")],
        "victim_sex string, victim_descent string, weapon_description string")
    rows = I.standardize(df).collect()
    assert [r.victim_sex_clean for r in rows] == [
        "Male", "Female", "Other", "Unknown", "Unknown", "Other", "Male", "Female", "Unknown"]
    assert [r.victim_descent_clean for r in rows] == [
        "Hispanic/Latino", "Unknown", "Unknown", "Asian Indian", "Unknown", "Unknown", "Guamanian",
        "Unknown", "Unknown"]
    assert [r.weapon_category for r in rows] == [
        "Firearm", "Knife/Blade", "Blunt Object", "Personal Weapons", "Unknown", "Vehicle",
        "Fire/Incendiary", "Chemical/Poison", "Other"]


QUALITY = T.StructType([
    T.StructField("victim_age", T.IntegerType()), T.StructField("victim_sex", T.StringType()),
    T.StructField("victim_descent", T.StringType()), T.StructField("street_address", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("weapon_description", T.StringType()),
    T.StructField("premise_description", T.StringType()),
    T.StructField("date_occured", T.DateType()), T.StructField("date_reported", T.DateType()),
])
DAY = dt.date(2020, 5, 1)


def quality(spark, **values):
    base = dict(victim_age=30, victim_sex="M", victim_descent="W", street_address="1 A ST", lat=34.0,
                lon=-118.0, weapon_description="X", premise_description="Y", date_occured=DAY,
                date_reported=DAY)
    return I.assess_quality(spark.createDataFrame(
        [tuple((base | values)[name] for name in QUALITY.names)], QUALITY)).first()


@pytest.mark.parametrize("age,clean,group", [
    (-1, None, "Unknown"), (0, 0, "Minor (0-17)"), (17, 17, "Minor (0-17)"),
    (18, 18, "Young Adult (18-24)"), (25, 25, "Adult (25-34)"), (35, 35, "Middle Age (35-49)"),
    (50, 50, "Older Adult (50-64)"), (65, 65, "Senior (65+)"), (120, 120, "Senior (65+)"),
    (121, None, "Unknown"), (None, None, "Unknown"),
])
def test_age(spark, age, clean, group):
    row = quality(spark, victim_age=age)
    assert (row.victim_age_clean, row.victim_age_group) == (clean, group)


def test_age_text(spark):
    df = spark.createDataFrame([("41",), ("x",), ("NaN",), ("12.7",)], "victim_age string")
    for name, kind in zip(QUALITY.names[1:], [f.dataType for f in QUALITY.fields[1:]]):
        df = df.withColumn(name, F.lit(None).cast(kind))
    assert [r.victim_age_clean for r in I.assess_quality(df).collect()] == [41, None, None, 12]


def test_completeness(spark):
    row = quality(spark)
    assert (row.data_completeness_score, row.data_quality_flag) == (1.0, "High Quality")
    row = quality(spark, victim_sex=None)
    assert (row.data_completeness_score, row.data_quality_flag) == (0.75, "High Quality")
    row = quality(spark, victim_sex=None, lat=None)
    assert (row.has_victim_info, row.has_location_info, row.data_quality_flag) == (
        False, False, "Medium Quality")
    row = quality(spark, victim_age=121, street_address=None, weapon_description=None)
    assert (row.data_completeness_score, row.data_quality_flag) == (0.25, "Low Quality")
    row = quality(spark, victim_age=None, lon=None, weapon_description=None, premise_description=None)
    assert (row.data_completeness_score, row.data_quality_flag) == (0.0, "Poor Quality")


@pytest.mark.parametrize("values,expected", [
    ({}, False), ({"date_reported": dt.date(2020, 4, 30)}, True), ({"victim_age": -1}, True),
    ({"victim_age": 121}, True), ({"lat": 0.0, "lon": 0.0}, True), ({"lat": 0.0}, False),
    ({"date_reported": None, "victim_age": None}, False),
    ({"date_reported": None, "victim_age": 130}, True),
])
def test_data_issues(spark, values, expected):
    assert quality(spark, **values).has_data_issues is expected


@pytest.mark.parametrize("raw,with_ave,without_ave", [
    ("  12   Main  ST ", "12 MAIN STREET", "12 MAIN STREET"),
    ("1 Oak st", "1 OAK ST", "1 OAK ST"),
    ("1 ST\tAVE", "1 STREET AVENUE", "1 STREET AVE"),
    ("9 STREET", "9 STREET", "9 STREET"), ("9 STONE", "9 STONE", "9 STONE"), ("", "", ""),
    (None, None, None),
])
def test_address(spark, raw, with_ave, without_ave):
    assert quality(spark, street_address=raw).street_address_standardized == with_ave
    row = I.locate(spark.createDataFrame([(raw, 34.0, -118.0)],
                                         "street_address string, lat double, lon double")).first()
    assert row.street_address_clean == without_ave


def test_geography(spark):
    rows = I.locate(spark.createDataFrame(
        [(34.0522, -118.2437), (33.7, -118.9), (33.69, -118.2), (0.0, 0.0), (None, -118.0),
         (float("nan"), -118.0), (34.4, -117.6), (34.2, -118.2)],
        "lat double, lon double").withColumn("street_address", F.lit("a"))).collect()
    assert [r.has_valid_coordinates for r in rows] == [
        True, True, False, False, False, False, True, True]
    assert rows[0].distance_from_center_km == 0.0 and rows[0].geographic_zone == "Downtown Core"
    assert rows[2].distance_from_center_km is None and rows[2].geographic_zone == "Unknown"
    assert rows[2].location is None and rows[1].location.asDict() == {"lat": 33.7, "lon": -118.9}
    assert rows[6].geographic_zone == "Outer Areas" and rows[7].geographic_zone == "Inner City"


def test_bucket_edges(spark):
    df = column(spark, [7.99, 8.0, 8.01, 48.0, 48.01, None], "x", T.DoubleType())
    zone = bucketize(F.col("x"), R.ZONE_BOUNDS, R.ZONE_LABELS, "none", closed="right")
    tier = bucketize(F.col("x"), [8.0, 48.0], ["a", "b", "c"], "none")
    assert [tuple(r) for r in df.select(zone, tier).collect()] == [
        ("Downtown Core", "a"), ("Downtown Core", "b"), ("Inner City", "b"), ("Greater LA", "c"),
        ("Outer Areas", "c"), ("none", "none")]
    with pytest.raises(ValueError):
        bucketize(F.col("x"), [2, 1], ["a", "b", "c"], "none")


def test_area_density_ignores_null_area(spark):
    df = spark.createDataFrame([(i, 1) for i in range(600)] + [(i, None) for i in range(700)],
                               "id long, area_id int")
    df = df.selectExpr("*", "34.0D lat", "-118.0D lon", "'x' street_address")
    found = {tuple(r) for r in I.geo_enrich(df).select("area_id", "area_density_category").collect()}
    assert found == {(1, "Low Density"), (None, None)}


@pytest.mark.parametrize("time,stamp,hour,part", [
    (1, "2020-02-29 00:01:00", 0, "Night"), (600, "2020-02-29 06:00:00", 6, "Morning"),
    (1200, "2020-02-29 12:00:00", 12, "Afternoon"), (1800, "2020-02-29 18:00:00", 18, "Evening"),
    (2200, "2020-02-29 22:00:00", 22, "Night"), (2359, "2020-02-29 23:59:00", 23, "Night"),
    (2400, None, None, "Night"), (None, None, None, "Night"), (1260, None, None, "Night"),
    (-5, None, None, "Night"), (12345, "2020-02-29 12:34:00", 12, "Afternoon"),
])
def test_time_of_day(spark, time, stamp, hour, part):
    df = spark.createDataFrame([(dt.date(2020, 2, 29), time)], "date_occured date, time_occured int")
    row = I.time_dimensions(df).first()
    assert (str(row.datetime_occurred) if stamp else row.datetime_occurred) == stamp
    assert (row.occurrence_hour, row.time_of_day) == (hour, part)
    assert (row.occurrence_year, row.occurrence_month, row.occurrence_day) == (2020, 2, 29)
    assert (row.day_of_week, row.day_of_week_num, row.is_weekend) == ("Saturday", 7, True)


def test_seasons_and_null_date(spark):
    dates = [dt.date(2021, m, 15) for m in range(1, 13)] + [None]
    df = spark.createDataFrame([(d, 900) for d in dates], "date_occured date, time_occured int")
    rows = I.time_dimensions(df).collect()
    assert [r.season for r in rows] == (["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3
                                        + ["Fall"] * 3 + ["Winter", "Fall"])
    assert rows[-1].datetime_occurred is None and rows[-1].is_weekend is False


@pytest.mark.parametrize("status,expected", [
    ("AA", "Closed"), ("ja", "Closed"), ("XAOX", "Closed"), ("IC", "Ongoing"), ("ic", "Unknown"),
    ("CC", "Unknown"), (None, "Unknown"),
])
def test_status(spark, status, expected):
    df = column(spark, [status], "s", T.StringType())
    assert df.select(I.status_resolution(F.col("s"))).first()[0] == expected


def test_clean_skips_missing_columns_and_bad_dates(spark):
    raw = spark.createDataFrame(
        [(1, "2010 Jan 26 12:00:00 AM", "2009 Dec 31 11:59:00 PM", "AA"), (2, "26/01/2010", None, None)],
        ["DR_NO", "Date Rptd", "DATE OCC", "Status"])
    first, second = I.clean_incidents(raw).orderBy("id").collect()
    assert (first.date_reported, first.date_occured) == (dt.date(2010, 1, 26), dt.date(2009, 12, 31))
    assert (first.occurrence_year, first.report_year, first.status_resolution) == (2009, 2010, "Closed")
    assert (second.date_reported, second.date_occured, second.occurrence_year) == (None, None, None)


def test_classify_null_default(spark):
    df = column(spark, [None, "b"], "x", T.StringType())
    assert [r[0] for r in df.select(classify(F.col("x"), [("a", "A")], "other")).collect()] == [
        "other", "other"]


PIECES = ["gun", "Gun", "kil", "KILL", "\u212aill", "murder", "MURDER", "HOM\u0130CIDE", "homicide", " ",
          "vehicle", "Theft", "the", "ft", "\u017fteal", "car", "auto", "ABDUCT", "dr\u00fcg", "drug", "\n", "."]


def test_word_search_equals_regex(spark):
    """Substring search on folded text against the regex, on random and on non-ASCII text."""
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 4))) for _ in range(3000)] + [None]
    df = column(spark, texts, "x", T.StringType()).withColumn("f", fold_case(F.col("x")))
    x, f = F.col("x"), F.col("f")
    for rules in (R.CATEGORY_RULES, R.WEAPON_RULES, R.SEVERITY_RULES):
        fast, slow = classify(x, rules, "-", "none", folded=f), classify(x, rules, "-", "none")
        assert df.filter(~fast.eqNullSafe(slow)).count() == 0
        assert df.select(slow).distinct().count() >= 3
    for pattern in (R.DOMESTIC_PATTERN, R.DWELLING_PATTERN, R.CLOSED_STATUS_PATTERN, "(?i)homicide",
                    "(?i)car.*theft", "kill|MURDER", "(?i)(kill)|"):
        fast, slow = contains_any(x, pattern, f), x.rlike(pattern)
        assert df.filter(~fast.eqNullSafe(slow)).count() == 0, pattern
    plan = df.select(classify(x, R.CATEGORY_RULES, "-", folded=f))._jdf.queryExecution().toString()
    assert "motorcycle).*theft" in plan and "homicide|" not in plan
