"""Business metrics against plain Python on small data with null areas and years."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from wardlens.operators import metrics as M
from wardlens.operators.area_stats import area_stats
from wardlens.operators.lookup import BROADCAST_BYTES, attach, hot_hashes, measured_bytes
from wardlens.session import materialize

ROWS = (
    [(1, "Central", 2019, "Closed")] * 10 + [(1, "Central", 2020, "Ongoing")] * 12
    + [(2, "Harbor", 2018, "Closed")] * 4 + [(2, "Harbor", 2020, "Closed")] * 2
    + [(3, "Mission", 2020, "Unknown")] * 6 + [(None, "Nowhere", 2020, "Closed")] * 3
    + [(2, "Harbor", None, "Ongoing")] * 2
)


def incidents(spark):
    rows = [(i, *row) for i, row in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "id long, area_id int, area_name string, occurrence_year int, status_resolution string"
    ).selectExpr("*", "DATE'2020-01-10' date_occured",
                 "date_add(DATE'2020-01-08', CAST(id * 3 AS INT)) date_reported")


def test_area_summary(spark):
    _, _, summary = M.business_metrics(incidents(spark))
    rows = {r.area_id: r for r in summary.collect()}
    assert len(rows) == 4
    assert (rows[1].resolution_rate, rows[1].area_performance_tier) == (45.45, "Low Performance")
    assert (rows[2].resolution_rate, rows[2].area_performance_tier) == (75.0, "High Performance")
    # four groups, the null area among them: sizes 3, 6, 8, 22
    assert [rows[k].crime_density_percentile for k in (3, 2, 1)] == [
        1 / 3 * 100, 2 / 3 * 100, 100.0]
    assert rows[1].crime_density_category == "Very High Crime"
    assert rows[None].area_name == "Nowhere"
    assert rows[None].resolution_rate is None and rows[None].crime_density_category is None


def test_yoy(spark):
    _, yoy, _ = M.business_metrics(incidents(spark))
    rows = {(r.area_id, r.occurrence_year): r for r in yoy.collect()}
    assert len(rows) == 7
    assert (rows[1, 2020].yoy_crime_change_pct, rows[1, 2020].crime_trend) == (20.0, "Increasing")
    # the undated group sorts first, so it is the previous "year" of 2018; 2019 has no incidents
    assert rows[2, 2018].yoy_crime_change_pct == 100.0
    assert (rows[2, 2020].yoy_crime_change_pct, rows[2, 2020].crime_trend) == (-50.0, "Decreasing")
    assert (rows[3, 2020].yoy_crime_change_pct, rows[3, 2020].crime_trend) == (None, "Unknown")
    undated, nowhere = rows[2, None], rows[None, 2020]
    assert undated.yearly_crime_count is None and undated.crime_trend is None
    assert undated.area_risk_score == round((2 / 3 * 0.4 + 0.25 * 0.3 + 0.2) * 100, 1)
    assert nowhere.area_risk_score is None and nowhere.area_risk_level == "Very Low Risk"


def test_enriched(spark):
    enriched, yoy, _ = M.business_metrics(incidents(spark))
    rows = enriched.collect()
    assert len(rows) == len(ROWS)
    assert Counter((r.area_id, r.occurrence_year) for r in rows) == Counter(
        (r[0], r[2]) for r in ROWS)
    levels = {(r.area_id, r.occurrence_year): (r.area_risk_score, r.area_risk_level,
                                               r.yearly_crime_count) for r in yoy.collect()}
    assert all((r.area_risk_score, r.area_risk_level, r.yearly_crime_count)
               == levels[r.area_id, r.occurrence_year] for r in rows)
    speeds = {r.id: (r.reporting_lag_days, r.reporting_speed) for r in rows}
    assert speeds[0] == (-2, "Next Day") and speeds[1] == (1, "Next Day")
    assert speeds[2] == (4, "Within Week") and speeds[10] == (28, "Within Month")
    assert speeds[11] == (31, "Delayed")


def test_equal_counts_share_a_rank_and_one_area_has_rank_zero(spark):
    areas = spark.createDataFrame([(i, 5 if i < 3 else 9) for i in range(4)], "area_id int, n long")
    ranks = {r.area_id: r.crime_density_percentile for r in M.density_percentile(areas, "n").collect()}
    assert ranks == {0: 0.0, 1: 0.0, 2: 0.0, 3: 100.0}
    single = M.density_percentile(areas.filter("area_id = 0"), "n").first()
    assert single.crime_density_percentile == 0.0


def test_speed_labels(spark):
    lags = [None, -5, 0, 1, 2, 7, 8, 30, 31]
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), None if x is None else dt.date(2020, 1, 1) + dt.timedelta(x))
         for x in lags], "date_occured date, date_reported date")
    assert [r.reporting_speed for r in M.with_reporting(df).collect()] == [
        "Unknown", "Next Day", "Same Day", "Next Day", "Within Week", "Within Week", "Within Month",
        "Within Month", "Delayed"]
    share = {r.reporting_speed: (r["count"], r.pct)
             for r in M.reporting_speed_share(M.with_reporting(df)).collect()}
    assert share["Next Day"] == (2, 22.2) and share["Unknown"] == (1, 11.1)


def test_reporting_lag_leaves_out_negative_and_huge_lags(spark):
    df = spark.createDataFrame([("A", -1), ("A", 0), ("A", 31), ("A", 366), ("B", 365), ("B", None)],
                               "area_name string, reporting_lag_days int")
    assert [tuple(r) for r in M.reporting_lag(df).collect()] == [
        ("B", 365.0, 100.0, 1), ("A", 15.5, 50.0, 2)]


def test_area_stats(spark):
    summary = spark.createDataFrame(
        [(1, "Central", "High Performance", "Low Crime", 80.0, 20.0),
         (2, "CENTRAL", "Low Performance", "High Crime", 10.0, 60.0),
         (3, None, "Low Performance", "High Crime", 10.0, 60.0)],
        "area_id int, area_name string, area_performance_tier string, "
        "crime_density_category string, resolution_rate double, crime_density_percentile double")
    yoy = spark.createDataFrame(
        [(1, "Central", 2020, "High Risk"), (1, "central", 2019, "Low Risk"),
         (1, "Central", None, "Medium Risk"), (9, "Harbor", None, "Low Risk"), (8, None, 2020, "x")],
        "area_id int, area_name string, occurrence_year int, area_risk_level string")
    rows = {r.area_key: r for r in area_stats(summary, yoy).collect()}
    assert set(rows) == {"CENTRAL", "HARBOR"}
    assert rows["CENTRAL"].area_performance_tier == "Low Performance"
    assert rows["CENTRAL"].area_risk_level == "High Risk"
    assert rows["CENTRAL"].historical_avg_minutes == 11.0
    assert (rows["HARBOR"].area_risk_level, rows["HARBOR"].resolution_rate,
            rows["HARBOR"].area_performance_tier, rows["HARBOR"].historical_avg_minutes) == (
        "Low Risk", 0.0, None, 5.0)


def test_both_join_ways_give_the_same_rows(spark, no_auto_broadcast):
    # a third of the rows on one key, a third without key
    facts = spark.range(3000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 7L WHEN 1 THEN NULL ELSE id END AS k", "id % 2 AS y")
    lookup = spark.range(0, 2000, 5).selectExpr("id AS k", "1L AS y", "id * 2 AS v").union(
        spark.sql("SELECT 7L, NULL, 99L")).union(spark.sql("SELECT 7L, 0L, 77L"))
    on = {"k": F.col("k"), "y": F.when(F.col("y") == 1, F.col("y"))}
    for how in ("left", "inner"):
        near = attach(facts, lookup, on, "id", null_safe=("y",), how=how)
        far = attach(facts, lookup, on, "id", null_safe=("y",), how=how, max_bytes=0)
        assert near.columns == far.columns == ["id", "k", "y", "v"]
        rows = sorted(map(tuple, near.collect()), key=lambda r: r[0])
        assert rows == sorted(map(tuple, far.collect()), key=lambda r: r[0])
        assert len(rows) == 3000 if how == "left" else 0 < len(rows) < 3000
        assert "SortMergeJoin" in plan_of(far) and "BroadcastHashJoin" in plan_of(near)


def test_large_lookup_join_spreads_hot_and_null_keys(spark, no_auto_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        facts = spark.range(90_000).selectExpr(
            "id", "CASE id % 3 WHEN 0 THEN 7L WHEN 1 THEN NULL ELSE id END AS k")
        lookup = spark.range(90_000).selectExpr("id AS k", "id * 2 AS v")
        sizes = {}
        for name, df in {"salted": attach(facts, lookup, {"k": F.col("k")}, "id", max_bytes=0),
                         "plain": facts.join(lookup, "k", "left")}.items():
            parts = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("v").alias("m"))
            sizes[name] = parts.agg(F.max("n"), F.sum("n"), F.sum("m")).first()
        assert sizes["salted"][1:] == sizes["plain"][1:] == (90_000, 60_000)
        assert sizes["salted"][0] < sizes["plain"][0] / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_only_hot_keys_are_copied(spark, no_auto_broadcast):
    """A third of the rows on one key and one in 150 on another: both are spread, the rest is not copied."""
    facts = spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 150 = 1 THEN 11 ELSE id END AS k")
    lookup = spark.range(60_000).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    assert hot_hashes(facts, F.xxhash64("k")) == sorted(
        r.h for r in spark.sql("SELECT xxhash64(7L) h UNION ALL SELECT xxhash64(11L)").collect())
    joined = attach(facts, lookup, {"k": F.col("k")}, "id", max_bytes=0)
    assert joined.count() == 60_000 and joined.filter("v = CAST(k AS STRING)").count() == 60_000
    even = spark.range(60_000).selectExpr("id", "id % 30000 AS k")
    assert hot_hashes(even, F.xxhash64("k")) == []
    plan = plan_of(attach(even, lookup, {"k": F.col("k")}, "id", max_bytes=0))
    assert "[0,1,2,3," not in plan and "CASE" not in plan[plan.index("Generate"):]
    copied = plan_of(joined)
    assert "CASE WHEN" in copied[copied.index("Generate"):]


def test_hot_keys_of_odd_frames(spark, no_auto_broadcast):
    empty = spark.range(0).selectExpr("id", "id AS k")
    lookup = spark.range(5).selectExpr("CAST(id AS INT) AS k", "id AS v")
    assert hot_hashes(empty, F.xxhash64("k")) == []
    assert attach(empty, lookup, {"k": F.col("k")}, "id", max_bytes=0).count() == 0
    # Keys of another type than the lookup's still meet.
    facts = spark.range(900).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 3L ELSE NULL END AS k")
    rows = attach(facts, lookup, {"k": F.col("k")}, "id", max_bytes=0).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in rows} == {3: 450, None: 450}


def test_sizes_of_small_files_need_no_job(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    group = "sizes"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert 0 < measured_bytes(small) < BROADCAST_BYTES
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("values", [[], [5], [3, 1, 2], [7, 7, 7], [None, 1, None, 4], list(range(300)) * 2 + [1000] * 50])
def test_ranks_by_ranges(spark, values):
    areas = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "area_id int, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked, total = M.ranked_below(areas.groupBy("n").agg(F.count("*").alias("areas")), "n", "areas")
        below = {r.n: r.below for r in ranked.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(values, key=lambda v: (v is not None, v or 0))
    assert total == len(values) and below == {v: order.index(v) for v in set(values)}
    if len(values) > 100:
        assert "SinglePartition" not in plan_of(ranked)


def test_percent_ranks_have_no_single_task(spark):
    areas = materialize(spark.range(500).selectExpr("id AS area_id", "id % 90 AS total_cases"), "areas")
    plan = plan_of(M.density_percentile(areas))
    assert "SinglePartition" not in plan and "Window" in plan
