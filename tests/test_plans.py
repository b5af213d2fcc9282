"""Shape of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from acceptance import catalog
from acceptance import testbed as T
from conftest import plan_of
from wardlens.operators import calls as C
from wardlens.operators import incidents as I
from wardlens.operators import metrics as M
from wardlens.operators import monitors as N

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return T.silver(spark, SF)


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", plan)]


def test_row_operators_stay_in_one_stage(silver):
    for job in (I.categorize, I.standardize, I.assess_quality, I.locate, I.time_dimensions,
                M.with_reporting):
        plan = plan_of(job(silver))
        assert "Exchange" not in plan and "Python" not in plan, job.__name__


def test_category_is_matched_once(silver):
    plan = silver.transform(I.categorize)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("manslaughter") == 1 and plan.count("lower(replace(replace(crime_description") == 1


def test_year_counts_read_no_data_columns(silver):
    assert read_columns(plan_of(M.incidents_by_year(silver))) == [set()]


def test_year_filter_prunes_partitions(silver):
    plan = plan_of(silver.filter(F.col("occurrence_year") == 2000).select("id"))
    assert re.search(r"PartitionFilters: \[[^\]]*occurrence_year[^\]]*2000", plan)
    assert read_columns(plan) == [{"id"}]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("CAST(id AS INT) reporting_lag_days", "'x' area_name", "1 other").write.parquet(
        str(tmp_path / "enriched"))
    plan = plan_of(M.reporting_lag(spark.read.parquet(str(tmp_path / "enriched"))))
    assert "GreaterThanOrEqual(reporting_lag_days,0)" in plan
    assert read_columns(plan) == [{"reporting_lag_days", "area_name"}]


def test_facts_are_hash_aggregated_on_the_map_side(silver, spark):
    plan = plan_of(M.area_year_counts(silver))
    assert "partial_count" in plan
    below_first_shuffle = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle and "Sort" not in below_first_shuffle
    slots = plan_of(N.slot_sums(T.calls(spark, SF), {"n": F.count("*")}, 5))
    assert "HashAggregate" in slots[slots.rindex("Exchange"):]


def test_enrichment_scans_facts_once_without_shuffle(silver):
    enriched, yoy, summary = M.business_metrics(silver)
    plan = plan_of(enriched)
    assert plan.count("BroadcastHashJoin") == 1 and "hashpartitioning" not in plan
    assert plan.count("crime_description") >= 1
    for small in (yoy, summary):
        assert "crime_description" not in plan_of(small) and "lake-" not in plan_of(small)


def test_windows_expand_counts_not_calls(spark):
    plan = plan_of(N.dispatch_windows(T.calls(spark, SF)))
    assert plan.index("Expand") < plan.rindex("Exchange"), "the expansion must be above the first shuffle"


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(C.top_incident_types(T.calls(spark, SF)))


def test_share_total_reuses_the_grouping(silver):
    share = M.reporting_speed_share(M.with_reporting(silver))
    assert "SinglePartition" not in plan_of(share).split("Subquery subquery")[0]
    share.collect()
    assert "ReusedExchange" in plan_of(share)


def test_no_python_in_any_query_and_no_cross_join(spark):
    for name, query in catalog.queries().items():
        if not name.startswith("stream_"):
            plan = plan_of(query(spark, SF))
            assert "Python" not in plan and "CartesianProduct" not in plan, name
            assert "BroadcastNestedLoopJoin" not in plan, name
