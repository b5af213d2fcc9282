"""Raw CSV to gold collections, and the shared scratch folder."""

import pytest
from pyspark.sql import functions as F

from wardlens.functions.rules import RAW_TO_CLEAN
from wardlens.plans import run_batch
from wardlens.session import materialize, scratch_dir
from wardlens.sinks import write_daily_csv, write_gold, write_upserts
from wardlens.streaming import read_daily_csv, write_daily_batch
from wardlens.sources import (
    Lake, land_raw, load_area_stats, read_calls_stream, read_metrics, read_raw, read_silver,
)

GOLD = {
    "gold_business_metrics", "gold_bm_area_summary", "gold_bm_yoy_crime_trends",
    "gold_bm_reporting_lag", "gold_bm_reporting_speed", "gold_crime_count_by_year",
    "gold_crime_categorization", "gold_categorical_standardization", "gold_data_quality",
    "gold_geographic_enrichment", "gold_time_dimensions",
}


def raw_line(i, **values):
    base = {
        "DR_NO": i, "Date Rptd": "2020 Feb 03 12:00:00 AM", "DATE OCC": "2020 Feb 01 12:00:00 AM",
        "TIME OCC": 5, "AREA ": 1 + i % 2, "AREA NAME": ["Central", "Harbor"][i % 2],
        "Rpt Dist No": 101, "Part 1-2": 1, "Crm Cd": 510, "Crm Cd Desc": "\"VEHICLE, STOLEN\"",
        "Mocodes": "0344 1402", "Vict Age": 30, "Vict Sex": "M", "Vict Descent": "W",
        "Premis Cd": 101, "Premis Desc": "STREET", "Weapon Used Cd": "", "Weapon Desc": "",
        "Status": "AA", "Status Desc": "Adult Arrest", "Crm Cd 1": 510, "Crm Cd 2": "",
        "Crm Cd 3": "", "Crm Cd 4": "", "LOCATION": "  100   Main  ST", "Cross Street": "",
        "LAT": 34.05, "LON": -118.24,
    }
    return ",".join(str(v) for v in (base | values).values())


HEADER = ",".join(RAW_TO_CLEAN)
SPECIAL = [
    {"Date Rptd": "soon", "DATE OCC": "", "TIME OCC": 2400},
    {"AREA ": "", "AREA NAME": "", "Vict Age": "old", "LAT": 0.0, "LON": 0.0},
    {"DATE OCC": "2019 Dec 31 11:30:00 PM", "TIME OCC": 2359, "Status": "IC"},
]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    (root / "source").mkdir()
    # two files with a header each
    lines = [raw_line(i) for i in range(40)] + [raw_line(40 + i, **v) for i, v in enumerate(SPECIAL)]
    (root / "source" / "a.csv").write_text("\n".join([HEADER, *lines[:20]]))
    (root / "source" / "b.csv").write_text("\n".join([HEADER, *lines[20:]]))
    lake = Lake(str(root))
    run_batch(spark, lake, str(root / "source"))
    return lake


def test_silver(spark, lake):
    rows = {r.id: r for r in read_silver(spark, lake).collect()}
    assert set(rows) == set(range(43))
    assert rows[0].street_address == "  100   Main  ST" and rows[0].crime_description == "VEHICLE, STOLEN"
    assert (rows[0].occurrence_year, rows[0].status_resolution) == (2020, "Closed")
    assert rows[0].weapon_description is None
    assert rows[40].occurrence_year is None and rows[40].date_reported is None
    assert rows[41].area_id is None and rows[41].victim_age is None
    assert (rows[42].occurrence_year, rows[42].status_resolution) == (2019, "Ongoing")


def test_every_collection_is_written(spark, lake, tmp_path):
    for name in GOLD:
        df = spark.read.parquet(lake.gold(name))
        assert "indexed_at" in df.columns and df.count() > 0, name
    for name in GOLD - {n for n in GOLD if "_bm_" in n or "year" in n}:
        assert spark.read.parquet(lake.gold(name)).count() == 43
    years = {(r.year, r["count"]) for r in spark.read.parquet(lake.gold("gold_crime_count_by_year")).collect()}
    assert years == {(None, 1), (2019, 1), (2020, 41)}
    assert {m: read_metrics(spark, lake, m).count() for m in ("yoy_stats", "area_summary", "enriched")} == {
        "yoy_stats": 5, "area_summary": 3, "enriched": 43}


def test_lookup_from_gold(spark, lake):
    assert {r.area_key for r in load_area_stats(spark, lake).collect()} == {"CENTRAL", "HARBOR"}
    with pytest.raises(Exception):
        load_area_stats(spark, Lake(lake.root + "/missing"))


def test_a_second_run_replaces_the_first(spark, lake):
    run_batch(spark, lake, f"{lake.root}/source")
    assert read_silver(spark, lake).count() == 43
    assert spark.read.parquet(lake.gold("gold_business_metrics")).count() == 43


def test_header_order_and_missing_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("AREA NAME,DR_NO,AREA ,Other\nHarbor,7,3,z\n")
    row = read_raw(spark, str(tmp_path / "x.csv")).first()
    assert row.asDict() == {"AREA NAME": "Harbor", "DR_NO": 7, "AREA ": 3, "Other": "z"}


def test_landing_keeps_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("DR_NO,TIME OCC,LOCATION\n007,0030, a \n8,x,\"b, c\"\n")
    lake = Lake(str(tmp_path))
    land_raw(spark, str(tmp_path / "x.csv"), lake)
    landed = spark.read.option("header", True).csv(lake.bronze)
    assert sorted(map(tuple, landed.collect())) == [("007", "0030", " a "), ("8", "x", "b, c")]
    typed = {r.DR_NO: r["TIME OCC"] for r in read_raw(spark, lake.bronze).collect()}
    assert typed == {7: 30, 8: None}


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    df = materialize(spark.range(5).withColumn("x", F.lit(None).cast("string")), "t")
    assert df.count() == 5 and df.inputFiles()[0].startswith(f"file://{scratch_dir(spark)}")


def test_connector_writers(spark):
    """Any other format gets a collection name, or a key to replace by."""
    df = spark.range(3)
    write_gold(df, Lake("/nowhere"), "gold_x", fmt="noop")
    write_upserts(df, 0, "/nowhere", "id", fmt="noop")
    with pytest.raises(Exception, match="mongodb"):
        write_gold(df, Lake("/nowhere"), "gold_x", fmt="mongodb")
    with pytest.raises(Exception, match="kafka"):
        read_calls_stream(spark, fmt="kafka", subscribe="calls")


def test_daily_csv_appends(spark, tmp_path):
    flat = spark.createDataFrame([("a", "2024-01-01T10:00:00"), ("b", "2024-01-02T10:00:00"), ("c", "?")],
                                 "call_id string, timestamp string")
    for _ in range(2):
        write_daily_csv(flat, str(tmp_path / "calls"))
    back = spark.read.option("header", True).csv(str(tmp_path / "calls"))
    assert {(r.call_date, r["count"]) for r in back.groupBy("call_date").count().collect()} == {
        (20240101, 2), (20240102, 2), (None, 2)}


def test_raw_columns_follow_each_files_header(spark, tmp_path):
    source = tmp_path / "drop zone"
    source.mkdir()
    (source / "a.csv").write_text("DR_NO,AREA NAME,TIME OCC\n1,Central,10\n")
    (source / "b.csv").write_text("DR_NO,TIME OCC,AREA NAME,LOCATION\n2,11,Harbor,\"he said \"\"hi, you\"\"\",surplus\n")
    (source / "c.csv").write_text("DR_NO,TIME OCC,AREA NAME,LOCATION\n")
    lake = Lake(str(tmp_path))
    land_raw(spark, str(source), lake)
    landed = {r.value for r in spark.read.text(lake.bronze).collect()}
    assert '2,11,Harbor,"he said ""hi, you""",surplus' in landed
    for path in (str(source), lake.bronze):
        rows = {r["DR_NO"]: r for r in read_raw(spark, path, escape='"').collect()}
        assert set(rows) == {1, 2}
        assert (rows[1]["AREA NAME"], rows[1]["TIME OCC"], rows[1]["LOCATION"]) == ("Central", 10, None)
        assert (rows[2]["AREA NAME"], rows[2]["TIME OCC"], rows[2]["LOCATION"]) == ("Harbor", 11, 'he said "hi, you"')


def test_a_drop_without_rows_passes(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text(HEADER + "\n")
    lake = Lake(str(tmp_path))
    run_batch(spark, lake, str(tmp_path / "drop"))
    assert read_silver(spark, lake).count() == 0 and "occurrence_year" in read_silver(spark, lake).columns
    assert {spark.read.parquet(lake.gold(name)).count() for name in GOLD} == {0}


def test_daily_csv_of_a_stream_survives_replays(spark, tmp_path):
    path, schema = str(tmp_path / "daily"), "call_id string, timestamp string"
    rows = lambda *pairs: spark.createDataFrame(list(pairs), schema)
    first = rows(("a", "2024-01-01T10:00:00"), ("b", "2024-01-02T10:00:00"), ("c", "?"))
    write_daily_batch(first, 0, path)
    write_daily_batch(rows(("d", "2024-01-02T11:00:00")), 1, path)
    expected = {("a", "20240101", 0), ("b", "20240102", 0), ("c", None, 0), ("d", "20240102", 1)}
    view = lambda: [tuple(r) for r in read_daily_csv(spark, path, first.schema).select("call_id", "call_date", "batch_id").collect()]
    assert set(view()) == expected and len(view()) == 4
    write_daily_batch(first, 0, path)  # replayed
    assert set(view()) == expected and len(view()) == 4
    # An attempt that died left files, also in a day that the replay has no calls of.
    left = rows(("b", "2024-01-02T10:00:00"), ("z", "2024-01-05T10:00:00")).selectExpr("*", "'20240105' call_date", "2 batch_id")
    left.write.mode("append").partitionBy("call_date", "batch_id").option("header", True).csv(path)
    assert set(view()) == expected
    write_daily_batch(rows(("e", "2024-01-03T10:00:00")), 2, path)
    assert set(view()) == expected | {("e", "20240103", 2)}
    write_daily_batch(first.limit(0), 3, path)
    assert len(view()) == 5
