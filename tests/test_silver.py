"""Zones are written where their rows are made, without a shuffle of whole incidents, and compressed."""

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from acceptance import testbed as T
from wardlens.operators.incidents import with_case_columns
from wardlens.plans import batch
from wardlens.sinks import tables
from wardlens.sources import Lake, land_raw, read_raw


@pytest.fixture
def small_tables(spark, tmp_path):
    root = str(tmp_path / "tables")
    rows = {
        "nation": ([(k, f"NATION_{k}") for k in range(3)], "n_nationkey int, n_name string"),
        "customer": ([(k, k % 3) for k in range(6)] + [(1, 2), (None, 1)], "c_custkey long, c_nationkey int"),
        "orders": ([(k, k % 6, datetime(1995 + k % 7, 3, 1)) for k in range(40)] + [(7, 1, None), (None, 2, datetime(1999, 1, 1))],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": ([(k % 40, n, k * 11, None if k % 9 == 0 else k, float(k)) for k in range(60) for n in (1, 2)] + [(None, 1, 1, 1, 1.0)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_silver_of_the_tables_is_not_shuffled_again(spark, small_tables, monkeypatch):
    asked, write = [], T.write_silver

    def noted(incidents, lake, rebalance=True):
        asked.append((rebalance, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        write(incidents, lake, rebalance)

    monkeypatch.setattr(T, "write_silver", noted)
    silver = T.silver(spark, small_tables)
    assert [rebalance for rebalance, _ in asked] == [False]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == asked[0][1]
    wanted = with_case_columns(T.incident_rows(spark, small_tables)).select(silver.columns)
    assert silver.count() > 100 and silver.exceptAll(wanted).isEmpty() and wanted.exceptAll(silver).isEmpty()


@pytest.mark.parametrize("files", [2, tables.OPEN_YEARS])
def test_years_beyond_the_open_files_are_written_too(spark, small_tables, tmp_path, monkeypatch, files):
    monkeypatch.setattr(tables, "OPEN_YEARS", files)
    incidents = with_case_columns(T.incident_rows(spark, small_tables)).withColumn(
        "occurrence_year", (1900 + T.F.col("id") % 50).cast("int"))
    lake = Lake(str(tmp_path / "lake"))
    tables.write_silver(incidents.coalesce(1), lake, rebalance=False)
    back = spark.read.parquet(lake.silver)
    assert back.select("id", "occurrence_year").exceptAll(incidents.select("id", "occurrence_year")).isEmpty()
    assert back.count() == incidents.count()


def _bytes(folder: str) -> int:
    return sum(file.stat().st_size for file in Path(folder).rglob("part-*"))


def test_bronze_is_compressed_part_by_part(spark, tmp_path):
    header = "DR_NO,AREA NAME,Status"
    lines = [f'{k},"Area, {k % 3}",AA' for k in range(4000)]
    source = tmp_path / "plain.csv"
    source.write_text("\n".join([header, *lines]) + "\n")
    lake = Lake(str(tmp_path / "lake"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        land_raw(spark, str(source), lake)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    landed = [row.value for row in spark.read.text(lake.bronze).collect()]
    parts = len(list(Path(lake.bronze).glob("part-*")))
    assert parts > 1 and landed.count(header) == parts and sorted(set(landed) - {header}) == sorted(lines)
    assert _bytes(lake.bronze) * 2 < source.stat().st_size
    again = Lake(str(tmp_path / "again"))  # compressed files are landed and read like plain ones
    land_raw(spark, lake.bronze, again)
    ids = {row.DR_NO: row["AREA NAME"] for row in read_raw(spark, again.bronze).collect()}
    assert ids == {k: f"Area, {k % 3}" for k in range(4000)}


def test_the_batch_run_does_not_shuffle_incidents_into_silver(spark, small_tables, tmp_path, monkeypatch):
    asked, write = [], batch.write_silver

    def noted(incidents, lake, rebalance=True):
        asked.append(rebalance)
        write(incidents, lake, rebalance)

    monkeypatch.setattr(batch, "write_silver", noted)
    T.write_raw(T.raw_incidents(spark, small_tables), str(tmp_path / "source"))
    lake = Lake(str(tmp_path / "lake"))
    land_raw(spark, str(tmp_path / "source"), lake)
    silver = batch.build_silver(spark, lake)
    assert asked == [False]
    wanted = with_case_columns(T.incident_rows(spark, small_tables)).select(silver.columns)
    assert silver.exceptAll(wanted).isEmpty() and wanted.exceptAll(silver).isEmpty()
    tables.write_gold(silver, lake, "gold_x")
    tables.write_gold(silver, lake, "gold_y", compression="snappy")
    codecs = [{pq.ParquetFile(file).metadata.row_group(0).column(0).compression for file in Path(lake.gold(name)).glob("part-*")}
              for name in ("gold_x", "gold_y")]
    assert codecs == [{"ZSTD"}, {"SNAPPY"}]
