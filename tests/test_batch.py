"""How the batch run writes its files and collections."""

import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from acceptance import testbed as T
from wardlens.functions.rules import RAW_TO_CLEAN
from wardlens.plans import batch, run_batch
from wardlens.sources import Lake, land_raw

def _bytes(folder) -> int:
    return sum(file.stat().st_size for file in Path(folder).rglob("part-*"))


def test_raw_text_takes_a_low_level_of_gzip(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 1).select(
        F.col("id").alias("DR_NO"), F.sha1(F.col("id").cast("string")).alias("AREA NAME"), F.lit("2020 Feb 01 12:00:00 AM").alias("DATE OCC"))
    lines = rows.select(F.concat_ws(",", "DR_NO", "AREA NAME", "DATE OCC").alias("value"))
    header = spark.createDataFrame([("DR_NO,AREA NAME,DATE OCC",)], "value string")
    whole = header.unionAll(lines).coalesce(1)
    whole.write.text(str(tmp_path / "plain"))
    for level in ("FOUR", "DEFAULT_COMPRESSION"):
        whole.write.options(**{"compression": "gzip", "zlib.compress.level": level}).text(str(tmp_path / level))
    low, default = _bytes(tmp_path / "FOUR"), _bytes(tmp_path / "DEFAULT_COMPRESSION")
    assert low != default
    lake = Lake(str(tmp_path / "lake"))
    land_raw(spark, str(tmp_path / "plain"), lake)
    T.write_raw(rows, str(tmp_path / "source"))
    for folder in (lake.bronze, str(tmp_path / "source")):
        assert _bytes(folder) == low, folder
        assert sorted(spark.read.text(folder).collect()) == sorted(whole.collect())


def test_collections_are_written_side_by_side(spark, tmp_path):
    met = threading.Barrier(batch.WRITERS)

    def rows():
        met.wait(60)  # breaks unless so many are begun at once
        return spark.range(5)

    lake = Lake(str(tmp_path))
    spark.sparkContext.setLocalProperty("asked.by", "test")
    asked = []

    def named():
        asked.append(spark.sparkContext.getLocalProperty("asked.by"))
        return spark.range(7)

    names = [f"gold_{k}" for k in range(batch.WRITERS)]
    try:
        batch.publish(spark, lake, dict.fromkeys(names, rows) | {"gold_named": named})
    finally:
        spark.sparkContext.setLocalProperty("asked.by", None)
    assert [spark.read.parquet(lake.gold(name)).count() for name in names] == [5] * batch.WRITERS
    assert spark.read.parquet(lake.gold("gold_named")).columns == ["id", "indexed_at"] and asked == ["test"]


def test_a_failed_collection_fails_the_run_and_begins_no_more(spark, tmp_path):
    begun = []

    def fail():
        raise ValueError("no such table")

    def slow(name):
        def rows():
            begun.append(name)
            time.sleep(2)
            return spark.range(1)
        return rows

    names = [f"gold_{k}" for k in range(3 * batch.WRITERS)]
    with pytest.raises(ValueError, match="no such table"):
        batch.publish(spark, Lake(str(tmp_path)), {"gold_bad": fail} | {name: slow(name) for name in names})
    assert len(begun) < len(names) and names[-1] not in begun


def test_no_dictionary_is_built_of_ids(spark, tmp_path):
    rows = [{"DR_NO": k // 2, "AREA ": k % 3, "AREA NAME": f"Area {k % 3}", "DATE OCC": f"2020 Feb 0{1 + k % 3} 12:00:00 AM"} for k in range(3000)]
    lines = [",".join(RAW_TO_CLEAN), *(",".join(str(row.get(name, "")) for name in RAW_TO_CLEAN) for row in rows)]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    lake = Lake(str(tmp_path / "lake"))
    run_batch(spark, lake, str(tmp_path / "a.csv"))
    for folder in (lake.silver, lake.metrics("enriched"), lake.gold("gold_business_metrics"), lake.gold("gold_time_dimensions")):
        for file in Path(folder).rglob("part-*"):
            groups = pq.ParquetFile(file).metadata
            columns = [groups.row_group(g).column(c) for g in range(groups.num_row_groups) for c in range(groups.num_columns)]
            with_dictionary = {c.path_in_schema for c in columns if c.has_dictionary_page}
            assert "id" not in with_dictionary and "area_name" in with_dictionary, file
        assert {r.id for r in spark.read.parquet(folder).select("id").collect()} == set(range(1500))
