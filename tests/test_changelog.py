"""Keyed changelog: incremental bucketed base, views, retention."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from wardlens.sinks import changelog as L

SCHEMA = "id string, n int, v string"


def batch(spark, path, number, *rows, schema=SCHEMA):
    L.write_upserts(spark.createDataFrame(list(rows), schema), number, path, "id")


def view(spark, path, **options):
    return {r.id: (r.n, r.v) for r in L.latest_view(spark, path, "id", **options).collect()}


def versions(spark, path):
    return {b: [L._number(f, "upto") for f in folders] for b, folders in L._bucket_versions(spark, path).items()}


def test_only_buckets_with_changed_keys_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "log")
    batch(spark, path, 0, *[(f"k{k}", k, "a") for k in range(40)], (None, 0, "null"))
    assert L.compact_log(spark, path, "id", buckets=8) == 0
    assert set(versions(spark, path)) == set(range(8))
    batch(spark, path, 1, ("k3", 300, "b"), (None, 1, "null again"))
    batch(spark, path, 2, ("k3", 301, "c"))
    assert L.compact_log(spark, path, "id", buckets=99) == 2  # the number of buckets stays
    changed = {b for b, found in versions(spark, path).items() if found == [0, 2]}
    assert 1 <= len(changed) <= 2 and all(found == [0] for b, found in versions(spark, path).items() if b not in changed)
    expected = {f"k{k}": (k, "a") for k in range(40)} | {"k3": (301, "c"), None: (1, "null again")}
    assert view(spark, path) == expected
    assert L.compact_log(spark, path, "id") == 2 and L.compacted_batches(spark, path) == [0, 2]  # nothing new
    batch(spark, path, 3, ("k5", 500, "d"), ("new", 1, "e"))
    assert view(spark, path) == expected | {"k5": (500, "d"), "new": (1, "e")}


def test_retention_deletes_covered_batches_and_old_versions(spark, tmp_path):
    path = str(tmp_path / "log")
    assert L.expire_log(spark, path) == []
    for number in range(4):
        batch(spark, path, number, *[(f"k{k}", number, "x") for k in range(number, 20)])
        if number in (1, 2):
            L.compact_log(spark, path, "id", buckets=4)
    before = view(spark, path)
    assert L.expire_log(spark, path, before=1) == [0] and L.logged_batches(spark, path) == [1, 2, 3]
    assert L.expire_log(spark, path) == [1, 2] and L.logged_batches(spark, path) == [3]
    assert set(map(tuple, versions(spark, path).values())) == {(2,)} and view(spark, path) == before
    L.compact_log(spark, path, "id")
    L.expire_log(spark, path)
    assert L.logged_batches(spark, path) == [] and view(spark, path) == before
    batch(spark, path, 4, ("k0", 9, "y"))
    assert view(spark, path) == before | {"k0": (9, "y")}


def test_unfinished_bases_and_replays_are_ignored(spark, tmp_path):
    path = str(tmp_path / "log")
    batch(spark, path, 0, ("a", 1, "x"), ("b", 1, "x"))
    L.compact_log(spark, path, "id", buckets=4)
    batch(spark, path, 1, ("a", 2, "y"))
    # A compaction that died has written buckets, but no _SUCCESS.
    unfinished = spark.createDataFrame([("a", 99, "broken", 1, 0)], f"{SCHEMA}, batch_id int, bucket int")
    unfinished.write.partitionBy("bucket").parquet(f"{path}.base/buckets=4/upto=1")
    (tmp_path / "log.base/buckets=4/upto=1/_SUCCESS").unlink()
    assert view(spark, path) == {"a": (2, "y"), "b": (1, "x")}
    batch(spark, path, 1, ("a", 2, "y"))
    assert L.compact_log(spark, path, "id") == 1 and view(spark, path) == {"a": (2, "y"), "b": (1, "x")}
    assert L.compact_log(spark, path, "id", upto=0) == 1


def test_order_within_a_batch_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    batch(spark, path, 0, ("a", 2, "late"), ("a", 1, "early"), ("a", None, "none"))
    L.compact_log(spark, path, "id", "n", buckets=2)
    wide = f"{SCHEMA}, extra double"
    batch(spark, path, 1, ("b", 1, "x", 0.5), schema=wide)
    L.compact_log(spark, path, "id", "n")
    batch(spark, path, 2, ("c", 1, "z", 1.5), schema=wide)
    rows = {r.id: (r.n, r.v, r.extra) for r in L.latest_view(spark, path, "id", "n").collect()}
    assert rows == {"a": (2, "late", None), "b": (1, "x", 0.5), "c": (1, "z", 1.5)}


def test_increments_are_added_up(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "area string, slot int, calls long"
    expected = collections.Counter()
    for number in range(5):
        rows = [(f"a{k % 3}" if k % 4 else None, k % 2, number + k) for k in range(12)]
        for area, slot, calls in rows:
            expected[(area, slot)] += calls
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/batch_id={number}")
        if number in (1, 3):
            L.compact_log(spark, path, ["area", "slot"], sums=["calls"], buckets=4)
            L.expire_log(spark, path)
    rows = L.latest_view(spark, path, ["area", "slot"], sums=["calls"]).collect()
    assert {(r.area, r.slot): r.calls for r in rows} == dict(expected) and len(rows) == len(expected)


def test_no_aggregation_carries_payloads(spark, tmp_path):
    path = str(tmp_path / "log")
    for number in range(2):
        batch(spark, path, number, *[(f"k{k}", k, "v" * 50) for k in range(50)])
        if not number:
            L.compact_log(spark, path, "id", buckets=4)
    plan = plan_of(L.latest_view(spark, path, "id"))
    assert "SortAggregate" not in plan and "LeftAnti" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*\(batch_id#\d+ > 0\)", plan)


def test_missing_log(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        L.latest_view(spark, str(tmp_path / "nothing"), "id")
    assert L.compact_log(spark, str(tmp_path / "nothing"), "id") is None
