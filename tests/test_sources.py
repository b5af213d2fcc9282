"""Heads of files and checks of documents."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from wardlens.sources import CALL_DOCUMENT, accepted_documents, check_documents, file_heads, rejected_documents
from wardlens.sources import heads as H
from wardlens.sources import read_raw
from wardlens.streaming import start_rejected


def test_heads_read_no_more_than_the_first_line(spark, tmp_path):
    row = b"1,Central,10\n" * 80_000
    with open(tmp_path / "big.csv", "wb") as out:
        out.write(b"DR_NO,AREA NAME,TIME OCC\n")
        for _ in range(50):
            out.write(row)
    assert (tmp_path / "big.csv").stat().st_size > 50e6
    (tmp_path / "small one.csv").write_bytes(b"DR_NO,TIME OCC\r\n7,3\r\n")
    (tmp_path / "old.csv").write_bytes(b"A,B\r1,2")
    (tmp_path / "long.csv").write_bytes(b"x" * 200_000)
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\nDR_NO\n")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"Z\n1\n"))
    found = {r.file.rsplit("/", 1)[1]: (r.header, r.bytes_read) for r in file_heads(spark, str(tmp_path)).collect()}
    assert {name: header for name, (header, _) in found.items()} == {
        "big.csv": "DR_NO,AREA NAME,TIME OCC", "small%20one.csv": "DR_NO,TIME OCC", "old.csv": "A,B", "long.csv": "x" * 200_000,
        "blank.csv": "", "packed.csv.gz": "Z"}
    assert found["big.csv"][1] == H.BLOCK
    grouped = H.files_by_header(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in grouped["DR_NO,TIME OCC"]] == ["small one.csv"]


def test_scan_finds_the_same_heads(spark, tmp_path, monkeypatch):
    (tmp_path / "a b.csv").write_text("DR_NO,TIME OCC\n7,3\n8,4\n")
    (tmp_path / "c.csv").write_text("TIME OCC,DR_NO\n5,9\n")
    rows = lambda: sorted((r.DR_NO, r["TIME OCC"]) for r in read_raw(spark, str(tmp_path)).collect())
    opened, read = H.files_by_header(spark, str(tmp_path)), rows()
    monkeypatch.setattr(H, "_openable", lambda file: False)
    plain = lambda groups: {header: [f.replace("file:///", "file:/") for f in files] for header, files in groups.items()}
    assert plain(H.files_by_header(spark, str(tmp_path))) == plain(opened) and rows() == read == [(7, 3), (8, 4), (9, 5)]


GOOD = {"call_id": "a", "timestamp": "2024-01-01T10:00:00.5", "call_type": "TRANSFER", "incident_type": "FIRE", "priority": 5,
        "location": {"latitude": 1, "longitude": -2.5}, "status": "CLOSED"}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


CASES = [
    (GOOD, []),
    (GOOD | {"priority": 3.0, "more": [1], "dispatch_info": {"units_dispatched": [], "is_dispatched": True}}, []),
    (without("call_id") | {"priority": 0}, ["call_id is missing", "priority is out of range"]),
    (GOOD | {"priority": 6}, ["priority is out of range"]),
    (GOOD | {"priority": 2.5}, ["priority is no integer"]),
    (GOOD | {"priority": "3"}, ["priority is no integer"]),
    (GOOD | {"call_id": None}, ["call_id is no string"]),
    (GOOD | {"call_type": "OTHER", "status": 7}, ["call_type has an unknown value", "status is no string"]),
    (GOOD | {"timestamp": "soon"}, ["timestamp is no date-time"]),
    (GOOD | {"location": {"latitude": "1", "address": 5}},
     ["location.address is no string", "location.latitude is no number", "location.longitude is missing"]),
    (GOOD | {"location": []}, ["location is no object"]),
    (without("location"), ["location is missing"]),
    (GOOD | {"dispatch_info": {"units_dispatched": ["a", 1], "response_time_minutes": "x", "is_dispatched": "no"}},
     ["dispatch_info.units_dispatched has items that are no string", "dispatch_info.response_time_minutes is no number",
      "dispatch_info.is_dispatched is no boolean"]),
    ([1, 2], ["document is no object"]),
    ({}, [f"{name} is missing" for name in ("call_id", "timestamp", "call_type", "incident_type", "priority", "location", "status")]),
]
TEXTS = [(None, ["document is not JSON"]), ("", ["document is not JSON"]), ("{broken", ["document is not JSON"]),
         ("null", ["document is no object"])]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(k, json.dumps(d)) for k, (d, _) in enumerate(CASES)] + [(100 + k, t) for k, (t, _) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "k int, value string")


def test_every_fault_has_its_reason(spark, documents):
    found = {r.k: r.reasons for r in check_documents(documents, CALL_DOCUMENT).collect()}
    assert found == {k: reasons for k, (_, reasons) in enumerate(CASES)} | {100 + k: reasons for k, (_, reasons) in enumerate(TEXTS)}


def test_documents_are_accepted_or_rejected(spark, documents):
    kept = accepted_documents(documents, CALL_DOCUMENT)
    assert kept.columns == documents.columns and {r.k for r in kept.collect()} == {0, 1}
    rejected = rejected_documents(documents.withColumn("value", F.col("value").cast("binary")), CALL_DOCUMENT)
    assert rejected.columns == ["k", "reasons", "document"] and rejected.count() == documents.count() - 2
    assert {r.document for r in rejected.filter("k >= 100").collect()} == {"", "{broken", "null"}
    assert check_documents(documents.limit(0), CALL_DOCUMENT).count() == 0


def test_reasons_are_kept_beside_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([json.dumps(GOOD), json.dumps(without("status")), "oops"]))
    stream = spark.readStream.text(str(tmp_path / "in"))
    start_rejected(stream, str(tmp_path / "out"), str(tmp_path / "check"), {"availableNow": True}, CALL_DOCUMENT).awaitTermination()
    kept = {r.document: r.reasons for r in spark.read.parquet(f"{tmp_path}/out/stream_rejected").collect()}
    assert kept == {json.dumps(without("status")): ["status is missing"], "oops": ["document is not JSON"]}


def test_checks_carry_names_of_types_not_values(spark):
    texts = [' \n{"a": 1.0, "b": {"c": null}}', "[1]", "  5", "null", '{"a": "1", "b": {"c": 1e2}}', '{"b": []}', "{", None]
    documents = spark.createDataFrame(list(enumerate(texts)), "k int, value string")
    schema = {"type": "object", "required": ["a"], "properties": {
        "a": {"type": "integer", "maximum": 3}, "b": {"type": "object", "properties": {"c": {"type": "number"}}}}}
    checked = check_documents(documents, schema)
    found = {row.k: row.reasons for row in checked.collect()}
    assert found == {0: ["b.c is no number"], 1: ["document is no object"], 2: ["document is no object"], 3: ["document is no object"],
                     4: ["a is no integer"], 5: ["a is missing", "b is no object"], 6: ["document is not JSON"], 7: ["document is not JSON"]}
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert "_value " not in plan and "RLIKE" not in plan.upper()
    assert all("variant_get" not in line for line in plan.splitlines() if "Generate" in line)
