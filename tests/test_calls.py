"""Decoding, enrichment and counters of calls."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wardlens.operators import calls as C
from wardlens.sources import parse_calls

CALL = {
    "call_id": "c1", "timestamp": "2024-03-01T10:20:30.123456", "call_type": "EMERGENCY",
    "incident_type": "ROBBERY", "priority": 3,
    "location": {"address": "1 MAIN ST", "area_name": "Harbor", "latitude": 34.0, "longitude": -118.1},
    "caller_info": {"phone_number": "XXX-XXX-1234", "is_anonymous": False},
    "dispatch_info": {"units_dispatched": ["LAPD-1", "EMS-2"], "response_time_minutes": 4.5,
                      "is_dispatched": True},
    "status": "DISPATCHED",
}


def values(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) or d is None else json.dumps(d),)
                                  for d in documents], "value string")


def parsed(spark, *documents, **options):
    return parse_calls(values(spark, *documents), **options).collect()


def test_parse(spark):
    row = parsed(spark, CALL)[0]
    assert row._corrupt is None and row.ts == dt.datetime(2024, 3, 1, 10, 20, 30, 123456)
    assert (row.call_id, row.priority, row.area_name, row.latitude) == ("c1", 3, "Harbor", 34.0)
    assert (row.units_dispatched, row.response_time_minutes, row.is_dispatched) == (
        ["LAPD-1", "EMS-2"], 4.5, True)
    assert row.is_anonymous is False


def test_bad_and_partial_documents(spark):
    partial = {k: v for k, v in CALL.items() if k != "dispatch_info"} | {"extra": 1}
    wrong_type = CALL | {"priority": "urgent"}
    rows = parsed(spark, "{oops", partial, wrong_type, CALL | {"timestamp": "yesterday"})
    assert rows[0]._corrupt == "{oops" and rows[0].call_id is None
    assert rows[1]._corrupt is None and rows[1].is_dispatched is None
    assert rows[2]._corrupt is not None and rows[2].call_id == "c1"
    assert rows[3].ts is None and rows[3].call_id == "c1"


@pytest.mark.parametrize("text,zone,hour", [
    ("2024-01-01T12:00:00", "UTC", 12), ("2024-01-01T12:00:00", "America/Los_Angeles", 20),
    ("2024-01-01T12:00:00Z", "America/Los_Angeles", 12),
    ("2024-01-01T12:00:00+02:00", "America/Los_Angeles", 10),
])
def test_time_zones(spark, text, zone, hour):
    assert parsed(spark, CALL | {"timestamp": text}, zone=zone)[0].ts.hour == hour


def test_record_time(spark):
    df = values(spark, CALL).withColumn("timestamp", F.lit("2030-01-02 03:04:05").cast("timestamp"))
    row = parse_calls(df.withColumn("value", F.col("value").cast("binary")), "record").first()
    assert row.ts == dt.datetime(2030, 1, 2, 3, 4, 5) and row.timestamp == CALL["timestamp"]


def test_json_round_trip(spark):
    first = parse_calls(values(spark, CALL)).drop("ts", "_corrupt")
    text = C.encode_json(C.nest_calls(first))
    assert json.loads(text.first().value) == CALL
    assert parse_calls(text).drop("ts", "_corrupt").collect() == first.collect()


def stats(spark):
    return spark.createDataFrame(
        [("HARBOR", "High Risk", "Low Performance", "High Crime", 40.0, 80.0, 13.0),
         ("CENTRAL", "Low Risk", "High Performance", "Low Crime", 90.0, 10.0, 6.0)],
        "area_key string, area_risk_level string, area_performance_tier string, "
        "crime_density_category string, resolution_rate double, crime_density_percentile double, "
        "historical_avg_minutes double")


def some_calls(spark):
    return spark.createDataFrame(
        [("a", 3, "Assault", "Harbor"), ("b", 2, "ROBBERY", "HARBOR"), ("c", 5, "FIRE", "HARBOR"),
         ("d", 5, "weapon violation", "harbor"), ("e", 4, "ROBBERY", "Central"),
         ("f", 4, None, "HARBOR"), ("g", None, "ROBBERY", "HARBOR"), ("h", 9, "ROBBERY", "Mars"),
         ("i", 1, "ROBBERY", None)],
        "call_id string, priority int, incident_type string, area_name string")


def test_enrich_keeps_every_call(spark):
    rows = {r.call_id: r for r in C.enrich_calls(some_calls(spark), stats(spark)).collect()}
    assert len(rows) == 9
    assert rows["a"].area_risk_level == "High Risk" and rows["e"].resolution_rate == 90.0
    assert rows["h"].area_risk_level is None and rows["i"].resolution_rate is None
    filled = C.enrich_calls(some_calls(spark), stats(spark), fill_rate=True)
    assert {r.resolution_rate for r in filled.filter("call_id IN ('h', 'i')").collect()} == {0.0}


def test_escalation(spark):
    rows = C.escalate_calls(C.enrich_calls(some_calls(spark), stats(spark))).collect()
    assert {(r.call_id, r.original_priority, r.escalated_priority) for r in rows} == {
        ("a", 3, 2), ("d", 5, 4)}
    assert {r.escalation_reason for r in rows} == {"High risk area + violent incident type"}


def test_alerts_and_counters(spark):
    calls = some_calls(spark)
    assert {r.call_id for r in C.high_priority_calls(calls).collect()} == {"b", "i"}
    by_priority = {r.priority: (r["count"], r.pct) for r in C.call_stats(calls, "priority").collect()}
    assert by_priority == {1: (1, 11.1), 2: (1, 11.1), 3: (1, 11.1), 4: (2, 22.2), 5: (3, 33.3),
                           9: (1, 11.1)}
    top = [(r.incident_type, r["count"]) for r in C.top_incident_types(calls, 3).collect()]
    assert top == [("ROBBERY", 5), ("Assault", 1), ("FIRE", 1)]
    assert C.call_stats(calls, "incident_type").filter("incident_type = 'UNKNOWN'").count() == 1


def test_flat_calls(spark):
    row = C.flatten_calls(parse_calls(values(spark, CALL))).first().asDict()
    assert list(row) == ["call_id", "timestamp", "call_type", "incident_type", "priority", "address",
                         "area_name", "latitude", "longitude", "status", "is_dispatched",
                         "units_count", "response_time"]
    assert (row["units_count"], row["response_time"]) == (2, 4.5)


def test_documents_that_are_no_calls_are_set_aside(spark):
    rows = spark.createDataFrame([(None,), ("",), ("  ",), ("{}",), ('{"call_id": null}',), ('{"call_id": "a"}',)], "value string")
    parsed = parse_calls(rows).select("call_id", "_corrupt").collect()
    assert [r._corrupt for r in parsed] == ["", "", "  ", "{}", '{"call_id": null}', None]
