"""The slot table: its monitors against those over calls; late calls, restarts, compaction."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from test_monitors import CALLS, SCHEMA, START, STATS
from test_streams import NOW, call_stream, result, stats, write_call_file  # noqa: F401
from wardlens import streaming as live
from wardlens.operators import calls as C
from wardlens.operators import monitors as N
from wardlens.operators import slots as S
from wardlens.sinks import logged_batches

FULL = ["call_type", "incident_type", "priority", "address", "latitude", "longitude", "phone_number", "is_anonymous", "status", "timestamp"]


def full(calls):
    """Columns that enrichment and nesting expect."""
    return calls.select("*", *[F.lit(None).cast("int" if name == "priority" else "string").alias(name) for name in FULL])


def plain(df):
    return result(df.drop("window_stop"))


def test_monitors_of_slots_equal_those_of_calls(spark, stats):  # noqa: F811
    calls = spark.createDataFrame(CALLS, SCHEMA)
    slots = S.slot_counters(calls)
    pairs = [(S.slot_spikes(slots, start_ts=START), N.spike_detection(calls, start_ts=START)),
             (S.slot_spikes(slots), N.spike_detection(calls)),
             (S.slot_degradation(slots, stats), N.response_degradation(calls, stats)),
             (S.slot_utilization(slots), N.unit_utilization(calls)),
             (S.slot_failures(slots, stats), N.dispatch_failures(calls, stats))]
    for got, expected in pairs:
        assert plain(got) == result(expected) and got.count() > 2


def test_counters_of_odd_calls(spark):
    at = dt.datetime(2024, 1, 1, 0, 7)
    rows = [("a", at, "A", True, 3.0, ["LAPD-1", None, "lafd 2", "X"]), ("b", at, "A", False, 5.0, ["LAPD-1"]),
            ("c", at, "A", None, None, None), ("d", at, "A", True, 0.0, []), ("e", at, None, True, 1.0, ["EMS"]),
            ("f", None, "A", True, 1.0, ["EMS"])]
    (row,) = S.slot_counters(spark.createDataFrame(rows, SCHEMA)).collect()
    assert row.asDict() == {
        "area_name": "A", "slot_start": dt.datetime(2024, 1, 1, 0, 5), "calls": 4, "failures": 2, "answered": 1,
        "answered_minutes": 3.0, "units": 3, "lapd_units": 1, "lafd_units": 1, "ems_units": 0, "late_calls": 0}
    with pytest.raises(ValueError):
        S._windows(spark.createDataFrame([], "slot_start timestamp"), [], 17, 5)


def at(minute, area, name):
    return (name, START + dt.timedelta(minutes=minute), area, False, None, None)


def run(spark, source, base, stats, **options):  # noqa: F811
    live.start_slot_monitors(full(call_stream(spark, source)), stats, f"{base}/out", f"{base}/check", NOW, **options).awaitTermination()
    return f"{base}/out"


def test_each_area_has_its_own_event_time(spark, tmp_path, stats):  # noqa: F811
    source = tmp_path / "in"
    write_call_file(spark, source, [at(300, "AHEAD", "x"), at(21, "A1", "a")])
    write_call_file(spark, source, [at(12, "A1", "late"), at(20, "A1", "open"), at(30, "A1", "b"), at(3, "AHEAD", "y"), at(1, None, "n")])
    write_call_file(spark, source, [at(24, "A1", "closed now"), at(29.99, "A1", "ends at 30"), at(5, "NEW", "z"), at(33, "A1", "c")])
    root = run(spark, source, tmp_path, stats)
    assert {(r.call_id, r.arrived_in) for r in live.late_view(spark, root).collect()} == {
        ("late", 1), ("y", 1), ("closed now", 2), ("ends at 30", 2)}
    counts = {(r.batch_id, r.area_name): (r.late_calls, r.timely_calls) for r in live.late_counts(spark, root).collect()}
    assert counts == {(0, "AHEAD"): (0, 1), (0, "A1"): (0, 1), (1, "A1"): (1, 2), (1, "AHEAD"): (1, 0), (2, "A1"): (2, 1), (2, "NEW"): (0, 1)}
    slots = {(r.area_name, (r.slot_start - START).seconds // 60): r.calls for r in live.slots_view(spark, root).filter("calls > 0").collect()}
    assert slots == {("AHEAD", 300): 1, ("A1", 20): 2, ("A1", 30): 2, ("NEW", 5): 1}
    assert live.calls_view(spark, root).count() == 11


def test_delay_keeps_slots_open(spark, tmp_path, stats):  # noqa: F811
    source = tmp_path / "in"
    write_call_file(spark, source, [at(21, "A1", "a")])
    write_call_file(spark, source, [at(12, "A1", "b"), at(9, "A1", "late")])
    root = run(spark, source, tmp_path, stats, delay=400)
    assert {r.call_id for r in live.late_view(spark, root).collect()} == {"late"}


def views(spark, root):
    out = {name: result(live.monitor_view(spark, root, name)) for name in live.slots.MONITORS}
    return out | {"slots": sorted(map(tuple, live.slots_view(spark, root).collect()), key=repr),
                  "calls": result(live.calls_view(spark, root).select("call_id", "is_late", "area_risk_level", "arrived_in"))}


def test_outputs_follow_batches_restarts_replays_and_maintenance(spark, tmp_path, stats):  # noqa: F811
    source, ordered = tmp_path / "in", sorted(CALLS, key=lambda c: c[1])
    for k in range(0, 750, 375):
        write_call_file(spark, source, ordered[k:k + 375])
    root = run(spark, source, tmp_path, stats, start_ts=START)
    live.maintain(spark, root, upto=0)
    assert logged_batches(spark, f"{root}/slots") == [1]
    for k in range(750, len(ordered), 375):
        write_call_file(spark, source, ordered[k:k + 375])
    run(spark, source, tmp_path, stats, start_ts=START)
    calls = full(spark.createDataFrame(CALLS, SCHEMA))
    expected = {"stream_area_spikes": N.spike_detection(calls, start_ts=START),
                "stream_response_degradation": N.response_degradation(calls, stats),
                "stream_unit_utilization": N.unit_utilization(calls),
                "stream_dispatch_failures": N.dispatch_failures(calls, stats)}
    for name, df in expected.items():
        assert result(live.monitor_view(spark, root, name)) == result(N.with_result_key(df)), name
    assert live.late_view(spark, root).count() == 0
    assert result(live.escalated_view(spark, root)) == result(C.escalate_calls(C.enrich_calls(calls, stats)))
    before = views(spark, root)
    last = logged_batches(spark, f"{root}/slots")[-1]
    again = full(spark.createDataFrame(ordered[375 * last:375 * (last + 1)], SCHEMA))
    live.slots._write_batch(again, last, root, stats, 0, START)
    assert views(spark, root) == before
    live.maintain(spark, root, upto=last)
    assert logged_batches(spark, f"{root}/slots") == [] and views(spark, root) == before


def test_source_is_read_once_per_batch(spark, tmp_path, stats):  # noqa: F811
    """All but the first write of a batch read what it has written."""
    source = tmp_path / "in"
    write_call_file(spark, source, CALLS[:50])
    query = live.start_slot_monitors(full(call_stream(spark, source)), stats, f"{tmp_path}/out", f"{tmp_path}/check", NOW)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [50]
    with pytest.raises(RuntimeError):
        live.start_slot_monitors(full(call_stream(spark, source)), stats, f"{tmp_path}/out", f"{tmp_path}/other", NOW)
