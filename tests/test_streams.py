"""Streams against the batch form of the same operators; late rows, restarts and replays."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from test_monitors import CALLS, SCHEMA, START, STATS
from wardlens.operators import calls as C
from wardlens.operators import monitors as N
from wardlens.sinks import compact, compact_log, latest_view, write_upserts
from wardlens.sources import parse_calls, read_calls_stream
from wardlens.streaming import start_statistics, start_streams, upsert_sink, with_event_time

NOW = {"availableNow": True}
AUDIT = ("processed_at", "processing_version")


def write_call_file(spark, path, calls):
    """One more Parquet file in the folder a stream reads."""
    spark.createDataFrame(calls, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def call_stream(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return with_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                           .parquet(str(path)))


def result(df):
    rows = df.drop(*AUDIT)
    return sorted((tuple(r) for r in rows.select(sorted(rows.columns)).collect()), key=repr)


def run(stream, base, mode="update", name="x", key="result_key"):
    upsert_sink(stream, f"{base}/{name}", key, f"{base}/{name}.checkpoint", mode, NOW).awaitTermination()
    return latest_view(stream.sparkSession, f"{base}/{name}", key)


@pytest.fixture(scope="module")
def in_order(spark, tmp_path_factory):
    """Calls in four files by event time, so that nothing is late."""
    path = tmp_path_factory.mktemp("calls") / "in"
    ordered = sorted(CALLS, key=lambda c: c[1])
    for i in range(0, len(ordered), 375):
        write_call_file(spark, path, ordered[i:i + 375])
    return path


@pytest.fixture(scope="module")
def stats(spark):
    rows = [(k, *v, "Tier", "Density", 50.0) for k, v in STATS.items()]
    return spark.createDataFrame(rows, "area_key string, area_risk_level string, "
                                 "historical_avg_minutes double, area_performance_tier string, "
                                 "crime_density_category string, resolution_rate double")


MONITORS = {
    "utilization": lambda calls: N.unit_utilization(calls),
    "dispatch": lambda calls: N.dispatch_windows(calls, final_only=False),
    "responses": lambda calls: N.response_averages(calls, final_only=False),
}


@pytest.mark.parametrize("name", MONITORS)
def test_updated_windows_equal_batch(spark, in_order, tmp_path, name):
    build = lambda calls: N.with_result_key(MONITORS[name](calls))
    got = run(build(call_stream(spark, in_order)), tmp_path)
    assert result(got) == result(build(spark.createDataFrame(CALLS, SCHEMA)))


@pytest.mark.parametrize("name,size,build", [
    ("dispatch", 15, lambda calls: N.dispatch_windows(calls)),
    ("responses", 30, lambda calls: N.response_averages(calls)),
    ("spikes", 5, lambda calls: N.spike_detection(calls, start_ts=START)),
])
def test_final_windows_equal_closed_batch_windows(spark, in_order, tmp_path, name, size, build):
    got = run(N.with_result_key(build(call_stream(spark, in_order))), tmp_path, "append")
    last = int((max(c[1] for c in CALLS) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    batch = N.with_result_key(build(spark.createDataFrame(CALLS, SCHEMA)))
    closed = batch.filter(F.col("window_start") + size * 60_000 <= last)
    assert result(got) == result(closed) and closed.count() > 2


def at(minute, area="A1"):
    return (f"m{minute}", START + dt.timedelta(minutes=minute), area, False, None, None)


def test_late_rows_change_open_windows_only(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "out"
    stream = lambda: N.with_result_key(N.dispatch_windows(call_stream(spark, source), final_only=False))
    write_call_file(spark, source, [at(3), at(21)])
    run(stream(), base)
    # event time is 21: the windows of minute 8 ending at 10, 15 and 20 are closed, all of them;
    # of minute 12, the one ending at 25 is open
    write_call_file(spark, source, [at(8), at(12)])
    rows = {(r.window_start - 1704067200000) // 60000: r.total_calls for r in run(stream(), base).collect()}
    assert rows == {-10: 1, -5: 1, 0: 1, 10: 2, 15: 1, 20: 1}


def test_restart_continues_and_replay_changes_nothing(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "out"
    build = lambda: N.with_result_key(N.unit_utilization(call_stream(spark, source)))
    ordered = sorted(CALLS, key=lambda c: c[1])
    write_call_file(spark, source, ordered[:700])
    run(build(), base)
    write_call_file(spark, source, ordered[700:])
    view = run(build(), base)
    batch = N.with_result_key(N.unit_utilization(spark.createDataFrame(CALLS, SCHEMA)))
    assert result(view) == result(batch)
    assert view.groupBy("result_key").count().filter("count > 1").count() == 0
    log = spark.read.parquet(f"{base}/x")
    written = log.count()
    again = log.filter("batch_id = 1").drop("batch_id", *AUDIT)
    write_upserts(spark.createDataFrame(again.collect(), again.schema), 1, f"{base}/x", "result_key")
    assert spark.read.parquet(f"{base}/x").count() == written
    assert result(latest_view(spark, f"{base}/x", "result_key")) == result(batch)


def test_latest_view_orders_within_a_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    write_upserts(spark.createDataFrame([("k", 1, "x"), ("k", 3, "z"), ("k", 2, "y"), ("j", 9, None)],
                                        "id string, n int, v string"), 0, path, "id")
    write_upserts(spark.createDataFrame([("j", 1, "new")], "id string, n int, v string"), 1, path, "id")
    rows = {r.id: (r.n, r.v, r.processing_version) for r in latest_view(spark, path, "id", "n").collect()}
    assert rows == {"k": (3, "z", "1.0.0"), "j": (1, "new", "1.0.0")}
    compact(spark, path, "id", str(tmp_path / "compact"), "n")
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2


def test_compacted_log_reads_its_base_and_later_batches(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "id string, n int, v string"
    batch = lambda number, *rows: write_upserts(spark.createDataFrame(list(rows), schema), number, path, "id")
    view = lambda: {r.id: (r.n, r.v) for r in latest_view(spark, path, "id").collect()}
    batch(0, ("k", 1, "x"), ("j", 2, None))
    batch(1, ("k", 5, "y"))
    before = view()
    assert compact_log(spark, path, "id") == 1 and view() == before == {"k": (5, "y"), "j": (2, None)}
    assert compact_log(spark, path, "id") == 1  # nothing new
    batch(2, ("j", 7, "z"), ("i", 8, "w"))
    plan = latest_view(spark, path, "id")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(batch_id#\d+ > 1\)", plan)
    expected = {"k": (5, "y"), "j": (7, "z"), "i": (8, "w")}
    assert view() == expected
    assert compact_log(spark, path, "id") == 2 and view() == expected


def test_topology_from_json_files(spark, tmp_path, stats):
    """JSON lines in, seven keyed outputs out; the malformed line is set aside."""
    (tmp_path / "in").mkdir()
    documents = []
    for i, (call_id, ts, area, dispatched, minutes, units) in enumerate(sorted(CALLS, key=lambda c: c[1])):
        documents.append(json.dumps({
            "call_id": call_id, "timestamp": ts.isoformat(), "call_type": "EMERGENCY",
            "incident_type": "Robbery", "priority": i % 5 + 1,
            "location": {"area_name": area, "latitude": 1.0, "longitude": 2.0},
            "dispatch_info": {"units_dispatched": units, "response_time_minutes": minutes,
                              "is_dispatched": dispatched}, "status": "RECEIVED"}))
    (tmp_path / "in" / "a.json").write_text("\n".join([*documents, "{broken"]))
    source = parse_calls(read_calls_stream(spark, path=str(tmp_path / "in")))
    good = source.filter("_corrupt IS NULL").drop("_corrupt")
    started = start_streams(good, stats, str(tmp_path / "out"), str(tmp_path / "checkpoint"), NOW,
                            start_ts=START)
    for query in started.values():
        query.awaitTermination()
    batch = parse_calls(spark.read.text(str(tmp_path / "in"))).filter("_corrupt IS NULL").drop("_corrupt")
    view = lambda name, key: latest_view(spark, f"{tmp_path}/out/{name}", key)
    assert batch.count() == len(CALLS)
    assert result(view("stream_calls", "call_id")) == result(C.nest_calls(batch))
    enriched = C.enrich_calls(batch, stats)
    assert result(view("stream_calls_enriched", "call_id")) == result(C.nest_calls(enriched))
    assert result(view("stream_escalated_calls", "call_id")) == result(C.escalate_calls(enriched))
    assert result(view("stream_response_degradation", "result_key")) == result(
        N.with_result_key(N.response_degradation(batch, stats)))
    assert result(view("stream_dispatch_failures", "result_key")) == result(
        N.with_result_key(N.dispatch_failures(batch, stats)))
    assert result(view("stream_unit_utilization", "result_key")) == result(
        N.with_result_key(N.unit_utilization(batch)))
    spikes = view("stream_area_spikes", "result_key")
    assert spikes.count() > 2
    assert result(spikes) == result(N.with_result_key(N.spike_detection(batch, start_ts=START)))
    for query in start_statistics(good, str(tmp_path / "out"), str(tmp_path / "checkpoint"), NOW).values():
        query.awaitTermination()
    for by in ("priority", "incident_type"):
        assert result(view(f"stream_stats_{by}", by)) == result(C.call_stats(batch, by))


def test_enrichment_beyond_the_broadcast_bound_runs_on_streams(spark, in_order, stats, tmp_path,
                                                               monkeypatch):
    from wardlens.operators import lookup
    monkeypatch.setattr(lookup, "measured_bytes", lambda df: lookup.BROADCAST_BYTES + 1)
    enriched = C.enrich_calls(call_stream(spark, in_order), stats)
    got = run(enriched, tmp_path, "append", key="call_id")
    monkeypatch.undo()
    assert result(got) == result(C.enrich_calls(spark.createDataFrame(CALLS, SCHEMA), stats))


def test_running_counters(spark, in_order, tmp_path):
    calls = call_stream(spark, in_order).withColumn("priority", F.length("call_id"))
    got = run(C.call_counts(calls, "priority"), tmp_path, "complete", key="priority")
    assert sum(r["count"] for r in got.collect()) == len(CALLS)


def test_rejected_documents_are_kept_and_foreign_outputs_refused(spark, tmp_path):
    from wardlens.sources import parse_calls, read_calls_stream
    from wardlens.streaming import start_rejected

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"call_id": "a"}\n{oops\n{}\n')
    parsed = parse_calls(read_calls_stream(spark, path=str(tmp_path / "in")))
    root = str(tmp_path / "out")
    start_rejected(parsed, root, str(tmp_path / "check"), {"availableNow": True}).awaitTermination()
    kept = spark.read.parquet(f"{root}/stream_rejected").collect()
    assert sorted(r.document for r in kept) == ["{oops", "{}"]
    with pytest.raises(RuntimeError):
        start_rejected(parsed, root, str(tmp_path / "another"), {"availableNow": True})
