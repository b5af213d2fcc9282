"""Live-call topology: one stateless query for three outputs, one query per windowed monitor."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import partial
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlens.functions import with_share
from wardlens.operators import calls as C
from wardlens.operators import monitors as M
from wardlens.sinks.changelog import write_upserts
from wardlens.sources.schemas import CALL_DOCUMENT
from wardlens.sources.validation import rejected_documents


def with_event_time(calls: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Watermark on ``ts``: without delay, rows are dropped from windows that event time has closed."""
    return calls.withWatermark("ts", delay)


#: One batch at a time for each checkpoint. Stopping a query does not end its batch's function: in an
#: application that starts it again, that function could still overwrite what the new run has written.
_WRITING: defaultdict[str, Lock] = defaultdict(Lock)


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], name: str | None, checkpoint: str,
                  mode: str, trigger: dict) -> StreamingQuery:
    def one_at_a_time(batch: DataFrame, batch_id: int) -> None:
        with _WRITING[checkpoint]:
            write(batch, batch_id)

    writer = (stream.writeStream.outputMode(mode).trigger(**trigger)
              .option("checkpointLocation", checkpoint).foreachBatch(one_at_a_time))
    return (writer.queryName(name) if name else writer).start()


def refuse_foreign(stream: DataFrame, path: str, checkpoint: str) -> None:
    """A new checkpoint numbers batches from 0; in another run's output its rows would count as old."""
    context = stream.sparkSession.sparkContext

    def exists(name: str) -> bool:
        place = context._jvm.org.apache.hadoop.fs.Path(name)
        return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)

    if exists(path) and not exists(checkpoint):
        raise RuntimeError(f"{path} holds another run's output: keep its checkpoint or choose a new folder")


def _write_rejected(batch: DataFrame, batch_id: int, path: str) -> None:
    batch.withColumn("processed_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def start_rejected(parsed: DataFrame, root: str, checkpoints: str, trigger: dict | None = None,
                   schema: Mapping | None = None) -> StreamingQuery:
    """Keep what is no call below ``root/stream_rejected``.

    ``parsed`` are parsed calls, of which those with ``_corrupt`` text are kept; or, with a ``schema`` document,
    raw documents in ``value``, of which those that break it are kept with their reasons.
    """
    name = "stream_rejected"
    refuse_foreign(parsed, f"{root}/{name}", f"{checkpoints}/{name}")
    if schema is None:
        rejected = parsed.filter("_corrupt IS NOT NULL").select(F.col("_corrupt").alias("document"))
    else:
        rejected = rejected_documents(parsed, schema)
    return start_batches(rejected, partial(_write_rejected, path=f"{root}/{name}"), name, f"{checkpoints}/{name}",
                         "append", trigger or {"processingTime": "5 seconds"})


def upsert_sink(stream: DataFrame, path: str, key: str, checkpoint: str, mode: str = "update",
                trigger: dict | None = None, name: str | None = None, fmt: str = "parquet",
                **options: str) -> StreamingQuery:
    """Write a stream's rows by key, every 5 seconds unless ``trigger`` says otherwise.

    Failed tasks are retried and failed batches replayed from the checkpoint: rows are not lost.
    """
    if fmt == "parquet":
        refuse_foreign(stream, path, checkpoint)
    write = partial(write_upserts, path=path, key=key, fmt=fmt, **options)
    return start_batches(stream, write, name, checkpoint, mode, trigger or {"processingTime": "5 seconds"})


def _write_stateless(batch: DataFrame, batch_id: int, root: str) -> None:
    """Enriched, original and escalated calls of one micro-batch.

    The enriched calls are written first; the other two are read back from them. The source is read
    once, and nothing of the batch has to fit into executor memory.
    """
    spark, name = batch.sparkSession, "stream_calls_enriched"
    enriched = C.nest_calls(batch)
    write_upserts(enriched, batch_id, f"{root}/{name}", "call_id")
    written = spark.read.parquet(f"{root}/{name}/batch_id={batch_id}").select(enriched.columns)
    write_upserts(written.drop(*C.AREA_COLUMNS), batch_id, f"{root}/stream_calls", "call_id")
    escalated = C.escalate_calls(written.withColumn("area_name", F.col("location.area_name")))
    write_upserts(escalated, batch_id, f"{root}/stream_escalated_calls", "call_id")


def _write_statistics(batch: DataFrame, batch_id: int, path: str, by: str) -> None:
    """Counts so far with their shares; read twice, so the state is only computed once."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_upserts(with_share(batch, "count"), batch_id, path, by)
    finally:
        batch.unpersist()


def start_statistics(calls: DataFrame, root: str, checkpoints: str,
                     trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Running calls and shares per priority and per incident type."""
    started = {}
    for by in ("priority", "incident_type"):
        name = f"stream_stats_{by}"
        started[name] = start_batches(
            C.call_counts(calls, by), partial(_write_statistics, path=f"{root}/{name}", by=by),
            name, f"{checkpoints}/{name}", "complete", trigger or {"processingTime": "5 seconds"})
    return started


def start_streams(calls: DataFrame, stats: DataFrame, root: str, checkpoints: str,
                  trigger: dict | None = None, start_ts: datetime | None = None,
                  delay: str = "0 seconds", final_only: bool = False,
                  documents: DataFrame | None = None) -> dict[str, StreamingQuery]:
    """Start all outputs below ``root``; ``calls`` are parsed calls.

    With the raw ``documents`` that they were parsed from, those that break the schema of calls are kept
    with their reasons too.

    Windowed results are upserted whenever they change. ``final_only`` makes all of them final: one
    row per closed window.
    """
    trigger = trigger or {"processingTime": "5 seconds"}
    timed = with_event_time(calls, delay)
    mode = "append" if final_only else "update"
    monitors = {
        "stream_area_spikes": 
            (M.spike_detection(timed, start_ts=start_ts, final_only=final_only), mode),
        "stream_response_degradation":
            (M.response_degradation(timed, stats, final_only=final_only), mode),
        "stream_unit_utilization": (M.unit_utilization(timed), mode),
        "stream_dispatch_failures":
            (M.dispatch_failures(timed, stats, final_only=final_only), mode),
    }
    queries = {
        name: upsert_sink(M.with_result_key(stream), f"{root}/{name}", "result_key",
                          f"{checkpoints}/{name}", mode=output_mode, trigger=trigger, name=name)
        for name, (stream, output_mode) in monitors.items()
    }
    queries["stream_calls"] = start_batches(
        C.enrich_calls(calls, stats), partial(_write_stateless, root=root), "stream_calls",
        f"{checkpoints}/stream_calls", "append", trigger)
    if documents is not None:
        queries["stream_rejected"] = start_rejected(documents, root, checkpoints, trigger, CALL_DOCUMENT)
    return queries
