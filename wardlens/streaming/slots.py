"""Live topology in one query: one read of the source, one table of slots, all monitors as sums of it.

Each micro-batch is decoded and enriched once and written; the rest derives from what was written:

    root/stream_calls_enriched   every call with its area's columns and whether it came late
    root/slots                   increments per (area, slot), see ``operators.slots``
    root/clocks                  event time of each area after the batch
    root/stream_area_spikes, ...  windows that the batch touched, each with its ``active`` flag

Event time is kept per area: it is the latest timestamp of the area's calls in earlier batches. A call is late
if its slot ended more than ``delay`` before that. An area whose clock runs ahead closes its own slots only,
where one watermark for the whole stream would drop every other area's calls. Late calls are kept
and marked, and each batch's slots count them; they change no window.

The state is tables in the changelog's layout: a replayed batch reads the clocks of the batch before it and replaces its
own folders. State is one row per area, so a hot area costs no more than others: its calls are
counted where they are read. Calls without an area or time are written, but counted nowhere.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlens.operators import calls as C
from wardlens.operators import monitors as M
from wardlens.operators import slots as S
from wardlens.operators.lookup import attach
from wardlens.sinks.changelog import compact_log, expire_log, latest_view, logged_batches, write_upserts
from wardlens.streaming.topology import refuse_foreign, start_batches

MONITORS = ("stream_area_spikes", "stream_response_degradation", "stream_unit_utilization", "stream_dispatch_failures")


def _monitors(slots: DataFrame, stats: DataFrame, start_ts: datetime | None) -> dict[str, DataFrame]:
    return {
        "stream_area_spikes": S.slot_spikes(slots, start_ts=start_ts, everything=True),
        "stream_response_degradation": S.slot_degradation(slots, stats, everything=True),
        "stream_unit_utilization": S.slot_utilization(slots, everything=True),
        "stream_dispatch_failures": S.slot_failures(slots, stats, everything=True),
    }


def _clocks_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """area, clock: event time of each area when the batch begins."""
    earlier = [n for n in logged_batches(spark, f"{root}/clocks") if n < batch_id]
    if not earlier:
        return spark.range(0).selectExpr("CAST(id AS STRING) AS area", "CAST(NULL AS TIMESTAMP) AS clock")
    return spark.read.schema("area string, clock timestamp").parquet(f"{root}/clocks/batch_id={earlier[-1]}")


def _write_batch(batch: DataFrame, batch_id: int, root: str, stats: DataFrame, delay: int,
                 start_ts: datetime | None) -> None:
    spark = batch.sparkSession
    clocks = _clocks_before(spark, root, batch_id)
    known = attach(C.enrich_calls(batch, stats), clocks, {"area": F.col("area_name")}, spread_by="call_id")
    slot_end = S.slot_start(F.col("ts")) + F.expr(f"INTERVAL '{S.SLOT_MINUTES}' MINUTE")
    late = F.coalesce(slot_end <= F.col("clock") - F.expr(f"INTERVAL '{delay}' SECOND"), F.lit(False))
    calls = f"{root}/stream_calls_enriched"
    marked = known.withColumns({"is_late": late, "arrived_in": F.lit(batch_id)}).drop("clock")
    write_upserts(C.nest_calls(marked), batch_id, calls, "call_id")

    written = spark.read.parquet(f"{calls}/batch_id={batch_id}").select("*", "location.area_name", "dispatch_info.*")
    S.slot_counters(written).write.mode("overwrite").parquet(f"{root}/slots/batch_id={batch_id}")
    news = (written.filter("area_name IS NOT NULL AND ts IS NOT NULL")
            .groupBy(F.col("area_name").alias("area")).agg(F.max("ts").alias("clock")))
    (clocks.unionByName(news).groupBy("area").agg(F.max("clock").alias("clock"))
     .write.mode("overwrite").parquet(f"{root}/clocks/batch_id={batch_id}"))

    # Windows that a slot of this batch lies in, made of all slots that they hold.
    low, high = spark.read.parquet(f"{root}/slots/batch_id={batch_id}").filter("calls > 0").agg(
        F.min("slot_start"), F.max("slot_start")).first()
    if low is None:
        return
    reach = F.expr(f"INTERVAL '{S.REACH}' MINUTE")
    near = slots_view(spark, root).filter(F.col("slot_start").between(F.lit(low) - reach, F.lit(high) + reach))
    near.persist(StorageLevel.MEMORY_AND_DISK)  # all monitors read it: a row per area and slot
    first, last = F.unix_millis(F.lit(low)), F.unix_millis(F.lit(high) + reach)
    try:
        for name, windows in _monitors(near, stats, start_ts).items():
            # All of a window's slots are at hand: it begins after ``low - reach`` and ends by ``high + reach``.
            touched = windows.filter((F.col("window_stop") > first) & (F.col("window_stop") <= last))
            write_upserts(M.with_result_key(touched), batch_id, f"{root}/{name}", "result_key")
    finally:
        near.unpersist()


def start_slot_monitors(calls: DataFrame, stats: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                        start_ts: datetime | None = None, delay: int = 0) -> StreamingQuery:
    """Start the topology below ``root``; ``calls`` are parsed calls, ``delay`` are seconds."""
    refuse_foreign(calls, f"{root}/slots", checkpoint)
    write = partial(_write_batch, root=root, stats=stats, delay=delay, start_ts=start_ts)
    return start_batches(calls, write, "slot_monitors", checkpoint, "append", trigger or {"processingTime": "5 seconds"})


# ---- views --------------------------------------------------------------------------------------

def slots_view(spark: SparkSession, root: str) -> DataFrame:
    return latest_view(spark, f"{root}/slots", S.KEY, sums=S.COUNTERS)


def calls_view(spark: SparkSession, root: str) -> DataFrame:
    """Enriched calls with ``is_late`` and the id of the batch that they ``arrived_in``."""
    return latest_view(spark, f"{root}/stream_calls_enriched", "call_id")


def escalated_view(spark: SparkSession, root: str) -> DataFrame:
    return C.escalate_calls(calls_view(spark, root).withColumn("area_name", F.col("location.area_name")))


def late_view(spark: SparkSession, root: str) -> DataFrame:
    """Calls that came after their slot was closed."""
    return calls_view(spark, root).filter("is_late")


def late_counts(spark: SparkSession, root: str) -> DataFrame:
    """Late and timely calls of each batch and area, from the batches that are not yet compacted."""
    return spark.read.parquet(f"{root}/slots").groupBy("batch_id", "area_name").agg(
        F.sum("late_calls").alias("late_calls"), F.sum("calls").alias("timely_calls"))


def monitor_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Windows of a monitor that exceed their limit as far as is known."""
    return latest_view(spark, f"{root}/{name}", "result_key").filter("active").drop("active", "window_stop")


def maintain(spark: SparkSession, root: str, upto: int) -> None:
    """Compact all tables up to a finished batch and delete what that replaces; may run beside the stream."""
    compact_log(spark, f"{root}/slots", S.KEY, upto=upto, sums=S.COUNTERS)
    compact_log(spark, f"{root}/stream_calls_enriched", "call_id", upto=upto)
    for name in MONITORS:
        compact_log(spark, f"{root}/{name}", "result_key", upto=upto)
    for name in ("slots", "stream_calls_enriched", *MONITORS):
        expire_log(spark, f"{root}/{name}", before=upto + 1, keep_versions=2)
