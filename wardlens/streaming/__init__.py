from wardlens.streaming.daily import read_daily_csv, start_daily_csv, write_daily_batch
from wardlens.streaming.slots import (
    calls_view, escalated_view, late_counts, late_view, maintain, monitor_view, slots_view, start_slot_monitors,
)
from wardlens.streaming.topology import (
    start_rejected, start_statistics, start_streams, upsert_sink, with_event_time,
)

__all__ = ["calls_view", "escalated_view", "late_counts", "late_view", "maintain", "monitor_view", "read_daily_csv", "slots_view",
           "start_daily_csv", "start_rejected", "start_slot_monitors", "start_statistics", "start_streams", "upsert_sink", "with_event_time",
           "write_daily_batch"]
