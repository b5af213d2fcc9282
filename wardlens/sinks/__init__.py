from wardlens.sinks.changelog import (
    compact, compact_log, compacted_batches, expire_log, latest_view, logged_batches, write_upserts,
)
from wardlens.sinks.tables import with_audit, write_daily_csv, write_gold, write_metrics, write_silver

__all__ = ["compact", "compact_log", "compacted_batches", "expire_log", "latest_view", "logged_batches", "with_audit",
           "write_daily_csv", "write_gold", "write_metrics", "write_silver", "write_upserts"]
