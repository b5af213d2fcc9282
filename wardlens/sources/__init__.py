from wardlens.sources.calls import decode_text, parse_calls, read_calls_stream
from wardlens.sources.heads import file_heads
from wardlens.sources.lake import Lake, land_raw, load_area_stats, read_metrics, read_raw, read_silver
from wardlens.sources.schemas import CALL, CALL_DOCUMENT, RAW_INCIDENT
from wardlens.sources.validation import accepted_documents, check_documents, rejected_documents

__all__ = ["CALL", "CALL_DOCUMENT", "RAW_INCIDENT", "Lake", "accepted_documents", "check_documents", "decode_text", "file_heads", "land_raw", "load_area_stats", "parse_calls",
           "read_calls_stream", "read_metrics", "read_raw", "read_silver", "rejected_documents"]
