from siltgate.streaming.history import UsedKeys
from siltgate.streaming.ingest import (
    clean_new_files,
    cleaned_since,
    ingest_new_files,
    read_cleaned,
    scan_csv_stream,
    settle_orphans,
)

__all__ = [
    "UsedKeys",
    "clean_new_files",
    "cleaned_since",
    "ingest_new_files",
    "read_cleaned",
    "scan_csv_stream",
    "settle_orphans",
]
