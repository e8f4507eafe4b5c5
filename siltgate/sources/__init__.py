from siltgate.sources.csv import malformed, scan_csv, write_csv
from siltgate.sources.files import (
    ReadableFiles,
    list_files,
    scan_readable,
    unreadable_files,
)
from siltgate.sources.staging import staging_dir, written
from siltgate.sources.tables import (
    by_month,
    clustered,
    clustered_by,
    create_schema,
    create_table,
    load_table,
    null_violations,
    read_month,
    read_table,
    register_table,
    save_table,
    table_ddl,
    write_by_month,
)

__all__ = [
    "ReadableFiles",
    "by_month",
    "clustered",
    "clustered_by",
    "create_schema",
    "create_table",
    "list_files",
    "load_table",
    "malformed",
    "null_violations",
    "read_month",
    "read_table",
    "register_table",
    "save_table",
    "scan_csv",
    "scan_readable",
    "staging_dir",
    "table_ddl",
    "unreadable_files",
    "write_by_month",
    "write_csv",
    "written",
]
