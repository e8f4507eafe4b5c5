from siltgate.plans.batch import (
    BatchResult,
    all_reports,
    clean_all,
    quarantine_reasons,
    run_batch,
)
from siltgate.plans.cleaning import (
    clean,
    clean_tagged,
    refused_rows,
    row_counts,
    unreadable_dates,
)
from siltgate.plans.increments import (
    add_orders,
    add_payments,
    compact_orders,
    current_reports,
    merge_batches,
)

__all__ = [
    "BatchResult",
    "add_orders",
    "add_payments",
    "all_reports",
    "clean",
    "clean_all",
    "clean_tagged",
    "compact_orders",
    "current_reports",
    "merge_batches",
    "quarantine_reasons",
    "refused_rows",
    "row_counts",
    "run_batch",
    "unreadable_dates",
]
