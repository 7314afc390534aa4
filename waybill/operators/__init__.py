"""Table-level operators."""

from .mapping import (
    apply_overrides,
    columns_table,
    mapping_of,
    mapping_status,
    mappings_by_dataset,
    suggest_mappings,
)
from .materializing import (
    Materialized,
    flag_rows,
    materialize,
    record_totals,
    records_of,
    rejects_of,
    report_of,
    split_flagged,
)
from .metrics import (
    cost_by,
    exceptions_queue,
    known_places,
    kpis,
    reference_date,
    status_breakdown,
    status_counts,
    with_delivery_flags,
)
from .profiling import column_values, issue_total, profile, profile_many
from .questions import Answer, answer_for, ask, classify_questions, read_questions
from .standardize import (
    canonicalize_enum,
    normalize_places,
    standardize_dates,
    standardize_numbers,
    trim_text,
    upper_codes,
)
from .summing import exact_sums

__all__ = [
    "Answer",
    "Materialized",
    "answer_for",
    "apply_overrides",
    "ask",
    "canonicalize_enum",
    "classify_questions",
    "column_values",
    "columns_table",
    "cost_by",
    "exact_sums",
    "exceptions_queue",
    "flag_rows",
    "issue_total",
    "known_places",
    "kpis",
    "mapping_of",
    "mapping_status",
    "mappings_by_dataset",
    "materialize",
    "normalize_places",
    "profile",
    "profile_many",
    "read_questions",
    "record_totals",
    "records_of",
    "reference_date",
    "rejects_of",
    "report_of",
    "split_flagged",
    "standardize_dates",
    "standardize_numbers",
    "status_breakdown",
    "status_counts",
    "suggest_mappings",
    "trim_text",
    "upper_codes",
    "with_delivery_flags",
]
