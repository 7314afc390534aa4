"""Sources and sinks."""

from .extracts import ROW_INDEX, as_text, preview, read_extract, with_row_index
from .sinks import write_flagged, write_table
from .staging import clear_staged, drop_staged, stage, staging_root

__all__ = [
    "ROW_INDEX",
    "as_text",
    "clear_staged",
    "drop_staged",
    "preview",
    "read_extract",
    "stage",
    "staging_root",
    "with_row_index",
    "write_flagged",
    "write_table",
]
