"""Scans and writes."""

from pairloom.sources.readers import (
    PART,
    POS,
    first_record,
    land,
    load_named_splits,
    load_split_files,
    read_json_records,
    read_or_empty,
    scan,
    spread,
    text_fields,
    with_row_index,
)
from pairloom.sources.writers import (
    materialise_if_absent,
    split_file_report,
    write_json_arrays,
    write_json_texts,
    write_raw,
    write_splits,
)

__all__ = [
    "PART",
    "POS",
    "first_record",
    "land",
    "load_named_splits",
    "load_split_files",
    "materialise_if_absent",
    "read_json_records",
    "read_or_empty",
    "scan",
    "split_file_report",
    "spread",
    "text_fields",
    "with_row_index",
    "write_json_arrays",
    "write_json_texts",
    "write_raw",
    "write_splits",
]
