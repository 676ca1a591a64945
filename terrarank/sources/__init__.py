"""Sources (landed extracts) and sinks."""

from terrarank.sources.harmonize import empty_like, harmonize_columns, tag_from_path, union_extracts
from terrarank.sources.readers import (
    detect_key_column,
    first_nonempty,
    flatten_json_dimension,
    load_sources,
    parse_json_column,
    read_csv_extract,
    read_flat_json,
    read_parquet_or_empty,
    source_status,
    unwrap_items,
)
from terrarank.sources.sheets import cell, header_choices, read_lines, read_sheets, rows_below_headers
from terrarank.sources.sinks import (
    export_csv, is_complete, refresh_partitions, register_dataset, save_table, swap_table, write_if_absent, write_parquet,
)

__all__ = [
    "cell", "detect_key_column", "empty_like", "export_csv", "first_nonempty", "flatten_json_dimension", "harmonize_columns",
    "header_choices", "is_complete", "load_sources", "parse_json_column", "read_csv_extract", "read_flat_json", "read_lines",
    "read_parquet_or_empty", "read_sheets", "refresh_partitions", "register_dataset", "rows_below_headers", "save_table", "source_status",
    "swap_table", "tag_from_path", "union_extracts", "unwrap_items", "write_if_absent", "write_parquet",
]
