"""Bulk table copies on Spark: sources, clean-up, chunks, loads, a control table, runs and streams."""

from tablelift.operators.chunks import (
    assign_chunks,
    chunk_plan,
    find_chunk_limits,
    key_index,
    page,
    page_by_row_number,
    page_sweep,
    slice_rows,
    union_chunks,
    with_row_index,
)
from tablelift.operators.columns import (
    cast_all_text,
    cast_for_target,
    encode_tsv,
    keep_last_columns,
    map_columns,
    project_columns,
    standardize_columns,
)
from tablelift.operators.control import ControlTable
from tablelift.operators.reports import copy_progress
from tablelift.operators.upsert import upsert
from tablelift.plans.copy import copy_in_chunks
from tablelift.plans.run import problems, run_config, run_summary
from tablelift.sinks import load, register_target, supported_targets
from tablelift.sources import read_source, register_source, row_count, run_query, supported_sources
from tablelift.streaming import stream_chunks, stream_copy, stream_into, stream_load

__all__ = [
    "ControlTable",
    "assign_chunks",
    "cast_all_text",
    "cast_for_target",
    "chunk_plan",
    "copy_in_chunks",
    "copy_progress",
    "encode_tsv",
    "find_chunk_limits",
    "keep_last_columns",
    "key_index",
    "load",
    "map_columns",
    "page",
    "page_by_row_number",
    "page_sweep",
    "problems",
    "project_columns",
    "read_source",
    "register_source",
    "register_target",
    "row_count",
    "run_config",
    "run_query",
    "run_summary",
    "slice_rows",
    "standardize_columns",
    "stream_chunks",
    "stream_copy",
    "stream_into",
    "stream_load",
    "supported_sources",
    "supported_targets",
    "union_chunks",
    "upsert",
    "with_row_index",
]
