"""Every registered query, by name."""

from catalogue import chunks, columns, control, loads, runs, sources, streams
from catalogue.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "chunks", "columns", "control", "loads", "runs", "sources", "streams"]
