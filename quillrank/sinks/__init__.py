"""Sinks: delimited text lines, tables, bucketed folders and the console."""

from quillrank.sinks.bucketed import open_bucketed, write_bucketed
from quillrank.sinks.text import show, write_lines, write_sorted_lines, write_table

__all__ = ["open_bucketed", "show", "write_bucketed", "write_lines", "write_sorted_lines", "write_table"]
