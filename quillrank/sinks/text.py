"""Result sinks.

``write_lines`` writes ``a<TAB>b`` records (the original jobs' output
format, always newline-terminated). A full result is written by every task in
parallel; ``single_file=True`` is meant for bounded results such as a top-k
and merges them into one file. ``write_sorted_lines`` writes a full result in
order, range by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.operators.topk import UTF8, sort_all


def write_lines(df: DataFrame, path: str, columns: list[str] | None = None, *, sep: str = "\t",
                single_file: bool = False, mode: str = "overwrite") -> None:
    cols = columns or df.columns
    lines = df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))
    if single_file:
        # Only for bounded results: coalesce keeps the top-k's order within its one partition.
        lines = lines.coalesce(1)
    lines.write.mode(mode).text(path)


def write_sorted_lines(df: DataFrame, path: str, columns: list[str], value: str, *ties: str, sep: str = "\t",
                       ascending: bool = False, order: str = UTF8, mode: str = "overwrite") -> None:
    """A full result in total order: the part files, read by name, and the lines within them.

    The rows are cut into ranges of (value, ties), so many rows of one value
    still spread over several files as long as their ties differ. (Names of
    part files have five digits, and sort as texts up to 100,000 files.)
    """
    rows = sort_all(df, value, *ties, ascending=ascending, order=order)
    rows.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Distributed write of a full result (Parquet by default)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def show(df: DataFrame, k: int = 100) -> None:
    """Print the first k rows to the console."""
    df.show(k, truncate=False)
