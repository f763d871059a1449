"""Ordered top-k / bottom-k, full orders and row numbers.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only those reach the final merge, so no full sort and
no whole result on the driver. Ties are broken by the given columns, which
makes the order total. ``digits`` compares values after rounding, for results
that must agree with an engine that sums in a different order; by default the
values themselves are compared.

Texts are compared by code point (``order="utf8"``, Spark's own order) or, as
a Java string's ``compareTo`` does, by UTF-16 code unit (``order="utf16"``).
The two differ only beyond the basic plane: U+1F600 is a pair of units from
D800 on, and so comes before U+FF21.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.session import scratch_path

UTF8, UTF16 = "utf8", "utf16"
# monotonically_increasing_id: the partition is above these bits, the row within it below.
ROW_BITS = 33


def _key(value: str, digits: int | None) -> Column:
    return F.round(F.col(value), digits) if digits is not None else F.col(value)


def utf16_key(c: Column) -> Column:
    """A text's UTF-16 code units, big-endian: as bytes they compare as the units do."""
    return F.encode(c, "UTF-16BE")


def _order(df: DataFrame, value: str, ties: tuple[str, ...], digits: int | None, ascending: bool, order: str) -> list[Column]:
    if order not in (UTF8, UTF16):
        raise ValueError(f"unknown order {order!r}; use {UTF8!r} or {UTF16!r}")
    kinds = dict(df.dtypes)
    keys = [_key(value, digits), *[utf16_key(F.col(t)) if order == UTF16 and kinds[t] == "string" else F.col(t) for t in ties]]
    return [k.asc() if ascending else k.desc() for k in keys]


def top_k(df: DataFrame, value: str, *ties: str, k: int = 100, digits: int | None = None, order: str = UTF8) -> DataFrame:
    """The k rows with the largest ``value``; ties by ``ties`` descending."""
    return df.orderBy(*_order(df, value, ties, digits, False, order)).limit(k)


def bottom_k(df: DataFrame, value: str, *ties: str, k: int = 100, digits: int | None = None, order: str = UTF8) -> DataFrame:
    """The k rows with the smallest ``value``; ties by ``ties`` ascending."""
    return df.orderBy(*_order(df, value, ties, digits, True, order)).limit(k)


def sort_all(df: DataFrame, value: str, *ties: str, digits: int | None = None,
             ascending: bool = False, order: str = UTF8) -> DataFrame:
    """Full ordering of a result (range-partitioned sort, no limit)."""
    return df.orderBy(*_order(df, value, ties, digits, ascending, order))


def numbered(df: DataFrame, value: str, *ties: str, digits: int | None = None,
             ascending: bool = False, order: str = UTF8, column: str = "row") -> DataFrame:
    """``df`` with each row's place in the full order, from 1.

    The rows are sorted by ranges once and written with their partition and
    place; a row's number is its place plus the rows of the partitions before.
    Only those counts, one per partition, meet in one task and are broadcast.
    """
    spark = df.sparkSession
    rows = sort_all(df, value, *ties, digits=digits, ascending=ascending, order=order).withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path).withColumn("_part", F.shiftright("_at", ROW_BITS))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.col("_before") + 1
    return rows.join(F.broadcast(counts), "_part").select(*[F.col(f"`{c}`") for c in df.columns], place.alias(column))
