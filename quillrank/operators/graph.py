"""Graph preparation: distinct arcs, out-degree, dangling nodes, adjacency.

Arcs stay flat (src, dst) rows. A node's neighbour list is never gathered
into one row for the computation: flat rows shuffle evenly and let sums
combine map-side, and a hub with a huge out-degree is split by salting (see
:func:`salt_count`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.session import delete_path, scratch_path

# Out-links per salt bucket before a source is treated as a hub and split.
HUB_DEGREE = 100_000
# Hex digits of the target's hash that split every neighbour list.
CHUNK_DIGITS = 2


def distinct_arcs(arcs: DataFrame) -> DataFrame:
    """(src, dst) without duplicates (partial dedup in each task first)."""
    return arcs.select("src", "dst").dropDuplicates(["src", "dst"])


def out_degree(arcs_d: DataFrame) -> DataFrame:
    """(src, deg) over distinct arcs; a two-phase count, so hubs combine map-side."""
    return arcs_d.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))


def initial_ranks(deg: DataFrame, value: float = 1.0) -> DataFrame:
    """(id, rank): every node with an out-link starts at ``value``."""
    return deg.select(F.col("src").alias("id"), F.lit(float(value)).alias("rank"))


def dangling_nodes(labels: DataFrame, deg: DataFrame) -> DataFrame:
    """Label rows whose id has no out-link (duplicates kept, an anti-join).

    Every degree is above 0; reading it keeps the degree aggregate whole, so
    its shuffle is shared with the other branches of a plan instead of the
    arcs being read again.
    """
    return labels.join(deg.where("deg > 0").select(F.col("src").alias("id")), "id", "left_anti")


def label_count(labels: DataFrame) -> DataFrame:
    """One row (n): the number of distinct (id, name) label rows."""
    return labels.agg(F.count_distinct("id", "name").alias("n"))


def salt_count(deg: Column, hub_degree: int, max_salt: int | None = None) -> Column:
    """How many buckets a source's out-links are spread over: 1 for ordinary
    nodes, about deg / hub_degree for hubs (at most ``max_salt`` if given)."""
    n = F.greatest(F.lit(1), F.ceil(deg / F.lit(float(hub_degree))).cast("int"))
    return n if max_salt is None else F.least(F.lit(int(max_salt)), n)


def salt_of(dst: Column, nsalt: Column) -> Column:
    return F.pmod(F.xxhash64(dst), nsalt.cast("long")).cast("int")


def _joined_list(dsts: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(dsts)), lambda x: x.cast("string")), ",")


def adjacency(arcs: DataFrame, chunk_digits: int = CHUNK_DIGITS) -> DataFrame:
    """(src, chunk, dsts): sorted neighbours joined by commas, per source and chunk.

    A target's chunk is the first ``chunk_digits`` hex digits of the md5 of its
    id as text, for every source alike, so the grain does not depend on the
    data. A row holds about deg / 16**chunk_digits targets: take more digits
    for a graph of larger hubs, or :func:`adjacency_lists` for rows of a fixed length.
    """
    chunk = F.substring(F.md5(F.col("dst").cast("string").cast("binary")), 1, chunk_digits)
    return distinct_arcs(arcs).groupBy("src", chunk.alias("chunk")).agg(_joined_list(F.col("dst")).alias("dsts"))


def adjacency_lists(arcs: DataFrame, n: int = 1000) -> DataFrame:
    """(src, part, dsts): sorted neighbours joined by commas, ``n`` a row.

    Part 0 has a source's n smallest targets, part 1 the next n, and only the
    last may have fewer, whatever the degree. A target's place among its
    source's comes from a distributed rank: the arcs are sorted by ranges of
    (src, dst), which cut a hub into many tasks, each range counts its rows per
    source, and prefix sums over the ranges give where each one begins. A task
    holds the rows of one range, and a row of the result n targets. An arc
    without one of its ends is none.
    """
    spark = arcs.sparkSession
    rows = distinct_arcs(arcs).where("src IS NOT NULL AND dst IS NOT NULL").orderBy("src", "dst")
    rows = rows.select("src", "dst", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    path, out = scratch_path(spark, "ranges"), scratch_path(spark, "lists")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    runs = rows.groupBy("src", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("src", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    part = F.call_function("div", F.col("at") + F.col("shift"), F.lit(int(n)).cast("long")).alias("part")
    lists = rows.join(runs, ["src", "range"]).select("src", "dst", part).groupBy("src", "part").agg(_joined_list(F.col("dst")).alias("dsts"))
    lists.write.parquet(out)
    delete_path(spark, path)
    return spark.read.schema(lists.schema).parquet(out)
