"""Tables of the sf folder, written intermediate tables, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.session import delete_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def largest(df: DataFrame, rank: Column, n: int, *ties: str) -> DataFrame:
    """Rows of the largest ``rank`` (a whole number of few values), at most n.

    Only whole ranks are taken: the counts of the ranks, a few rows, tell from
    which one on the rows number n at most. No task sorts or gathers the best
    rows of all others. Where the first rank alone has more than n rows, its n
    first by ``ties`` are taken.
    """
    counts = sorted(((r["rank"], r["n"]) for r in df.groupBy(rank.alias("rank")).agg(F.count("*").alias("n")).collect() if r["rank"] is not None), reverse=True)
    total, cut = 0, None
    for value, many in counts:
        if total + many > n:
            break
        total, cut = total + many, value
    if cut is None:
        return df.where(rank == F.lit(counts[0][0])).orderBy(*ties).limit(n) if counts else df.where("false")
    return df.where(rank >= F.lit(cut))


def drawn(df: DataFrame, n: int, by: str) -> DataFrame:
    """At most n rows, drawn by a hash of a column in 4096 ranks (all rows where there are n or fewer)."""
    return largest(df, F.shiftrightunsigned(F.xxhash64(F.col(by)), 52), n, by)


def magnitude(count: Column) -> Column:
    """A positive count's binary logarithm in eighths, as a rank."""
    return F.floor(F.log2(count) * 8).cast("int")


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    ``save`` cuts lineage durably: a lost executor never makes an earlier step
    run again. ``finish`` writes the result and deletes every other table.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, label), {}

    def save(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path, compression=compression)
        if name in self.paths:
            self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.paths.pop(name))

    def finish(self, df: DataFrame) -> DataFrame:
        out = self.save(df, "result")
        self.drop(*[n for n in self.paths if n != "result"])
        return out


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``(node, root)`` of undirected ``links (a, b)``; root is the smallest node of the component.

    Alternating large-star and small-star rounds (Kiveris et al., 2014), each
    written to the scratch folder; nothing but a count and a checksum reaches
    the driver. A node of very many links is one row per link, spread by AQE.
    """
    def fingerprint(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        return r["n"], r["x"]

    edges = scratch.save(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    before = None
    for _ in range(64):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.save(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = scratch.save(small.where("a <> b").distinct(), "edges")
        now = fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle in 64 rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select("b", "b").distinct())
