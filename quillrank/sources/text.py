"""Delimited text sources.

Records are one per line. Parsing is a pure column function of the line, so
the file readers, the streaming readers and the table-backed queries all share
it. ``path`` may be any Hadoop file system URI (a file, a directory or a glob
on HDFS, S3 via ``s3a://``, ``file:``...); Spark splits the files into tasks.

Modes follow Spark's reader options:

* ``FAILFAST`` (default): a record missing a required field fails the job,
  as the original jobs did.
* ``DROPMALFORMED``: such records are dropped.

:func:`quarantine` (``QUARANTINE`` in the jobs) is the third way: one pass
over the lines writes good and bad records apart and counts both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillrank.functions.text import TAB, WHITESPACE, field, split_fields

FAILFAST = "FAILFAST"
DROPMALFORMED = "DROPMALFORMED"
QUARANTINE = "QUARANTINE"
ARTICLES, ARCS, LABELS = "articles", "arcs", "labels"
DELIMITERS = {"tab": TAB, "\t": TAB, "ws": WHITESPACE, "whitespace": WHITESPACE, WHITESPACE: WHITESPACE}


def _delimiter(delimiter: str) -> str:
    return DELIMITERS.get(delimiter, delimiter)


def is_whitespace(delimiter: str) -> bool:
    return _delimiter(delimiter) == WHITESPACE


def check_records(df: DataFrame, malformed: Column, value: Column, mode: str, what: str) -> DataFrame:
    mode = mode.upper()
    if mode == DROPMALFORMED:
        return df.where(~malformed)
    if mode != FAILFAST:
        raise ValueError(f"unknown mode {mode!r}; use FAILFAST or DROPMALFORMED")
    # The check is a plain predicate, so it fuses into the scan's codegen stage.
    error = F.raise_error(F.concat(F.lit(f"malformed {what} record: "), value))
    return df.where(F.when(malformed, error).otherwise(F.lit(True)))


def _split(lines: DataFrame, value: str, delimiter: str) -> DataFrame:
    """(_line, _parts): each record split once. Every field and the check read
    the generated column, so the optimizer can't write the split into each of them."""
    v = F.col(value)
    return lines.select(v.alias("_line"), F.explode(F.array(split_fields(v, delimiter))).alias("_parts"))


def _article_fields(lines: DataFrame, value: str) -> tuple[DataFrame, Column]:
    """Parsed records with their line, and which of them are malformed."""
    parts = F.col("_parts")
    df = _split(lines, value, TAB).select(
        "_line",
        field(parts, 0).alias("article_id"),
        field(parts, 1).alias("title"),
        field(parts, 2).alias("ts"),
        field(parts, 3).alias("body"),
        field(parts, 4).alias("plain"),
    )
    return df, F.col("title").isNull() | F.col("body").isNull()


def _pair_fields(lines: DataFrame, names: tuple[str, str], delimiter: str, value: str) -> tuple[DataFrame, Column]:
    parts = F.col("_parts")
    a, b = names
    df = _split(lines, value, _delimiter(delimiter)).select("_line", field(parts, 0).alias(a), field(parts, 1).alias(b))
    return df, F.col(b).isNull()


def parse_articles(lines: DataFrame, value: str = "value", mode: str = FAILFAST) -> DataFrame:
    """Tab-separated article records -> (article_id, title, ts, body, plain).

    Only title (field 1) and body (field 3) are required; ``ts`` and ``plain``
    are null when the record stops early.
    """
    df, malformed = _article_fields(lines, value)
    return check_records(df, malformed, F.col("_line"), mode, "article").drop("_line")


def parse_pairs(lines: DataFrame, names: tuple[str, str], delimiter: str = "tab",
                value: str = "value", mode: str = FAILFAST) -> DataFrame:
    """Two-field records (arcs ``src dst`` or labels ``id name``).

    With the whitespace delimiter a label is cut at its first space, exactly
    like splitting the whole line on whitespace runs.
    """
    df, malformed = _pair_fields(lines, names, delimiter, value)
    return check_records(df, malformed, F.col("_line"), mode, f"({names[0]}, {names[1]})").drop("_line")


@dataclass(frozen=True)
class Quarantined:
    """The two halves of an input: ``good`` records, ``bad`` lines (column record), and how many of each."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def quarantine(lines: DataFrame, kind: str, sink: str, delimiter: str = "tab", value: str = "value", mode: str = "errorifexists") -> Quarantined:
    """Parse ``articles``, ``arcs`` or ``labels`` and keep malformed records instead of failing or dropping them.

    One job reads the lines once and writes both halves under ``sink``:
    ``bad=false`` holds the parsed records as Parquet, ``bad=true`` the lines as
    they were. The counts are observed during that write. A null line is a
    malformed record of its own.
    """
    if kind == ARTICLES:
        df, malformed = _article_fields(lines, value)
    elif kind in (ARCS, LABELS):
        df, malformed = _pair_fields(lines, ("src", "dst") if kind == ARCS else ("id", "name"), delimiter, value)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    names = [c for c in df.columns if c != "_line"]
    bad = F.coalesce(malformed, F.lit(True))
    both = df.select(*[F.when(~bad, F.col(c)).alias(c) for c in names], F.when(bad, F.col("_line")).alias("record"), bad.alias("bad"))
    obs = Observation()
    both = both.observe(obs, F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad"))
    both.write.mode(mode).partitionBy("bad").parquet(sink)
    halves = lines.sparkSession.read.schema(both.schema).parquet(sink)
    return Quarantined(halves.where("NOT bad").select(*names), halves.where("bad").select("record"), dict(obs.get))


def read_articles(spark: SparkSession, path: str, mode: str = FAILFAST) -> DataFrame:
    return parse_articles(spark.read.text(path), mode=mode)


def read_arcs(spark: SparkSession, path: str, delimiter: str = "tab", mode: str = FAILFAST) -> DataFrame:
    return parse_pairs(spark.read.text(path), ("src", "dst"), delimiter, mode=mode)


def read_labels(spark: SparkSession, path: str, delimiter: str = "tab", mode: str = FAILFAST) -> DataFrame:
    return parse_pairs(spark.read.text(path), ("id", "name"), delimiter, mode=mode)


def escape_newlines(c: Column) -> Column:
    """Real line breaks become the two characters backslash, n (the dump format)."""
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def article_lines(articles: DataFrame) -> DataFrame:
    """Format (article_id, title, ts, body, plain) as dump lines in ``value``."""
    cols = ["article_id", "title", "ts", "body", "plain"]
    return articles.select(
        F.concat_ws(TAB, *[escape_newlines(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cols])
        .alias("value")
    )


def pair_lines(df: DataFrame, a: str, b: str, sep: str = TAB) -> DataFrame:
    return df.select(F.concat_ws(sep, F.col(a).cast("string"), F.col(b).cast("string")).alias("value"))
