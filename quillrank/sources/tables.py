"""Inputs derived from the driver's Parquet tables.

Each function only declares projections, filters and joins, so Catalyst
prunes the Parquet scan to the columns it needs and pushes the filters into
the reader (``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.sources.text import FAILFAST, check_records, is_whitespace

# Fixed value: the page title pattern of the fixture mapping.
TITLE_PATTERN = r"<title>([^<]*)</title>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def articles_from_pages(pages: DataFrame) -> DataFrame:
    """(article_id, title, body): the title is read out of the markup."""
    return pages.select(
        F.col("page_id").alias("article_id"),
        F.regexp_extract("html", TITLE_PATTERN, 1).alias("title"),
        F.col("html").alias("body"),
    )


def articles_from_documents(documents: DataFrame, title: str = "doc_id") -> DataFrame:
    """(article_id, title, body) from plain documents.

    ``title="doc_id"`` gives one title per document (``doc<id>``);
    ``title="source"`` merges all documents of a source under one title.
    """
    if title == "doc_id":
        t = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    elif title == "source":
        t = F.col("source")
    else:
        raise ValueError("title must be 'doc_id' or 'source'")
    return documents.select(F.col("doc_id").alias("article_id"), t.alias("title"), F.col("text").alias("body"))


def arcs_from_lineitem(lineitem: DataFrame, distinct: bool = True, returned_only: bool = True) -> DataFrame:
    """Arcs part -> part of the next line of the same order.

    ``returned_only`` takes returned lines alone (the first of them closed),
    which leaves parts without out-links; without it every line takes part.

    The join is on (order, line number), so one huge order still spreads
    over many tasks. ``(order, line number)`` is not unique, so the join
    multiplies duplicates: with ``distinct=True`` (the arc relation as
    defined) each side is deduplicated first, with a map-side partial
    aggregate, and the result is the distinct arc set. ``distinct=False``
    gives the raw bag, like an arc file with repeated lines. Of all lines, both
    sides are the same rows: they are read and deduplicated once.
    """
    if distinct and not returned_only:
        # Said here, the null filters are the same on both sides, which then share their shuffle.
        lines = lineitem.select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("part"))
        lines = lines.where("ok IS NOT NULL AND ln IS NOT NULL AND part IS NOT NULL").distinct()
        a, b = lines.alias("a"), lines.alias("b")
        arcs = a.join(b, F.expr("a.ok = b.ok AND a.ln + 1 = b.ln AND a.part <> b.part"))
        return arcs.select(F.col("a.part").alias("src"), F.col("b.part").alias("dst")).distinct()
    first, second = lineitem, lineitem
    if returned_only:
        first = lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
        second = lineitem.where(F.col("l_returnflag") == "R")
    a = first.select(
        F.col("l_orderkey").alias("ok"), (F.col("l_linenumber") + 1).alias("ln"), F.col("l_partkey").alias("src")
    )
    b = second.select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("dst")
    )
    if distinct:
        a, b = a.distinct(), b.distinct()
    arcs = a.join(b, ["ok", "ln"]).where(F.col("src") != F.col("dst")).select("src", "dst")
    return arcs.distinct() if distinct else arcs


def labels_from_part(part: DataFrame, delimiter: str = "tab", mode: str = FAILFAST) -> DataFrame:
    """(id, name) labels, as the text source gives them for ``id<TAB>name``
    records: a name ends at its first tab, or with the whitespace delimiter at
    its first space. A projection of the table, no record is written or parsed.
    The id keeps the part key's type."""
    name = F.col("p_name")
    if is_whitespace(delimiter):
        cut = F.regexp_extract(name, r"^\s*(\S*)", 1)
        malformed = name.isNull() | (cut == "")
    else:
        cut = F.substring_index(name, "\t", 1)
        malformed = name.isNull() | (F.rtrim(name, F.lit("\t")) == "")
    rows = part.where(F.col("p_partkey").isNotNull()).select(F.col("p_partkey").alias("id"), cut.alias("name"), malformed.alias("_bad"))
    return check_records(rows, F.col("_bad"), F.col("id").cast("string"), mode, "(id, name)").drop("_bad")
