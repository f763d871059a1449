"""A keyed table of TF-IDF weights: many lookups without the corpus.

:func:`quillrank.operators.tfidf.tfidf_term` reads and tokenizes the whole
collection for its one term. A :class:`WeightTable` holds all weights once, in
buckets of the word and sorted by it. A lookup opens the one bucket its word is
in, and within it the row groups whose statistics admit the word; a table of
terms is joined in place, so only the terms move.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.operators.tfidf import BEFORE_COMMA, FULL, _output_title, tfidf
from quillrank.operators.topk import top_k
from quillrank.sinks.bucketed import open_bucketed, write_bucketed

#: Rows of a file of the table; a hot word's bucket is several files.
MAX_RECORDS = 20_000_000
_KEYS, _SORT = ("word",), ("word", "title")


class WeightTable:
    """Weights ``(word, title, tf, df, w)`` of one collection, by word."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.rows, self.buckets = rows, buckets

    @classmethod
    def build(cls, articles: DataFrame, path: str, buckets: int | None = None, *, keep_empty: bool = True,
              max_records: int = MAX_RECORDS) -> WeightTable:
        """Compute all weights of ``articles`` and write them to the new folder ``path``.

        ``buckets`` defaults to the number of shuffle partitions; about 1 GB a
        bucket reads well. The rows are rebalanced by word before they are
        written: adaptive execution hands a bucket to one task, and one that a
        hot word fills to several, each with a file of its own.
        """
        spark = articles.sparkSession
        buckets = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        weights = tfidf(articles, keep_empty=keep_empty, split_hot=True)
        rows = write_bucketed(weights.hint("rebalance", "word"), path, buckets, *_KEYS, sort=_SORT, max_records=max_records)
        said = {"buckets": buckets, "schema": rows.schema.jsonValue()}
        # a bounded record; names with an underscore are no data to Spark's readers
        spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{path.rstrip('/')}/_table")
        return cls(rows, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> WeightTable:
        """The table that :meth:`build` wrote to ``path``, also in another session."""
        said = json.loads(spark.read.text(f"{path.rstrip('/')}/_table").first()[0])
        return cls(open_bucketed(spark, path, T.StructType.fromJson(said["schema"]), said["buckets"], *_KEYS, sort=_SORT), said["buckets"])

    def lookup(self, *terms: str, title_key: str = FULL) -> DataFrame:
        """(word, title, tf, df, w) of a few terms: one bucket's files for each."""
        rows = self.rows.where(F.col("word") == terms[0] if len(terms) == 1 else F.col("word").isin(*terms))
        return rows.select("word", _output_title(title_key).alias("title"), "tf", "df", "w")

    def lookup_all(self, terms: DataFrame, column: str = "word", title_key: str = FULL) -> DataFrame:
        """(word, title, tf, df, w) of all terms of a table: each once, nulls and unknown ones left out."""
        wanted = terms.select(F.col(column).cast("string").alias("word"))  # a semi join takes repeated ones once
        return self.rows.join(wanted, "word", "left_semi").select("word", _output_title(title_key).alias("title"), "tf", "df", "w")

    def topk(self, term: str, k: int = 100, *, title_key: str = FULL, digits: int | None = None) -> DataFrame:
        """(title, w): as :func:`quillrank.operators.tfidf.tfidf_topk`, from the table."""
        scored = self.lookup(term, title_key=title_key).select("title", "w")
        if title_key == BEFORE_COMMA:
            scored = scored.groupBy("title").agg(F.max("w").alias("w"))
        return top_k(scored, "w", "title", k=k, digits=digits)
