"""Streaming article and graph sources, and incrementally maintained tf.

The original article job reads a directory of dump files. As a stream, new
files in that directory are picked up by ``readStream.text`` and parsed with
the same column functions as the batch readers. Term frequency is a stateful
streaming aggregation keyed by (word, title); each micro-batch's updated
counts are appended to a table under the given path, and
:func:`tfidf_from_updates` turns the latest counts into weights with the
batch operator (N and df depend on the whole corpus, so they are computed
at read time, not kept as streaming state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillrank.operators.tfidf import FULL, marked_term_freq, titles_in, weights
from quillrank.sources.text import FAILFAST, parse_articles, parse_pairs


def stream_articles(spark: SparkSession, path: str, mode: str = FAILFAST,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_articles(reader.load(path), mode=mode)


def stream_arcs(spark: SparkSession, path: str, delimiter: str = "tab", mode: str = FAILFAST) -> DataFrame:
    return parse_pairs(spark.readStream.format("text").load(path), ("src", "dst"), delimiter, mode=mode)


def stream_labels(spark: SparkSession, path: str, delimiter: str = "tab", mode: str = FAILFAST) -> DataFrame:
    return parse_pairs(spark.readStream.format("text").load(path), ("id", "name"), delimiter, mode=mode)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table as a file stream (each new file is new input). The
    file source wants a directory or a glob, so the table is named by a glob
    that matches nothing else: its last letter as a class of one."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")


def term_freq_stream(articles: DataFrame) -> DataFrame:
    """Streaming (word, title, tf) with a marker row of tf 0 per title: counts kept in the state store."""
    return marked_term_freq(articles)


def start_term_freq(articles: DataFrame, path: str, checkpoint: str, *,
                    trigger_once: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Run :func:`term_freq_stream` in update mode, appending each
    micro-batch's changed counts (with its batch id) as Parquet under ``path``.

    ``checkpoint`` must be on a file system every executor and the driver
    can reach; the state and offsets there make the query restartable.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)

    w = (
        term_freq_stream(articles).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append)
    )
    if query_name:
        w = w.queryName(query_name)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def tfidf_from_updates(spark: SparkSession, path: str, *, title_key: str = FULL) -> DataFrame:
    """(word, title, tf, df, w) from the appended count updates.

    Counts only grow, so the latest count of a key is its largest one.
    """
    marked = spark.read.parquet(path).groupBy("word", "title").agg(F.max("tf").alias("tf"))
    return weights(marked.where("tf > 0"), titles_in(marked), title_key=title_key)
