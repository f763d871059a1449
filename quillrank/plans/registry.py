"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query reads the driver's tables (pages, documents, lineitem, part) and
derives its inputs with Spark. The arcs are those of returned lines, which
leaves dangling nodes; every graph query has a ``_full`` form that takes all lines. Names and column aliases match the DuckDB
statements in :mod:`quillrank.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.operators import graph, tfidf as tf_ops
from quillrank.operators.keyed import WeightTable
from quillrank.operators.pagerank import DISTINCT_CONTRIBS, DISTINCT_LABELS, PageRank, pagerank, rank_labels, significant
from quillrank.operators.topk import UTF16, bottom_k, numbered, top_k
from quillrank.plans.oracle import ITERATIONS, K, LIST_LENGTH, SEPARATORS, TERM
from quillrank import streaming
from quillrank.session import ensure_checkpoint_dir, scratch_path
from quillrank.sources import tables as src_tables
from quillrank.sources.text import article_lines, pair_lines, quarantine, read_arcs, read_articles, read_labels

# Doubles that leave a query, and the order of top-k, are at this many decimals, as in the oracle.
DIGITS = 9
# Few decimals leave many equal ranks, whose order the names and ids decide.
RANK_DIGITS = 3

Query = Callable[[SparkSession, str], DataFrame]

VARIANTS = {
    "A": dict(delimiter="ws", dangling=True, normalizer=DISTINCT_CONTRIBS),
    "B": dict(delimiter="tab", dangling=True, normalizer=DISTINCT_LABELS),
    "C": dict(delimiter="tab", dangling=False, normalizer=DISTINCT_LABELS),
}


def r9(c: str) -> F.Column:
    return F.round(F.col(c), 9).alias(c)


# ------------------------------------------------------------------ inputs
def pages_articles(spark: SparkSession, d: str) -> DataFrame:
    return src_tables.articles_from_pages(src_tables.table(spark, d, "pages"))


def lineitem_arcs(spark: SparkSession, d: str, distinct: bool = True, returned_only: bool = True) -> DataFrame:
    return src_tables.arcs_from_lineitem(src_tables.table(spark, d, "lineitem"), distinct, returned_only)


def part_labels(spark: SparkSession, d: str, delimiter: str = "tab") -> DataFrame:
    return src_tables.labels_from_part(src_tables.table(spark, d, "part"), delimiter)


def graph_for(spark: SparkSession, d: str, variant: str, returned_only: bool = True) -> PageRank:
    ensure_checkpoint_dir(spark)
    v = VARIANTS[variant]
    return PageRank(
        lineitem_arcs(spark, d, returned_only=returned_only), part_labels(spark, d, v["delimiter"]),
        dangling=v["dangling"], normalizer=v["normalizer"],
    )


def step(spark: SparkSession, d: str, variant: str, what: Callable[[PageRank], DataFrame], returned_only: bool = True) -> DataFrame:
    """One step over a prepared graph, written so that the link table can go."""
    pr = graph_for(spark, d, variant, returned_only)
    out, path = what(pr), scratch_path(spark, "step")
    out.write.parquet(path)
    pr.close()
    return spark.read.schema(out.schema).parquet(path)


def written(lines: DataFrame, label: str) -> str:
    """The folder of text files that hold some lines."""
    path = scratch_path(lines.sparkSession, label)
    lines.write.text(path)
    return path


def ranks_for(spark: SparkSession, d: str, variant: str, iterations: int = ITERATIONS,
              returned_only: bool = True) -> DataFrame:
    ensure_checkpoint_dir(spark)
    v = VARIANTS[variant]
    return pagerank(
        lineitem_arcs(spark, d, returned_only=returned_only), part_labels(spark, d, v["delimiter"]), iterations=iterations,
        dangling=v["dangling"], normalizer=v["normalizer"],
    )


# ----------------------------------------------------------------- sources
def scan_articles(spark, d):
    pages = src_tables.table(spark, d, "pages")
    arts = pages.select(
        F.col("page_id").alias("article_id"),
        F.regexp_extract("html", src_tables.TITLE_PATTERN, 1).alias("title"),
        F.col("url").alias("ts"),
        F.col("html").alias("body"),
        F.lit(None).cast("string").alias("plain"),
    )
    return read_articles(spark, written(article_lines(arts), "articles"))


def scan_arcs_tab(spark, d, returned_only=True):
    raw = lineitem_arcs(spark, d, distinct=False, returned_only=returned_only)
    return read_arcs(spark, written(pair_lines(raw, "src", "dst"), "arcs"), "tab")


def scan_arcs_ws(spark, d, returned_only=True):
    """Fields apart by 1 to 3 spaces and tabs; some lines begin with a space or end with a tab."""
    raw = lineitem_arcs(spark, d, distinct=False, returned_only=returned_only)
    gap = F.substr(F.lit(SEPARATORS), (1 + F.col("src") % 3).cast("int"), (1 + F.col("dst") % 3).cast("int"))
    line = F.concat(F.repeat(F.lit(" "), (F.col("src") % 2).cast("int")), F.col("src").cast("string"), gap,
                    F.col("dst").cast("string"), F.repeat(F.lit("\t"), (F.col("dst") % 2).cast("int")))
    return read_arcs(spark, written(raw.select(line.alias("value")), "arcs"), "ws")


def _scan_labels(delimiter):
    def q(spark, d):
        part = src_tables.table(spark, d, "part")
        return read_labels(spark, written(pair_lines(part, "p_partkey", "p_name"), "labels"), delimiter)
    return q


def _quarantined(kind, half):
    """Lines of which some lack their last fields, by line number or page id."""
    def q(spark, d):
        if kind == "articles":
            pages = src_tables.table(spark, d, "pages")
            fields = [F.col("page_id").cast("string"), F.regexp_extract("html", src_tables.TITLE_PATTERN, 1), F.col("url"), F.replace("html", F.lit("\n"), F.lit("\\n"))]
            by, width = F.col("page_id"), 4
            rows = pages.select(by.alias("by"), F.array(*fields).alias("f"))
        else:
            rows, width = src_tables.table(spark, d, "lineitem").select(
                (F.col("l_linenumber") + F.col("l_orderkey")).alias("by"), F.array(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("f")), 2
        keep = F.when(F.col("by") % 7 == 0, F.lit(width - 1)).when(F.col("by") % 11 == 0, F.lit(1)).otherwise(F.lit(width))
        lines = rows.select(F.array_join(F.slice("f", F.lit(1), keep), "\t").alias("value"))
        halves = quarantine(spark.read.text(written(lines, "lines")), kind, scratch_path(spark, "quarantine"))
        return getattr(halves, half)
    return q


# ------------------------------------------------------------------ TF-IDF
def doc_count(spark, d):
    return tf_ops.doc_count(pages_articles(spark, d))


def tokens(spark, d):
    return tf_ops.tokens(pages_articles(spark, d))


def tokens_glued(spark, d):
    return tf_ops.tokens_glued(pages_articles(spark, d))


def term_freq(spark, d):
    return tf_ops.term_freq(tf_ops.tokens(pages_articles(spark, d))).select("word", "title", "tf")


def doc_freq(spark, d):
    return tf_ops.doc_freq(tf_ops.term_freq(tf_ops.tokens(pages_articles(spark, d))))


def idf(spark, d):
    marked = tf_ops.marked_term_freq(pages_articles(spark, d))
    return tf_ops.idf(tf_ops.doc_freq(marked.where("tf > 0")), tf_ops.titles_in(marked)).select("word", "df", "n", r9("idf"))


def tfidf_all(spark, d):
    return tf_ops.tfidf(pages_articles(spark, d)).select("word", "title", "tf", "df", r9("w"))


def tfidf_term(spark, d):
    return tf_ops.tfidf_term(pages_articles(spark, d), TERM).select("word", "title", "tf", "df", r9("w"))


def tfidf_topk(spark, d):
    return tf_ops.tfidf_topk(pages_articles(spark, d), TERM, K, digits=DIGITS).select("title", r9("w"))


def tfidf_all_salted(spark, d):
    """Every weight, hot words split by a salt instead of by adaptive execution."""
    return tf_ops.tfidf(pages_articles(spark, d), split_hot=True).select("word", "title", "tf", "df", r9("w"))


def weight_table(spark, d):
    return WeightTable.build(pages_articles(spark, d), scratch_path(spark, "weights"))


def tfidf_lookup(spark, d):
    """One term from the keyed table: one bucket is read."""
    return weight_table(spark, d).lookup(TERM).select("word", "title", "tf", "df", r9("w"))


def tfidf_lookup_many(spark, d):
    """Every word of the benchmark's items that the pages have, from the keyed table in place."""
    text = F.lower(F.regexp_replace("text", "[^a-zA-Z]+", " "))
    terms = src_tables.table(spark, d, "benchmark").select(F.explode(F.split(text, " ")).alias("word")).where("word <> ''")
    return weight_table(spark, d).lookup_all(terms).select("word", "title", "tf", "df", r9("w"))


def tfidf_before_comma(spark, d):
    return tf_ops.tfidf_topk(pages_articles(spark, d), TERM, K, title_key=tf_ops.BEFORE_COMMA, digits=DIGITS).select(
        "title", r9("w")
    )


def docs_tfidf_topk(spark, d):
    arts = src_tables.articles_from_documents(src_tables.table(spark, d, "documents"), "doc_id")
    return tf_ops.tfidf_topk(arts, TERM, K, digits=DIGITS).select("title", r9("w"))


def source_tfidf_all(spark, d):
    """Documents merged under their source: few titles, each one hot."""
    arts = src_tables.articles_from_documents(src_tables.table(spark, d, "documents"), "source")
    return tf_ops.tfidf(arts).select("word", "title", "tf", "df", r9("w"))


def stream_tfidf_all(spark, d):
    """The pages table read as a file stream; tf kept as streaming state and
    appended per micro-batch; weights computed from the latest counts."""
    ensure_checkpoint_dir(spark)
    arts = src_tables.articles_from_pages(streaming.stream_table(spark, d, "pages"))
    updates = scratch_path(spark, "tf-updates")
    query = streaming.start_term_freq(arts, updates, scratch_path(spark, "tf-stream"), trigger_once=True)
    query.awaitTermination()  # raises what stopped the stream; it ends by itself once all files are read
    return streaming.tfidf_from_updates(spark, updates).select("word", "title", "tf", "df", r9("w"))


# ------------------------------------------------------------------- graph
def distinct_arcs(spark, d, returned_only=True):
    return graph.distinct_arcs(lineitem_arcs(spark, d, returned_only=returned_only))


def adjacency(spark, d, returned_only=True):
    return graph.adjacency(lineitem_arcs(spark, d, returned_only=returned_only))


def adjacency_lists(spark, d, returned_only=True):
    ensure_checkpoint_dir(spark)
    return graph.adjacency_lists(lineitem_arcs(spark, d, returned_only=returned_only), LIST_LENGTH)


def out_degree(spark, d, returned_only=True):
    return graph.out_degree(graph.distinct_arcs(lineitem_arcs(spark, d, returned_only=returned_only)))


def initial_ranks(spark, d, returned_only=True):
    return graph.initial_ranks(graph.out_degree(graph.distinct_arcs(lineitem_arcs(spark, d, returned_only=returned_only))))


def dangling_nodes(spark, d, returned_only=True):
    deg = graph.out_degree(graph.distinct_arcs(lineitem_arcs(spark, d, returned_only=returned_only)))
    return graph.dangling_nodes(part_labels(spark, d), deg).select("id", "name")


def label_count(spark, d):
    return graph.label_count(part_labels(spark, d))


# ---------------------------------------------------------------- PageRank
def contributions(spark, d, returned_only=True):
    return step(spark, d, "C", lambda pr: pr.contributions(pr.initial()).select("dst", r9("contrib")), returned_only)


def pagerank_step(spark, d, returned_only=True):
    return step(spark, d, "C", lambda pr: pr.intermediate(pr.initial()).select("id", r9("rank")), returned_only)


def pagerank_step_dangling(spark, d, returned_only=True):
    return ranks_for(spark, d, "B", iterations=1, returned_only=returned_only).select("id", r9("rank"))


def distinct_contribs(spark, d, returned_only=True):
    return step(spark, d, "A", lambda pr: pr.contributions(pr.initial()).agg(
        F.count_distinct("dst", significant(F.col("contrib"))).alias("n")), returned_only)


def dangling_mass(spark, d, returned_only=True):
    return step(spark, d, "B", lambda pr: pr.round_scalars(pr.intermediate(pr.initial())).select(r9("mass")), returned_only)


def rank_labels_q(spark, d, returned_only=True):
    return rank_labels(ranks_for(spark, d, "C", returned_only=returned_only), part_labels(spark, d)).select("id", "name", r9("rank"))


def _ranks(variant):
    def q(spark, d, returned_only=True):
        return ranks_for(spark, d, variant, returned_only=returned_only).select("id", r9("rank"))
    return q


def _ranks_topk(variant, bottom=False):
    def q(spark, d, returned_only=True):
        labelled = rank_labels(ranks_for(spark, d, variant, returned_only=returned_only), part_labels(spark, d, VARIANTS[variant]["delimiter"]))
        pick = bottom_k if bottom else top_k
        return pick(labelled, "rank", "name", "id", k=K, digits=DIGITS).select("id", "name", r9("rank"))
    return q


def _initial_java(bottom):
    """Labels beyond the basic plane: all ranks tie, so the order is that of the names as Java has it."""
    def q(spark, d):
        mark = F.when(F.col("id") % 3 == 0, F.lit("\uff21")).when(F.col("id") % 3 == 1, F.lit("\U0001f600")).otherwise(F.lit(""))
        labels = part_labels(spark, d).select("id", F.concat(mark, "name").alias("name"))
        ranks = graph.initial_ranks(graph.out_degree(graph.distinct_arcs(lineitem_arcs(spark, d, returned_only=False))))
        return (bottom_k if bottom else top_k)(rank_labels(ranks, labels), "rank", "name", "id", k=K, order=UTF16).select("id", "name", r9("rank"))
    return q


def ranks_numbered(spark, d):
    """All labelled ranks of the whole graph with their place in the full order."""
    labelled = rank_labels(ranks_for(spark, d, "C", returned_only=False), part_labels(spark, d))
    rows = labelled.select("id", "name", F.round("rank", RANK_DIGITS).alias("rank"))
    return numbered(rows, "rank", "name", "id")


def _full(query):
    """A graph query over all lines instead of the returned ones."""
    def q(spark, d):
        return query(spark, d, returned_only=False)
    return q


#: Queries over arcs, each also registered in its ``_full`` form.
GRAPH_QUERIES = {
    "scan_arcs_tab": scan_arcs_tab,
    "scan_arcs_ws": scan_arcs_ws,
    "distinct_arcs": distinct_arcs,
    "adjacency": adjacency,
    "adjacency_lists": adjacency_lists,
    "out_degree": out_degree,
    "initial_ranks": initial_ranks,
    "dangling_nodes": dangling_nodes,
    "contributions": contributions,
    "pagerank_step": pagerank_step,
    "pagerank_step_dangling": pagerank_step_dangling,
    "distinct_contribs": distinct_contribs,
    "dangling_mass": dangling_mass,
    "rank_labels": rank_labels_q,
    "pagerank_a": _ranks("A"),
    "pagerank_b": _ranks("B"),
    "pagerank_c": _ranks("C"),
    "pagerank_a_topk": _ranks_topk("A"),
    "pagerank_b_topk": _ranks_topk("B"),
    "pagerank_c_topk": _ranks_topk("C"),
    "pagerank_bottomk": _ranks_topk("C", bottom=True),
}

QUERIES: dict[str, Query] = {
    "scan_articles": scan_articles,
    "scan_labels_tab": _scan_labels("tab"),
    "scan_labels_ws": _scan_labels("ws"),
    "quarantine_articles": _quarantined("articles", "good"),
    "quarantine_articles_bad": _quarantined("articles", "bad"),
    "quarantine_arcs": _quarantined("arcs", "good"),
    "quarantine_arcs_bad": _quarantined("arcs", "bad"),
    "doc_count": doc_count,
    "tokens": tokens,
    "tokens_glued": tokens_glued,
    "term_freq": term_freq,
    "doc_freq": doc_freq,
    "idf": idf,
    "tfidf_all": tfidf_all,
    "tfidf_all_salted": tfidf_all_salted,
    "tfidf_term": tfidf_term,
    "tfidf_lookup": tfidf_lookup,
    "tfidf_lookup_many": tfidf_lookup_many,
    "tfidf_topk": tfidf_topk,
    "tfidf_before_comma": tfidf_before_comma,
    "docs_tfidf_topk": docs_tfidf_topk,
    "source_tfidf_all": source_tfidf_all,
    "stream_tfidf_all": stream_tfidf_all,
    "label_count": label_count,
    "initial_topk_java": _initial_java(False),
    "initial_bottomk_java": _initial_java(True),
    "ranks_numbered": ranks_numbered,
    **GRAPH_QUERIES,
    **{f"{name}_full": _full(q) for name, q in GRAPH_QUERIES.items()},
}
