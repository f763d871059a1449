"""quillrank: term weighting and link analysis as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame built from native
column expressions, so Catalyst can prune, push down and fuse the work and
no row crosses into a Python worker.
"""

from quillrank.operators.tfidf import (
    doc_count,
    doc_freq,
    idf,
    term_freq,
    tfidf,
    tfidf_term,
    tfidf_topk,
    tokens,
    tokens_glued,
)
from quillrank.operators.graph import (
    adjacency,
    adjacency_lists,
    dangling_nodes,
    distinct_arcs,
    initial_ranks,
    label_count,
    out_degree,
)
from quillrank.operators.keyed import WeightTable
from quillrank.operators.pagerank import PageRank, pagerank, rank_labels
from quillrank.operators.topk import bottom_k, numbered, top_k
from quillrank.sources.text import quarantine

__all__ = [
    "PageRank",
    "WeightTable",
    "adjacency",
    "adjacency_lists",
    "bottom_k",
    "dangling_nodes",
    "distinct_arcs",
    "doc_count",
    "doc_freq",
    "idf",
    "initial_ranks",
    "label_count",
    "numbered",
    "out_degree",
    "pagerank",
    "quarantine",
    "rank_labels",
    "term_freq",
    "tfidf",
    "tfidf_term",
    "tfidf_topk",
    "tokens",
    "tokens_glued",
    "top_k",
]
