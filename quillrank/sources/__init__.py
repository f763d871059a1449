"""Sources: delimited text lines and the driver's Parquet tables."""

from quillrank.sources.tables import (
    arcs_from_lineitem,
    articles_from_documents,
    articles_from_pages,
    labels_from_part,
)
from quillrank.sources.text import (
    article_lines,
    pair_lines,
    parse_articles,
    parse_pairs,
    read_arcs,
    read_articles,
    read_labels,
)

__all__ = [
    "arcs_from_lineitem",
    "article_lines",
    "articles_from_documents",
    "articles_from_pages",
    "labels_from_part",
    "pair_lines",
    "parse_articles",
    "parse_pairs",
    "read_arcs",
    "read_articles",
    "read_labels",
]
