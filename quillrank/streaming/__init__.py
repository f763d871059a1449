"""Structured Streaming forms of the text sources and of term frequency."""

from quillrank.streaming.text import (
    start_term_freq,
    stream_arcs,
    stream_articles,
    stream_labels,
    stream_table,
    term_freq_stream,
    tfidf_from_updates,
)

__all__ = [
    "start_term_freq",
    "stream_arcs",
    "stream_articles",
    "stream_labels",
    "stream_table",
    "term_freq_stream",
    "tfidf_from_updates",
]
