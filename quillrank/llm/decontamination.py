"""Benchmark decontamination: BM25 over test items, block-max pruning, verified overlap.

The inverted index holds the test items (Robertson and Walker's BM25, each
distinct passage word counted once). Items lie in blocks of ``BLOCK_ITEMS``;
for each word the index has its largest contribution within each block. The
index is broadcast in chunks of at most ``CHUNK_ITEMS`` items, and every
passage of every document is queried against every chunk, so the bound does
not depend on the size of the benchmark.

A task slides passages of ``PASSAGE`` words, ``STRIDE`` apart, over each text
(the last one reaches the end). As in block-max WAND (Ding and Suel, 2011) a
block is skipped when the sum of the passage's block maxima stays below the
block's lowest threshold; here the sums of all passages and blocks of a run of
texts are taken at once. Items of blocks that remain are scored exactly.
An item is retrieved when its score reaches ``SHARE`` of the least that a
passage within a copy of it scores: of any ``PASSAGE`` words of its text in
a row, or of its question where that is shorter; every such pair of passage and item is then verified against
the whole document: the share of the question's and of the answer's
``GRAM``-word windows that occur in it. The answer is an item's last sentence,
its windows are those with at least one of its words; the others are the
question's.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm import words

K1, B = 1.2, 0.75
PASSAGE, STRIDE = 64, 32
BLOCK_ITEMS, CHUNK_ITEMS = 8, 1000
SHARE = 0.4
GRAM = 5
#: Contaminated: this share of the question alone, or half of it and half of the answer.
QUESTION, PART = 0.8, 0.5

#: Bytes to words: letters A-Z become small, ASCII punctuation separates.
FOLD = words._LOWER.copy()
FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


@dataclass
class Index:
    """One chunk of items; arrays only, so it is broadcast as it is."""

    ids: np.ndarray  # item_id
    vocab: np.ndarray  # sorted word hashes
    weight: np.ndarray  # contribution of word x item
    most: np.ndarray  # largest contribution of word x block
    need: np.ndarray  # threshold of each item
    block_need: np.ndarray
    grams: list[tuple[int, np.ndarray, np.ndarray]]  # gram size, question's and answer's grams, per item


def _words(text: str) -> np.ndarray:
    return np.concatenate([b.hash for _, b in words.scan(pa.array([text]), fold=FOLD)])


def _least(vocab: np.ndarray, weight: np.ndarray, text: np.ndarray) -> float:
    """The least score of an item (its weight of each word) for any ``PASSAGE`` words of a text in a row; for all of a shorter one."""
    size = min(PASSAGE, len(text))
    least = np.inf
    at = np.searchsorted(vocab, text)
    for i in range(0, len(text) - size + 1, 4096):
        windows = np.sort(np.lib.stride_tricks.sliding_window_view(at[i : i + 4095 + size], size), axis=1)
        once = np.ones(windows.shape, bool)
        once[:, 1:] = windows[:, 1:] != windows[:, :-1]
        least = min(least, float((weight[windows] * once).sum(1).min()))
    return least


def build_index(items: list[tuple[int, str]]) -> Index:
    """Index of ``(item_id, text)``; items without a word can't be met and are left out."""
    kept = [(i, t, w) for i, t in items if i is not None and t and len(w := _words(t))]
    lengths = np.array([len(w) for _, _, w in kept], float)
    vocab = np.unique(np.concatenate([w for *_, w in kept])) if kept else np.zeros(0, np.uint64)
    tf = np.zeros((len(vocab), len(kept)), np.float32)
    for j, (*_, w) in enumerate(kept):
        u, c = np.unique(w, return_counts=True)
        tf[np.searchsorted(vocab, u), j] = c
    df = (tf > 0).sum(1)
    idf = np.log1p((len(kept) - df + 0.5) / (df + 0.5)).astype(np.float32)
    norm = (K1 * (1 - B + B * lengths / max(lengths.mean(), 1))).astype(np.float32) if kept else np.zeros(0, np.float32)
    weight = (idf[:, None] * tf * np.float32(K1 + 1) / np.maximum(tf + norm, np.float32(1e-9))).astype(np.float32)
    grams, least = [], []
    for j, (_, t, w) in enumerate(kept):
        k = min(GRAM, len(w))
        g = words.gram_hash(w, k)
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", t) if len(_words(s))]
        tail = len(_words(sentences[-1])) if len(sentences) > 1 else 0
        first = max(0, len(w) - tail - k + 1) if tail else len(g)  # the first gram with a word of the answer
        grams.append((k, np.unique(g[:first]), np.unique(g[first:])))
        parts = [w, w[: len(w) - tail]] if 0 < first < len(g) else [w]
        least.append(min(_least(vocab, weight[:, j], part) for part in parts))
    need = np.float32(SHARE) * np.array(least, np.float32)
    edges = np.arange(0, len(kept), BLOCK_ITEMS)
    most = np.maximum.reduceat(weight, edges, axis=1) if kept else weight
    block_need = np.minimum.reduceat(need, edges) if kept else need
    return Index(np.array([i for i, *_ in kept], np.int64), vocab, weight, most, need, block_need, grams)


def _passages(n: int) -> np.ndarray:
    """Word offsets at which the passages of a text of n words begin."""
    return np.arange(max(1, math.ceil((n - PASSAGE) / STRIDE) + 1)) * STRIDE if n else np.zeros(0, np.int64)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges ``lo[i]`` to ``hi[i]``, one range after the other."""
    size = hi - lo
    return np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)


def retrieve(index: Index, block: words.Words) -> list[tuple[int, int, int, float]]:
    """All ``(row, first word, item position, score)`` at or above the thresholds."""
    if not len(index.ids) or not len(block.hash):
        return []
    at = np.minimum(np.searchsorted(index.vocab, block.hash), len(index.vocab) - 1)
    known = index.vocab[at] == block.hash
    place = np.flatnonzero(known)
    if not len(place):
        return []
    counts = np.diff(block.row)
    parts = [(i, _passages(n)) for i, n in enumerate(counts) if n]
    row = np.concatenate([np.full(len(p), i) for i, p in parts])
    begin = np.concatenate([p for _, p in parts])
    lo = block.row[row] + begin
    a, b = np.searchsorted(place, lo), np.searchsorted(place, np.minimum(lo + PASSAGE, block.row[row + 1]))
    # distinct (passage, word) pairs, passage by passage
    passage = np.repeat(np.arange(len(row)), b - a)
    pairs = np.unique(passage * len(index.vocab) + at[place[_ranges(a, b)]])
    passage, term = pairs // len(index.vocab), pairs % len(index.vocab)
    first = np.searchsorted(passage, np.arange(len(row) + 1))
    some = np.flatnonzero(np.diff(first))
    bound = np.add.reduceat(index.most[term], first[some], axis=0)
    open_at, open_block = np.nonzero(bound * np.float32(1.0001) >= index.block_need)
    found = []
    for k in np.unique(open_block):
        mine = some[open_at[open_block == k]]
        items = slice(k * BLOCK_ITEMS, (k + 1) * BLOCK_ITEMS)
        size = np.diff(first)[mine]
        score = np.add.reduceat(index.weight[term[_ranges(first[mine], first[mine] + size)], items], np.cumsum(size) - size, axis=0)
        for p, j in zip(*np.nonzero(score * np.float32(1.0001) >= index.need[items])):
            found.append((int(row[mine[p]]), int(begin[mine[p]]), int(k * BLOCK_ITEMS + j), float(score[p, j])))
    return found


def verify(index: Index, item: int, have: np.ndarray) -> tuple[float, float]:
    """Shares of the item's question and answer windows among the sorted windows (of the item's gram size) of a whole text.

    A part without windows (an item of one sentence, or a very short question) takes the other's share.
    """
    def share(g: np.ndarray) -> float | None:
        if not len(g) or not len(have):
            return 0.0 if len(g) else None
        return float((have[np.minimum(np.searchsorted(have, g), len(have) - 1)] == g).mean())

    q, a = map(share, index.grams[item][1:])
    return (a if q is None else q), (q if a is None else a)


def contaminated(question: float, answer: float) -> bool:
    return question >= QUESTION or (question >= PART and answer >= PART)


def matches(index: Index, block: words.Words) -> list[tuple[int, int, int, float, int, float, float]]:
    """Per row and item retrieved and verified: best passage's first word, its score, passages, overlaps."""
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for row, begin, item, score in retrieve(index, block):
        s, at, n = best.get((row, item), (-1.0, 0, 0))
        best[row, item] = (score, begin, n + 1) if score > s else (s, at, n + 1)
    out, of, have = [], None, {}
    for (row, item), (score, begin, n) in sorted(best.items()):
        if row != of:
            of, have = row, {}  # a text's windows are hashed once for all its items
        k = index.grams[item][0]
        if k not in have:
            have[k] = np.sort(words.gram_hash(block.of(row), k))
        q, a = verify(index, item, have[k])
        if contaminated(q, a):
            out.append((row, item, begin, score, n, q, a))
    return out


SCHEMA = "doc_id long, item_id long, passage_start long, bm25 double, n_passages long, question_overlap double, answer_overlap double"


def _find(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            ids, rows = batch.column(0), []
            for first, block in words.scan(batch.column(1), fold=FOLD):
                rows += [(ids[first + r].as_py(), int(index.ids[i]), *rest) for r, i, *rest in matches(index, block)]
            cols = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def _indexes(items: DataFrame):
    """Broadcast indexes of at most ``CHUNK_ITEMS`` items each, one after the other."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    after: tuple | None = None
    while True:
        part = items if after is None else items.where((F.col("item_id") > after[0]) | ((F.col("item_id") == after[0]) & (F.col("text") > after[1])))
        rows = part.where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id", "text").limit(CHUNK_ITEMS).collect()
        if rows:
            yield items.sparkSession.sparkContext.broadcast(build_index([(r["item_id"], r["text"]) for r in rows]))
            after = (rows[-1]["item_id"], rows[-1]["text"])
        if len(rows) < CHUNK_ITEMS:
            return


def find_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and test item whose question and answer overlap is verified.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns are
    ignored. Null and empty texts, and items without an id or a word, match
    nothing. Repeated documents are reported each; an item of several texts is
    several items of one id. With no items or no documents the result is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for index in _indexes(items):
        out = out.unionByName(docs.mapInArrow(_find(index), SCHEMA))
    return out


def _clean(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, block in words.scan(batch.column(batch.schema.get_field_index("text")), fold=FOLD):
                keep[[first + r for r, *_ in matches(index, block)]] = False
            yield batch.filter(pa.array(keep))

    return run


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without verified overlap with any test item, all their columns as they are."""
    for index in _indexes(items):
        docs = docs.mapInArrow(_clean(index), docs.schema)
    return docs
