"""Quality rules: base statistics of whole texts and an isolation forest on them.

Every text is reduced to rule statistics in one Arrow pass (whole arrays per
block of rows, no Python object per word). The forest (Liu, Ting and Zhou,
2008) is grown on a bounded, documented sample of labelled rows of quality 1:
``TREES`` trees of ``SAMPLE`` rows each, split at random. A document's score
is ``2 ** (-mean path length / c(SAMPLE))``: near 1 where few random splits
set it apart from good rows. The threshold is calibrated on *all* labelled
rows: their scores are counted in ``BINS`` bins per label by Spark, and the
cut of the largest Youden index (share of bad rows rejected less share of
good rows rejected) is taken. The forest (``TREES * 2 * SAMPLE`` nodes at
most) and the two histograms are all that reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm import words
from quillrank.llm.common import Scratch, drawn

TREES, SAMPLE, BINS, SEED = 200, 256, 1000, 17
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
FEATURES = ("symbol_share", "upper_share", "word_length", "repeat_share", "dup_line_share", "bang_share", "variety")
#: A share over few words says little, so it starts from this many words of a typical text.
PRIOR_WORDS = 20.0
TYPICAL = np.array([0.0, 0.02, 5.0, 0.0, 0.0, 0.0, 0.0])
#: A statistic that is the same in all sampled rows is still cut, within this reach.
LEAST_REACH = np.array([0.02, 0.02, 0.5, 0.1, 0.1, 0.02, 0.2])

_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in
       {"symbol": SYMBOLS, "upper": range(65, 91), "bang": b"!?"}.items()}
_NOT_CODE_POINT = (np.arange(256) & 0xC0) == 0x80


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _repeats(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, whether its (row, key) occurs again; and whether it is a later one."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    same = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    later, again = np.zeros(len(r), bool), np.zeros(len(r), bool)
    later[order[1:]] = same
    again[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later


def statistics(block: words.Words) -> dict[str, np.ndarray]:
    """Base statistics of each row of a block, as int64 arrays."""
    data, n_rows = block.data, len(block)
    n_words = np.diff(block.row)
    space = words._SPACE[data]
    out = {"n_words": n_words, "word_chars": _sums(~space & ~_NOT_CODE_POINT[data], block.text)}
    for name, chars in _IS.items():
        out[f"n_{name}s"] = _sums(chars[data], block.text)
    # lines end at \n or with their row
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(breaks + 1, block.text[:-1])
    row_of = np.searchsorted(block.text, starts, side="right") - 1
    starts, row_of = starts[row_of < n_rows], row_of[row_of < n_rows]
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], block.text[row_of + 1])
    filled = np.concatenate([[0], np.cumsum(~space, dtype=np.int64)])
    has_word = filled[ends] > filled[starts]
    starts, ends = starts[has_word], ends[has_word]
    row_of = np.searchsorted(block.text, starts, side="right") - 1
    _, later = _repeats(row_of, words.span_hash(data, starts, ends))
    out["n_lines"] = np.bincount(row_of, minlength=n_rows)
    out["n_dup_lines"] = np.bincount(row_of, weights=later, minlength=n_rows).astype(np.int64)
    # words in windows that occur twice or more in their row
    h = words.gram_hash(block.hash, WINDOW)
    row_of_word = np.repeat(np.arange(n_rows), n_words)
    inside = row_of_word[: len(h)] == row_of_word[WINDOW - 1 :] if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    again, _ = _repeats(row_of_word[at], h[at])
    edge = np.zeros(len(block.hash) + 1, np.int64)
    edge[at[again]] += 1
    np.subtract.at(edge, at[again] + WINDOW, 1)
    out["n_repeat_words"] = _sums(np.cumsum(edge)[:-1] > 0, block.row)
    # distinct words
    _, later = _repeats(row_of_word, block.hash)
    out["n_distinct"] = n_words - np.bincount(row_of_word, weights=later, minlength=n_rows).astype(np.int64)
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """``FEATURES`` of each row, float64."""
    n, chars = s["n_words"].astype(float), s["word_chars"].astype(float)
    per = np.array([5.0, 5.0, 1, 1, 1, 1, 1])  # shares of characters: per five of them, as a word has
    raw = np.column_stack([s["n_symbols"], s["n_uppers"], chars, s["n_repeat_words"], s["n_dup_lines"] / np.maximum(s["n_lines"], 1) * n,
                           s["n_bangs"], np.zeros(len(n))])
    out = (raw + PRIOR_WORDS * TYPICAL * per) / ((n + PRIOR_WORDS)[:, None] * per)
    # distinct words against what a text of that length has (Heaps' law with a fixed exponent)
    out[:, -1] = (s["n_distinct"] + PRIOR_WORDS) / (n + PRIOR_WORDS) ** 0.8
    return out


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>"


def _measure(batches):
    for batch in batches:
        ids = batch.column(0)
        for first, block in words.scan(batch.column(1)):
            s = statistics(block)
            f = features(s)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1, dtype=np.int32) * len(FEATURES)), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([ids.slice(first, len(block)), *(pa.array(s[c].astype(np.int64)) for c in BASE), flat], ["doc_id", *BASE, "features"])


def measure(docs: DataFrame) -> DataFrame:
    """``(doc_id, base statistics, features)`` per row of ``docs(doc_id, text)``; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_measure, SCHEMA)


def expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows, c(n)."""
    n = np.asarray(n, dtype=float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> list[dict[str, np.ndarray]]:
    """Trees as arrays: feature (-1 at a leaf), cut, left and right child, path length at a leaf."""
    rng, forest = np.random.default_rng(seed), []
    for _ in range(trees if len(rows) else 0):
        part = rows[rng.choice(len(rows), min(sample, len(rows)), replace=False)]
        limit = int(np.ceil(np.log2(max(2, len(part)))))
        feature, cut, left, right, length = [], [], [], [], []
        todo = [(np.arange(len(part)), 0, -1, False)]
        while todo:
            at, depth, parent, is_right = todo.pop()
            me = len(feature)
            if parent >= 0:
                (right if is_right else left)[parent] = me
            left.append(-1), right.append(-1)
            if depth >= limit or len(at) <= 1 or not np.ptp(part[at], axis=0).any():
                feature.append(-1), cut.append(0.0), length.append(depth + float(expected_path(len(at))))
                continue
            f = int(rng.integers(part.shape[1]))
            low, high = part[at, f].min(), part[at, f].max()
            # the range reaches beyond the rows on both sides: what lies outside all good rows is cut off early
            reach = max(high - low, LEAST_REACH[f])
            c = rng.uniform(low - reach, high + reach)
            feature.append(f), cut.append(c), length.append(0.0)
            goes = part[at, f] <= c
            todo += [(at[goes], depth + 1, me, False), (at[~goes], depth + 1, me, True)]
        forest.append({"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "right": np.array(right), "length": np.array(length)})
    return forest


def score(forest: list[dict[str, np.ndarray]], rows: np.ndarray, sample: int = SAMPLE) -> np.ndarray:
    """Anomaly score of each row, 0 to 1; 0.5 where there is no forest."""
    if not forest:
        return np.full(len(rows), 0.5)
    total = np.zeros(len(rows))
    for t in forest:
        at = np.zeros(len(rows), np.int64)
        while True:
            f = t["feature"][at]
            go = np.flatnonzero(f >= 0)
            if not len(go):
                break
            down = rows[go, f[go]] <= t["cut"][at[go]]
            at[go] = np.where(down, t["left"][at[go]], t["right"][at[go]])
        total += t["length"][at]
    return 2.0 ** (-total / len(forest) / max(float(expected_path(sample)), 1e-9))


#: Labelled rows of quality 1 that the forest is grown on, at most (drawn by a hash of their id).
FIT_ROWS = 20_000


def _base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _scored(forest):
    def run(batches):
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("features")).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            kept = [c for c in batch.schema.names if c != "features"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(score(forest.value, rows))], [*kept, "score"])

    return run


def threshold(counts: list[tuple[int, int, int]]) -> float:
    """The score to reject from, of the largest Youden index over ``(quality, bin, rows)``; above 1 without both labels."""
    bad, good = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for quality, at, n in counts:
        (good if quality else bad)[at] += n
    if not bad.sum() or not good.sum():
        return 1.1
    above = [np.cumsum(x[::-1])[::-1] / x.sum() for x in (bad, good)]
    gain = above[0] - above[1]
    best = int(np.flatnonzero(gain >= gain.max() - 1e-12)[-1])  # of equal cuts the one that rejects least
    return best / BINS if gain[best] > 0 else 1.1


def fit(measured: DataFrame, labels: DataFrame) -> tuple[list, float]:
    """Forest and threshold from ``measure``'s rows and ``labels(doc_id, quality)``.

    A null id or quality is no label. Without labelled rows of quality 1 the
    forest is empty and rejects nothing; without both labels the threshold is
    above every score.
    """
    spark = measured.sparkSession
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1)")
    judged = measured.where(~_base_failed()).join(labels, "doc_id")
    rows = drawn(judged.where("quality = 1"), FIT_ROWS, "doc_id").select("doc_id", "features").collect()
    rows = sorted((r["doc_id"], r["features"]) for r in rows)
    forest = grow(np.array([f for _, f in rows], dtype=float).reshape(-1, len(FEATURES)))
    shared = spark.sparkContext.broadcast(forest)
    scores = judged.select("quality", "features").mapInArrow(_scored(shared), "quality int, score double")
    bins = scores.groupBy("quality", F.floor(F.col("score") * BINS).cast("int").alias("bin")).count().collect()
    return forest, threshold([(r["quality"], r["bin"], r["count"]) for r in bins])


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score)`` per row.

    Null and empty texts have no words and fail the base rules. Repeated rows
    are judged alike and repeated in the result; a row without an id is judged
    too. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    measured = scratch.save(measure(docs), "measured")
    forest, cut = fit(measured, labels)
    scored = measured.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(forest)), SCHEMA.replace("features array<double>", "score double"))
    failed = _base_failed()
    return scratch.finish(scored.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & (F.col("score") < cut)).alias("kept"), "score"))


def _keeping(forest, cut: float):
    def run(batches):
        for batch in batches:
            keep = []
            for _, block in words.scan(batch.column(batch.schema.get_field_index("text"))):
                s = statistics(block)
                ok = (s["n_words"] >= MIN_WORDS) & (100 * s["n_repeat_words"] <= MAX_REPEAT_PERCENT * s["n_words"])
                ok[ok] = score(forest.value, features(s)[ok]) < cut
                keep.append(ok)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return run


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, all their columns as they are."""
    scratch = Scratch(docs.sparkSession, "quality-keep")
    forest, cut = fit(scratch.save(measure(docs), "measured"), labels)
    scratch.drop("measured")
    return docs.mapInArrow(_keeping(docs.sparkSession.sparkContext.broadcast(forest), cut), docs.schema)
