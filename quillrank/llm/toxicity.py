"""Toxicity by nearest labelled examples: exact TF-IDF cosine, block-max index, calibrated votes.

* **Examples** are at most ``EXAMPLES`` labelled rows per label. Their terms
  (lower-cased words and word beginnings of ``STEM`` bytes), all of them, are
  the vocabulary; a term that no example has can't match and is left out.
* **Weights**: every term weighs its inverse document frequency over all
  documents, times how surely it goes with one label or the other:
  ``chi / (chi + CHI_SQUARED)`` by its chi-squared value on a bounded sample
  of labelled rows, ``EVEN`` at least. One pass over the corpus counts both.
  The form was chosen by cross-validation within training rows, where plain
  TF-IDF ranks much worse (``tests/llm/test_toxicity.py`` repeats it).
* **Index**: posting lists, cut into blocks of ``BLOCK`` examples; each block
  of a list has its largest weight. The few long lists of a query are summed
  for all examples; the short ones are read only in blocks whose best sum and
  largest weights reach the k-th best sum, so the k nearest are exact. Its size
  is bounded by the examples' terms, whatever the corpus. Texts are scored as
  they are read, no vector is written.
* **Votes** of the ``NEIGHBOURS`` nearest are weighted by 1 / (distance +
  ``SOFT``), less what an example at cosine 0 has, and by what the sample's
  labels are short of the true shares; ``PRIOR`` votes go to the base rate, so
  far examples decide little. Votes are calibrated on labelled rows that neither weights nor examples saw (monotone
  bins). The nearest examples' ids are returned as evidence.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm import words
from quillrank.llm.common import Scratch, drawn

STEM = 5
#: Bounds of the fitted parts: labelled rows per label for weights and for the index, rows for calibration.
TERM_ROWS, EXAMPLES, CALIBRATION_ROWS = 20_000, 2_000, 20_000
#: Chi-squared value that one in a hundred million random terms reaches: half the weight. The least weight.
CHI_SQUARED, EVEN = 32.8, 0.05
NEIGHBOURS, SOFT, PRIOR, BLOCK, BINS, EVIDENCE = 25, 0.05, 5.0, 64, 20, 5
#: Blocks whose short lists are read before bounds are compared.
FIRST = 4
#: Short lists are read whole where bounds leave out less than one of so many blocks.
WHOLE = 20
#: After so many queries in a row that were read whole, bounds are left out for as many times PAUSE queries.
TRIALS, PAUSE = 4, 15
#: One example in so many makes a list a long one; what sums of 32-bit numbers can be off, and much more.
LONG, ROUNDING = 32, 1e-4
_STEM_MARK = np.uint64(0x5bd1e995_9e3779b9)


def terms(block: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a block's rows, and the row of each."""
    row = np.repeat(np.arange(len(block)), np.diff(block.row))
    long = block.ends - block.starts > STEM
    stems = words.mix(words.span_hash(block.data, block.starts[long], block.starts[long] + STEM) ^ _STEM_MARK)
    return np.concatenate([block.hash, stems]), np.concatenate([row, row[long]])


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def _place(sorted_ids: np.ndarray, column: pa.Array) -> np.ndarray:
    """Positions of a column's ids in a sorted array, -1 where absent or null."""
    ids = column.fill_null(-1).to_numpy(zero_copy_only=False)
    if not len(sorted_ids):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
    return np.where((sorted_ids[at] == ids) & column.is_valid().to_numpy(zero_copy_only=False), at, -1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges ``lo[i]`` to ``hi[i]``, one range after the other."""
    size = hi - lo
    return np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)


def _rows(column: pa.Array, vocab: np.ndarray):
    """Per block of texts its first row, and the (row, term, count) of the vocabulary's terms in order."""
    for first, block in words.scan(column, lower=True):
        h, row = terms(block)
        order = np.argsort(h)  # in order, they are found much faster
        h, row = h[order], row[order]
        at = np.searchsorted(vocab, h)
        hit = np.flatnonzero(at < len(vocab))
        hit = hit[vocab[at[hit]] == h[hit]]
        key, n = np.unique(row[hit] * max(len(vocab), 1) + at[hit], return_counts=True)
        yield first, len(block), key // max(len(vocab), 1), key % max(len(vocab), 1), n


HASHED = "doc_id long, terms array<long>, counts array<int>"


def _hashed(batches):
    """All terms of each text, as hashes, and how often it has them."""
    for batch in batches:
        for first, block in words.scan(batch.column(1), lower=True):
            h, row = terms(block)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(h))).astype(np.int32)
            offsets = pa.array(np.searchsorted(row[begin], np.arange(len(block) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(block)), pa.ListArray.from_arrays(offsets, pa.array(h[begin].view(np.int64))),
                                              pa.ListArray.from_arrays(offsets, pa.array(n))], ["doc_id", "terms", "counts"])


COUNTED = "term int, df long, pos long, neg long"


def _count(vocabulary, sample):
    """Rows that have each term: all of them, and the sample's of either label; term -1 counts the rows themselves."""
    def run(batches):
        vocab, (ids, toxic) = vocabulary.value, sample.value
        size = len(vocab)
        sums = np.zeros((3, size + 1), np.int64)
        for batch in batches:
            place = _place(ids, batch.column(0))
            label = np.where(place >= 0, toxic[place], -1) if len(ids) else place
            sums[:, size] += [len(label), (label == 1).sum(), (label == 0).sum()]
            for first, _, row, at, _ in _rows(batch.column(1), vocab):
                sums[0, :size] += np.bincount(at, minlength=size)
                y = label[first + row]
                for k, mine in ((1, y == 1), (2, y == 0)):
                    if mine.any():
                        sums[k, :size] += np.bincount(at[mine], minlength=size)
        some = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.where(some < size, some, -1).astype(np.int32)), *(pa.array(x[some]) for x in sums)], ["term", "df", "pos", "neg"])

    return run


class Lists:
    """Posting lists of examples: per term its blocks and their largest weights, per block of a term its examples.

    Lists that over one in ``LONG`` examples is in are used as rows with a place for every example. Only their
    entries are sent with the index; each worker fills the rows itself.
    """

    def __init__(self, term: np.ndarray, example: np.ndarray, weight: np.ndarray, n_terms: int, n_examples: int):
        self.n, self.blocks = n_examples, -(-n_examples // BLOCK)
        long = np.bincount(term, minlength=n_terms) > n_examples // LONG
        self.row = np.where(long, np.cumsum(long) - 1, -1).astype(np.int32)
        mine = long[term]
        self.entries = self.row[term[mine]], example[mine].astype(np.int32), weight[mine].astype(np.float32)
        self.fill(int(long.sum()))
        term, example, weight = term[~mine], example[~mine], weight[~mine]

        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), weight[order].astype(np.float32)
        key = term.astype(np.int64) * max(self.blocks, 1) + self.example // BLOCK
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        self.begin = np.append(begin, len(key))
        self.block = (key[begin] % max(self.blocks, 1)).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, begin) if len(begin) else self.weight
        self.term = np.searchsorted(term[begin], np.arange(n_terms + 1))

    def fill(self, rows: int) -> None:
        self.long = np.zeros((rows, self.n), np.float32)
        row, example, weight = self.entries
        self.long[row, example] = weight
        self.buffer = np.empty((0, self.n), np.float32)  # the long lists of a query
        self.whole = False  # whether bounds left out next to nothing of the last query that had them

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("long", "buffer", "whole")} | {"rows": len(self.long)}

    def __setstate__(self, state: dict) -> None:
        rows = state.pop("rows")
        self.__dict__.update(state)
        self.fill(rows)

    def nearest(self, at: np.ndarray, v: np.ndarray, k: int, bounded: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosines above 0, ties by place, and these.

        Long lists are summed for all examples first (in 32 bits). A block's bound
        is the best of these sums in it and the largest weights of the short lists
        in it. Short lists are read for the blocks of the highest bounds, and then
        for those whose bound reaches the k-th best sum; where that leaves out less than one
        block in ``WHOLE`` of theirs, they are read whole, which is quicker than picking
        (``whole`` tells), and without ``bounded`` at once: only the time differs. Whatever is within ``ROUNDING`` of the k-th
        best then is summed again in 64 bits.
        """
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        row = self.row[at]
        heavy = row >= 0
        by_row = v[heavy]
        if len(by_row) > len(self.buffer):
            self.buffer = np.empty((2 * len(by_row), self.n), np.float32)
        rows = np.take(self.long, row[heavy], axis=0, out=self.buffer[: len(by_row)], mode="clip")
        sums = (by_row.astype(np.float32) @ rows).astype(np.float64)
        at, v = at[~heavy], v[~heavy]
        lo, hi = self.term[at], self.term[at + 1]

        def read(lo: np.ndarray, hi: np.ndarray, by: np.ndarray) -> np.ndarray:
            post = _ranges(lo, hi)
            return np.bincount(self.example[post], weights=self.weight[post] * np.repeat(by, hi - lo), minlength=self.n).astype(np.float64, copy=False)  # of nothing: whole numbers

        if bounded:
            entry, by = _ranges(lo, hi), np.repeat(v, hi - lo)
            block = self.block[entry]
            most = np.maximum.reduceat(sums, np.arange(0, self.n, BLOCK)) + (bound := np.bincount(block, weights=self.most[entry] * by, minlength=self.blocks))
            first = np.zeros(self.blocks, bool)
            first[np.argsort(-most, kind="stable")[:FIRST]] = True
            some = np.flatnonzero(first[block])
            short = read(self.begin[entry[some]], self.begin[entry[some] + 1], by[some])
            least = -np.partition(-(sums + short), k - 1)[k - 1] if self.n >= k else 0.0
            mine = ((bound > 0) & (first | (most >= least - ROUNDING)))[block]
            self.whole = WHOLE * np.count_nonzero(~mine) < len(mine)
            if self.whole:
                short = read(self.begin[lo], self.begin[hi], v)
            else:
                some = np.flatnonzero(mine & ~first[block])
                short += read(self.begin[entry[some]], self.begin[entry[some] + 1], by[some])
        else:
            short = read(self.begin[lo], self.begin[hi], v)
        sums += short
        found = np.flatnonzero(sums > 0)
        if len(found) > k:
            found = found[sums[found] >= -np.partition(-sums[found], k - 1)[k - 1] - ROUNDING]
        cosine = by_row @ rows[:, found].astype(np.float64) + short[found]
        order = np.lexsort((found, -np.round(cosine, 9)))[:k]
        return found[order], cosine[order]


@dataclass
class Index:
    """Normalized example vectors with their labels' weights, as posting lists with block maxima."""

    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray  # weight of an example's vote
    idf: np.ndarray  # weight of each term
    rows: Lists | np.ndarray  # example x term
    most: np.ndarray | None  # block x term, of a dense index; the lists have their own
    base: float  # share of label 1 among labelled rows
    bins: np.ndarray | None = None  # calibrated score of each raw bin; the last is for texts without a term

    def __post_init__(self):
        self.in_vain = 0  # queries in a row whose bounds left out next to nothing, and those asked without bounds after them
        self.lists = self.rows
        if not isinstance(self.rows, Lists):
            example, term = np.nonzero(self.rows)
            self.lists = Lists(term, example, self.rows[example, term], self.rows.shape[1], len(self.rows))

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[at]
        return v / max(float(np.sqrt((v * v).sum())), 1e-12)

    def nearest(self, at: np.ndarray, v: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples with a cosine above 0, ties by id.

        Bounds that have just left out nothing several times are not computed for some queries.
        """
        bounded = self.in_vain < TRIALS
        found = self.lists.nearest(at, v, k, bounded)
        if bounded:
            self.in_vain = self.in_vain + 1 if self.lists.whole else 0
        else:
            self.in_vain = (self.in_vain + 1) % (TRIALS * (1 + PAUSE))
        return found

    def raw(self, at: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted vote and the examples it comes from; the base rate and none where no example is near."""
        if not len(at):
            return self.base, np.zeros(0, np.int64)
        found, cosines = self.nearest(at, self.vector(at, counts))
        if not len(found):
            return self.base, found
        w = self.share[found] * (1 / (1 - np.minimum(cosines, 1) + SOFT) - 1 / (1 + SOFT))
        return float((PRIOR * self.base + (w * self.toxic[found]).sum()) / (PRIOR + w.sum())), self.ids[found[:EVIDENCE]]

    def score(self, at: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
        raw, ids = self.raw(at, counts)
        if self.bins is None:
            return raw, ids
        return float(self.bins[bin_of(raw) if len(ids) else BINS]), ids


def bin_of(raw: float) -> int:
    return min(int(raw * BINS), BINS - 1)


def calibrate(bins: np.ndarray, toxic: np.ndarray, base: float) -> np.ndarray:
    """Score of each bin: its share of label 1, drawn to its raw score where rows are few, and never falling."""
    own = (np.arange(BINS + 1) + 0.5) / BINS
    own[BINS] = base
    n = np.bincount(bins, minlength=BINS + 1).astype(float)
    pos = np.bincount(bins, weights=toxic, minlength=BINS + 1)
    value, weight = (pos + 2 * own) / (n + 2), n + 2
    groups = []  # pool neighbours that fall
    for v, w in zip(value[:BINS], weight[:BINS]):
        groups.append([v, w, 1])
        while len(groups) > 1 and groups[-2][0] > groups[-1][0]:
            v2, w2, m2 = groups.pop()
            v1, w1, m1 = groups.pop()
            groups.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, m1 + m2])
    return np.array([v for v, _, m in groups for _ in range(m)] + [value[BINS]])


SCORES = "doc_id long, score double, evidence array<long>"


def _scores(vocabulary, shared):
    def run(batches):
        vocab, index = vocabulary.value, shared.value
        for batch in batches:
            for first, size, row, at, n in _rows(batch.column(1), vocab):
                edge = np.searchsorted(row, np.arange(size + 1))
                got = [index.score(at[a:b], n[a:b]) for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, size), pa.array([s for s, _ in got], pa.float64()),
                                                  pa.array([e.tolist() for _, e in got], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return run


def _chosen(rows: DataFrame, n: int) -> list:
    """At most n rows, drawn and in order by a hash of their ids."""
    rows = drawn(rows, n, "doc_id").withColumn("hash", F.xxhash64("doc_id")).collect()
    return sorted(rows, key=lambda r: (r["hash"], r["doc_id"]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` per row of ``docs(doc_id, text)``.

    ``labels(doc_id, toxic)``: only rows of ids that are not held out (crc32 of
    the id as text is 0 modulo 5) and of toxic 0 or 1 are read; an id labelled
    both ways counts as toxic. A text without any term of an example (null and
    empty ones too) gets the share of label 1 among such texts. Without labels every
    score is 0.5 at most and nothing is predicted. Repeated rows are scored
    alike; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    share = spark.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    train = train.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = scratch.save(train.withColumn("part", F.expr("pmod(xxhash64(doc_id, 'part'), 4)")), "train")
    total = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    base = total.get(1, 0) / max(sum(total.values()), 1)

    by_label = {y: _chosen(train.where(f"part > 0 AND toxic = {y}"), TERM_ROWS) for y in (0, 1)}
    sample = sorted((r["doc_id"], y) for y, rows in by_label.items() for r in rows)
    sample = tuple(np.array(x, np.int64) for x in (zip(*sample) if sample else ((), ())))
    label = {r["doc_id"]: y for y, rows in by_label.items() for r in rows}

    def texts(rows: list) -> DataFrame:
        """``(doc_id, text)`` of some ids, once each: at most 2 * EXAMPLES or CALIBRATION_ROWS."""
        ids = spark.createDataFrame([(r["doc_id"],) for r in rows], "doc_id long")
        return docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    examples = texts([r for rows in by_label.values() for r in rows[:EXAMPLES]]).mapInArrow(_hashed, HASHED).toArrow().combine_chunks().sort_by("doc_id")
    ids = examples["doc_id"].to_numpy()
    size = examples["terms"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    hashes = examples["terms"].combine_chunks().flatten().to_numpy().view(np.uint64) if len(ids) else np.zeros(0, np.uint64)
    often = examples["counts"].combine_chunks().flatten().to_numpy() if len(ids) else np.zeros(0, np.int32)
    vocab, at = np.unique(hashes, return_inverse=True)
    vocabulary = share(vocab)

    counted = docs.mapInArrow(_count(vocabulary, share(sample)), COUNTED).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "pos", "neg")]).toArrow()
    sums = np.zeros((3, len(vocab) + 1), np.int64)  # -1 is the last place
    sums[:, counted["term"].to_numpy()] = [counted[c].to_numpy() for c in ("df", "pos", "neg")]
    (df, a, b), (n_docs, n1, n0) = sums[:, :-1].astype(float), sums[:, -1].astype(float)
    off = a * (n0 - b) - b * (n1 - a)
    chi = (n1 + n0) * off * off / np.maximum((a + b) * (n1 + n0 - a - b) * n1 * n0, 1)
    weight = (np.log((n_docs + 1) / (df + 1)) + 1) * (EVEN + (1 - EVEN) * chi / (chi + CHI_SQUARED))

    toxic = np.array([label[i] for i in ids], float)
    votes = np.zeros(len(ids))
    for y in (0, 1):
        votes[toxic == y] = total.get(y, 0) / max((toxic == y).sum(), 1)
    example, v = np.repeat(np.arange(len(ids)), size), (1 + np.log(often)) * weight[at]
    norm = np.sqrt(np.bincount(example, weights=v * v, minlength=len(ids)))
    index = Index(ids, toxic, votes, weight, Lists(at, example, v / np.maximum(norm, 1e-12)[example], len(vocab), len(ids)), None, base)

    judged = _chosen(train.where("part = 0"), CALIBRATION_ROWS)
    truth = {r["doc_id"]: r["toxic"] for r in judged}
    seen = [(truth[r["doc_id"]], r["score"], r["near"]) for r in texts(judged).mapInArrow(_scores(vocabulary, share(index)), SCORES).select("doc_id", "score", (F.size("evidence") > 0).alias("near")).collect()]
    bins = np.array([bin_of(r) if near else BINS for _, r, near in seen], np.int64)
    # the broadcast one stays as it is, without bins
    index = replace(index, bins=calibrate(bins, np.array([y for y, *_ in seen], float), base))
    scratch.drop("train")

    scored = docs.mapInArrow(_scores(vocabulary, share(index)), SCORES)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
