"""Nearest examples against all cosines, and scores on rows that were held out."""

import zlib

import numpy as np
import pytest

import cases
from quillrank.llm import toxicity as t


def index(seed, n, terms):
    rng = np.random.default_rng(seed)
    rows = np.where(rng.random((n, terms)) < 0.1, rng.random((n, terms)), 0).astype(np.float32)
    rows /= np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-9)
    most = np.maximum.reduceat(rows, np.arange(0, n, t.BLOCK), axis=0)
    return t.Index(np.arange(n), rng.integers(0, 2, n).astype(float), np.ones(n), np.ones(terms), rows, most, 0.2)


@pytest.mark.parametrize("seed", range(5))
def test_nearest_are_exact(seed):
    x, rng = index(seed, 500, 60), np.random.default_rng(100 + seed)
    for _ in range(20):
        at = np.sort(rng.choice(60, rng.integers(1, 12), replace=False))
        v = x.vector(at, rng.integers(1, 4, len(at)))
        found, cosines = x.nearest(at, v)
        want = x.rows[:, at] @ v
        best = np.lexsort((np.arange(500), -np.round(want, 9)))[: t.NEIGHBOURS]
        best = best[want[best] > 0]
        assert np.allclose(want[best], cosines) and found.tolist() == best.tolist()


@pytest.mark.parametrize("seed", range(3))
def test_ties_at_the_last_place_go_to_the_first_examples(seed):
    """Forty equal examples around the 25th place, in long and in short lists."""
    rng = np.random.default_rng(seed)
    rows = np.zeros((400, 50), np.float32)
    rows[:, 0] = 1  # in every example
    rows[rng.choice(400, 10, replace=False), 1] = 2
    rows[rng.choice(400, 40, replace=False), 2] = 1.5
    rows /= np.sqrt((rows * rows).sum(1, keepdims=True))
    x = t.Index(np.arange(400), np.zeros(400), np.ones(400), np.ones(50), rows, None, 0.2)
    at = np.array([0, 1, 2])
    v = x.vector(at, np.ones(3))
    found, cosines = x.nearest(at, v)
    want = x.rows[:, at].astype(float) @ v
    best = np.lexsort((np.arange(400), -np.round(want, 9)))[: t.NEIGHBOURS]
    assert found.tolist() == best.tolist() and np.allclose(want[best], cosines, atol=1e-9)
    assert (np.round(want, 9) == np.round(want[best[-1]], 9)).sum() > 10


def test_an_index_that_was_sent_is_the_same():
    import pickle

    x = index(3, 500, 60)
    again = pickle.loads(pickle.dumps(x.lists))
    assert (again.long == x.lists.long).all() and len(again.long) and again.__dict__.keys() == x.lists.__dict__.keys()
    assert len(pickle.dumps(x.lists)) < 24 * len(x.lists.entries[0]) + 24 * len(x.lists.example) + 20_000


def test_blocks_that_cannot_reach_the_nearest_are_not_read(monkeypatch):
    """Short lists of far blocks stay unread, and the result is that of all cosines."""
    rng = np.random.default_rng(7)
    rows = np.where(rng.random((2000, 300)) < 0.002, rng.random((2000, 300)), 0).astype(np.float32)
    rows[:, :20] = 0.1 + rng.random((2000, 20)) * 0.01
    rows[:, 299] = 1
    rows[64:128, 20:60] += (rng.random((64, 40)) < 0.5) * 2.0  # one block shares many terms
    rows /= np.sqrt((rows * rows).sum(1, keepdims=True))
    x = t.Index(np.arange(2000), np.zeros(2000), np.ones(2000), np.ones(300), rows, None, 0.2)
    at = np.arange(60)
    v, read, ranges = x.vector(at, np.ones(60)), [], t._ranges
    monkeypatch.setattr(t, "_ranges", lambda lo, hi: read.append(int((hi - lo).sum())) or ranges(lo, hi))
    found, _ = x.nearest(at, v)
    want = x.rows[:, at].astype(float) @ v
    best = np.lexsort((np.arange(2000), -np.round(want, 9)))[: t.NEIGHBOURS]
    assert found.tolist() == best.tolist() and sum(read[1:]) < 0.95 * (x.rows[:, 20:60] > 0).sum() and len(found) == t.NEIGHBOURS


def test_the_form_of_the_weight_is_the_best_of_its_folds():
    """Four folds of the training rows of sf0.1 alone: weights, examples and votes of three, ranks of the fourth."""
    import pyarrow.parquet as pq

    from quillrank.llm import words
    d = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{d}/labels.parquet").to_pylist()}
    table = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"])
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in labels}
    counts = []
    for _, block in words.scan(table["text"], lower=True):
        h, row = t.terms(block)
        order = np.argsort(row, kind="stable")
        for i, part in enumerate(np.split(h[order], np.searchsorted(row[order], np.arange(1, len(block))))):
            counts.append(np.unique(part, return_counts=True))
    ids = table["doc_id"].to_pylist()
    vocab, df = np.unique(np.concatenate([h for h, _ in counts]), return_counts=True)
    mine = [(np.searchsorted(vocab, counts[k][0]), counts[k][1], labels[i], fold[i]) for k, i in enumerate(ids) if fold.get(i, 0)]
    idf = np.log((len(ids) + 1) / (df + 1)) + 1

    def area(even):
        out = []
        for f in (1, 2, 3, 4):
            seen, judged = [m for m in mine if m[3] != f], [m for m in mine if m[3] == f]
            y = np.array([m[2] for m in seen], float)
            a, b = (sum(np.bincount(m[0], minlength=len(vocab)) for m in seen if m[2] == want) for want in (1, 0))
            n1, n0 = y.sum(), len(y) - y.sum()
            off = a * (n0 - b) - b * (n1 - a)
            chi = (n1 + n0) * off * off / np.maximum((a + b) * (n1 + n0 - a - b) * n1 * n0, 1)
            weight = idf * (even + (1 - even) * chi / (chi + t.CHI_SQUARED))
            v = [(1 + np.log(m[1])) * weight[m[0]] for m in seen]
            v = [x / max(np.sqrt((x * x).sum()), 1e-12) for x in v]
            lists = t.Lists(np.concatenate([m[0] for m in seen]), np.repeat(np.arange(len(seen)), [len(m[0]) for m in seen]), np.concatenate(v), len(vocab), len(seen))
            index = t.Index(np.arange(len(seen)), y, np.ones(len(seen)), weight, lists, None, y.mean())
            s, truth = np.array([index.raw(m[0], m[1])[0] for m in judged]), np.array([m[2] for m in judged])
            rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
            k = truth.sum()
            out.append((rank[truth == 1].sum() - k * (k - 1) / 2) / (k * (len(s) - k)))
        return np.mean(out)

    plain, weighted = area(1.0), area(t.EVEN)
    assert weighted > 0.97 and weighted > plain + 0.03


def test_far_examples_decide_little():
    x = index(1, 200, 40)
    x.toxic[:] = 1
    near, far = x.raw(np.flatnonzero(x.rows[3]), np.ones((x.rows[3] > 0).sum()))[0], x.raw(np.zeros(0, int), np.zeros(0))[0]
    assert near > 0.7 and far == x.base


def test_calibration_never_falls_and_keeps_sparse_bins_near():
    bins = np.array([0] * 100 + [10] * 50 + [19] * 50 + [t.BINS] * 100)
    toxic = np.array([0.0] * 100 + [1] * 20 + [0] * 30 + [1] * 50 + [0] * 99 + [1])
    out = t.calibrate(bins, toxic, 0.1)
    assert (np.diff(out[: t.BINS]) >= 0).all() and out[0] < 0.05 and 0.3 < out[10] < 0.5 and out[19] > 0.9 and out[t.BINS] < 0.05


def test_held_out_rows_of_a_table(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = t.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    judged = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    hit = np.mean([p for y, p in judged if y])
    false = np.mean([p for y, p in judged if not y])
    assert hit > 0.8 and false < 0.02  # some labels of this small table have no word to learn from
    # labels of held-out rows are never read
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {(r.doc_id, round(r.score, 9)) for r in t.toxicity(docs, turned).collect()} == {(r.doc_id, round(r.score, 9)) for r in rows}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, 0), (10, None), (None, 1), (9, 7)], "doc_id long, toxic int")
    for known in (labels, labels.where("false"), labels.where("toxic = 1")):
        got = t.toxicity(cases.odd(spark), known).collect()
        assert len(got) == len(cases.ODD) and all(0 <= r.score <= 1 for r in got)
        assert sum(r.doc_id is None and not r.held_out for r in got) == 2
    assert all(r.predicted == 0 for r in t.toxicity(cases.odd(spark), labels.where("false")).collect())
    assert t.toxicity(cases.none(spark), labels).count() == 0


def test_ordinary_and_rare_words_count(spark):
    rng = np.random.default_rng(4)
    signal, common = [f"sig{i}n" for i in range(12)], [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        # each signal word is about five times as frequent with label 1
        text = [w for w in signal if rng.random() < (0.5 if toxic else 0.1)] + rng.choice(common, 30).tolist()
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    # words that two documents alone have, one of them labelled
    known = [i for i in range(5000, 5040) if zlib.crc32(str(i).encode()) % 5][:6]
    for i in known:
        text = " ".join(f"q{i}z{j}" for j in range(30))
        rows += [(i, text), (i + 4000, text)]
        labels.append((i, 1))
    got = {r.doc_id: r for r in t.toxicity(cases.plain(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    judged = [(y, got[i].predicted) for i, y in labels if got[i].held_out]
    assert np.mean([p for y, p in judged if y]) > 0.8 and np.mean([p for y, p in judged if not y]) < 0.1
    assert sum(got[i + 4000].evidence[:1] == [i] for i in known) >= 3  # the others are for calibration


def test_short_lists_are_read_whole_where_bounds_leave_out_next_to_nothing(monkeypatch):
    """By lists, not by their blocks; otherwise in part. Either way the nearest are those of all cosines."""
    rng = np.random.default_rng(11)
    calls, whole, ranges = [], set(), t._ranges
    monkeypatch.setattr(t, "_ranges", lambda lo, hi: calls.append(len(lo)) or ranges(lo, hi))
    for close in (False, True):  # with close examples in one block, the bounds of the others are too low
        dense = np.where(rng.random((1280, 300)) < 0.02, rng.random((1280, 300)), 0)
        dense[:, 0] = 0.02
        if close:
            dense[:64] = 0
            dense[:64, 0] = 1.0
        example, term = np.nonzero(dense)
        lists = t.Lists(term, example, dense[example, term], 300, 1280)
        for _ in range(20):
            at = np.unique(np.append(0, rng.integers(0, 300, 40)))
            v = np.where(at == 0, 10.0 if close else 0.1, 0.3 * rng.random(len(at)))
            calls.clear()
            found, cosine = lists.nearest(at, v, 25)
            want = dense.astype(np.float32)[:, at].astype(float) @ v
            best = np.lexsort((np.arange(1280), -np.round(want, 9)))[:25]
            assert found.tolist() == best.tolist() and np.allclose(cosine, want[best], atol=1e-9)
            whole.add((close, calls[2] == (lists.row[at] < 0).sum()))
    assert whole == {(False, True), (True, False)}
    # few or no short lists, and lists of first blocks alone
    for at in ([0], [0, 5], [5], [1, 2, 3]):
        at = np.array(at)
        found, cosine = lists.nearest(at, np.ones(len(at)), 25)
        want = dense.astype(np.float32)[:, at].astype(float).sum(1)
        best = np.lexsort((np.arange(1280), -np.round(want, 9)))[:25]
        assert found.tolist() == [i for i in best if want[i] > 0] and np.allclose(cosine, want[found], atol=1e-9)


def test_bounds_are_left_out_for_a_while_where_they_leave_out_nothing(monkeypatch):
    """Fewer ranges are read then; the nearest are those of all cosines, and bounds are tried again."""
    rng = np.random.default_rng(12)
    dense = np.where(rng.random((1280, 300)) < 0.02, rng.random((1280, 300)), 0).astype(np.float32)
    dense[:, 0] = 0.02
    x, calls, ranges = t.Index(np.arange(1280), np.zeros(1280), np.ones(1280), np.ones(300), dense, None, 0.2), [], t._ranges
    monkeypatch.setattr(t, "_ranges", lambda lo, hi: calls.append(len(lo)) or ranges(lo, hi))
    used = []
    for _ in range(2 * t.TRIALS * (1 + t.PAUSE)):
        at = np.unique(np.append(0, rng.integers(1, 300, 40)))
        v = np.where(at == 0, 0.1, 0.3 * rng.random(len(at)))
        calls.clear()
        found, cosine = x.nearest(at, v)
        used.append(len(calls))
        want = dense[:, at].astype(float) @ v
        best = np.lexsort((np.arange(1280), -np.round(want, 9)))[: t.NEIGHBOURS]
        assert found.tolist() == best.tolist() and np.allclose(cosine, want[best], atol=1e-9)
    assert used == 2 * ([3] * t.TRIALS + [1] * t.TRIALS * t.PAUSE)
