"""Base statistics against plain Python, and the forest on labelled rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import cases
from quillrank.llm import quality_rules as q
from quillrank.llm import words

SF = "/root/testdata/sf0.01"


def brute(text):
    raw = (text or "").encode()
    own = raw.split()
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    count = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    return {"n_words": len(own), "word_chars": sum(len(w.decode()) for w in own), "n_symbols": sum(raw.count(bytes([c])) for c in b"#*$%&|<>"),
            "n_dup_lines": dup, "n_repeat_words": len(hit), "n_distinct": len(set(own))}


@pytest.mark.parametrize("size", [30, 1 << 16])
def test_statistics_match_plain_python(monkeypatch, size):
    monkeypatch.setattr(words, "BLOCK", size)
    r = random.Random(1)
    texts = [None, "", "\n\n", "a\na\n a\na", "é|# é", "x " * 12, "a b c d e f a b c d e"] + [t for _, t in cases.ODD if t != cases.ODD[7][1]]
    texts += ["".join(r.choice(["a", "b", " ", "\n", "é", "#", "ab ", "\t"]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    got = []
    for _, block in words.scan(pa.array(texts)):
        s = q.statistics(block)
        got += [{k: int(s[k][i]) for k in brute("")} for i in range(len(block))]
    assert got == [brute(t) for t in texts]


def test_verdicts_on_a_table(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = q.quality_rules(docs, labels).collect()
    for r in rows:
        b = brute(text[r.doc_id])
        assert all(r[k] == b[k] for k in q.BASE)
        assert r.base_failed == (b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"])
        assert not (r.base_failed and r.kept)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    judged = [r for r in rows if r.doc_id in truth and not r.base_failed]
    good, bad = ([r.kept for r in judged if truth[r.doc_id] == y] for y in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.05
    kept = {r.doc_id for r in q.keep_good(docs, labels).collect()}
    assert kept == {r.doc_id for r in rows if r.kept}


def test_isolation_and_threshold():
    rng = np.random.default_rng(1)
    rows = rng.normal(0.1, 0.01, (2000, len(q.FEATURES)))
    odd = rows[:50] + 0.5
    forest = q.grow(rows, trees=50)
    assert q.score(forest, odd).min() > q.score(forest, rows).max() - 0.05 and q.score(forest, odd).mean() > q.score(forest, rows).mean() + 0.1
    assert np.array_equal(q.score([], rows[:3]), [0.5] * 3)
    assert q.threshold([(1, 100, 90), (1, 700, 10), (0, 650, 50), (0, 100, 1)]) == 0.65
    assert q.threshold([(1, 10, 5)]) > 1 and q.threshold([]) > 1 and q.threshold([(1, 5, 5), (0, 5, 5)]) > 1


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1, 0), (10, 1, 0), (None, 0, 1), (7, None, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        got = q.quality_rules(cases.odd(spark), known).collect()
        assert len(got) == len(cases.ODD)
        assert all(not r.kept and r.base_failed for r in got if r.n_words == 0)
        assert sum(r.doc_id == 5 and r.n_words == 40 for r in got) == 2
        kept = q.keep_good(cases.odd(spark), known)
        assert kept.columns == cases.odd(spark).columns and kept.count() == sum(r.kept for r in got)
    assert q.quality_rules(cases.none(spark), labels).count() == 0 and q.keep_good(cases.none(spark), labels).count() == 0
