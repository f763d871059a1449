"""Retrieval against plain BM25 over all passages and items, and verified overlap."""

import math

import numpy as np
import pyarrow as pa

import cases
from quillrank.llm import decontamination as d
from quillrank.llm import words

SF = "/root/testdata/sf0.01"


def split(text):
    return (text or "").encode().translate(bytes(d.FOLD)).split()


def brute_scores(items, passage):
    """BM25 of each item for a passage's distinct words, and its own threshold."""
    docs = [split(t) for _, t in items]
    mean = sum(map(len, docs)) / len(docs)

    def score(query, doc):
        out = 0.0
        for w in set(query):
            df, tf = sum(w in x for x in docs), doc.count(w)
            if tf:
                out += math.log1p((len(docs) - df + 0.5) / (df + 0.5)) * tf * (d.K1 + 1) / (tf + d.K1 * (1 - d.B + d.B * len(doc) / mean))
        return out

    return [score(passage, x) for x in docs], [d.SHARE * score(x, x) for x in docs]


def test_retrieval_matches_plain_bm25():
    items = [(i, cases.prose(i, 20 + 3 * i) + ".\n" + cases.prose(50 + i, 6)) for i in range(21)]
    texts = [cases.prose(900 + i, 150) + " " + items[i][1].upper() + " " + cases.prose(950 + i, 40) for i in range(8)] + [cases.prose(3, 10), "", None, "the"]
    index, want, got = d.build_index(items), set(), {}
    for row, t in enumerate(texts):
        w = split(t)
        for b in range(0, max(1, math.ceil((len(w) - d.PASSAGE) / d.STRIDE) + 1) * d.STRIDE if w else 0, d.STRIDE):
            scores, need = brute_scores(items, w[b : b + d.PASSAGE])
            want |= {(row, b, j) for j in range(len(items)) if scores[j] >= need[j] * 1.001}
            got |= {(row, b, j): scores[j] for j in range(len(items))}
    found = [(first + r, b, j, s) for first, block in words.scan(pa.array(texts), fold=d.FOLD) for r, b, j, s in d.retrieve(index, block)]
    assert want <= {(r, b, j) for r, b, j, _ in found}
    assert all(abs(s - got[r, b, j]) < 1e-3 for r, b, j, s in found)
    assert {(r, j) for r, _, j, _ in found} >= {(i, i) for i in range(8)}


def test_planted_items_of_a_table(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts, tests = docs.collect(), items.collect()
    want = {(r.doc_id, t.item_id) for r in texts for t in tests if t.text in r.text}
    found = d.find_contamination(docs, items).collect()
    assert want and {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.question_overlap >= 0.8 and r.bm25 > 0 and r.n_passages >= 1 for r in found)
    kept = {r.doc_id for r in d.decontaminate(docs, items).collect()}
    assert kept == {r.doc_id for r in texts} - {i for i, _ in want}


def test_chunks_give_the_same(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in d.find_contamination(docs, items).collect()}
    monkeypatch.setattr(d, "CHUNK_ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in d.find_contamination(docs, items).collect()} == whole


def test_question_and_answer_are_both_asked(spark):
    q, a = cases.prose(1, 30) + ".", "Ontish edalic the oroned enshou alictish onre."
    items = spark.createDataFrame([(1, f"{q} {a}")], "item_id long, text string")
    near = " ".join(w for i, w in enumerate(q.split()) if i != 14)
    rows = [(1, f"{cases.prose(7, 50)} {q} {a} {cases.prose(8, 50)}"), (2, f"{near} {a}"), (3, " ".join(q.split()[:12])), (4, a), (5, q.lower() + cases.prose(9, 80))]
    got = {r.doc_id: (r.question_overlap, r.answer_overlap) for r in d.find_contamination(cases.plain(spark, rows), items).collect()}
    assert set(got) == {1, 2, 5} and got[1] == (1.0, 1.0) and got[5][1] < 0.5


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, cases.prose(5, 40)), (1, cases.prose(5, 40)), (2, None), (None, "x y z"), (3, ""), (4, "?!"), (5, "word")], "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id) for r in d.find_contamination(cases.odd(spark), items).collect())
    assert [g for g in got if g[1] == 1] == [("5", 1), ("5", 1), ("6", 1)] and ("4", 5) in got
    kept = d.decontaminate(cases.odd(spark), items)
    assert kept.columns == cases.odd(spark).columns and kept.count() == len(cases.ODD) - len({i for i, _ in got}) - 1
    none = items.where("false")
    assert d.find_contamination(cases.odd(spark), none).count() == 0 and d.decontaminate(cases.odd(spark), none).count() == len(cases.ODD)
    assert d.find_contamination(cases.none(spark), items).count() == 0 and d.decontaminate(cases.none(spark), items).count() == 0
    assert not np.isnan([s for r in d.find_contamination(cases.odd(spark), items).collect() for s in (r.bm25, r.answer_overlap)]).any()


def test_items_longer_than_a_passage(spark):
    # every word once, so a passage holds 64 / n of an item's score
    word = lambda a, b: " ".join(f"w{i}x" for i in range(a, b))
    items = [(1, f"{word(0, 260)}. {word(260, 300)}."), (2, f"{word(1000, 1020)}. {word(1020, 1320)}."), (3, f"{word(2000, 2090)}."), (4, f"{word(3000, 4000)}. {word(4000, 4010)}.")]
    rows = [(10 * i + shift, f"{cases.prose(i, 40 + shift)} {t} {cases.prose(50 + i, 90)}") for i, t in items for shift in (0, 7, 13)]
    rows += [(90, f"{cases.prose(3, 70)} {word(1000, 1020)} {cases.prose(4, 70)}"), (91, cases.prose(5, 400)), (92, word(0, 100))]
    docs, tests = cases.plain(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = {(10 * i + shift, i) for i, _ in items for shift in (0, 7, 13)} | {(90, 2)}  # 90: the question alone
    assert {(r.doc_id, r.item_id) for r in d.find_contamination(docs, tests).collect()} == want
    assert {r.doc_id for r in d.decontaminate(docs, tests).collect()} == {91, 92}
