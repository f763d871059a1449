from itertools import permutations

import hypothesis.strategies as st
import pytest
from cases import EXTRA, none, odd, plain, prose
from hypothesis import HealthCheck, given, settings

from quillrank.llm import filter_audit as fa

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for s in SPACE:
        text = text.replace(s, " ")
    return [w for w in text.split(" ") if w]


def brute(docs, labels):
    """(part, order, step) -> counts, one document and one order after the other."""
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        t, w = text or "", words_of(text or "")
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)}
        rows.append((lang or "", i, {f for f in fails if fails[f]}))
    out = {}
    for part in {p for p, _, _ in rows}:
        mine = [(i, f) for p, i, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                before = set(order[: step - 1])
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in x[1] and bool(before & x[1]) for x in mine), sum(x[1] == {f} for x in mine),
                                          sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def got(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = fa.filter_audit(d, lab).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"w{i}" for i in range(120))
DOCS = [(1, LONG, "en"), (2, LONG, "fr"), (2, LONG, "fr"), (3, LONG + " #", "en"), (4, None, "en"), (5, "", None), (6, "ABC", "en"), (None, LONG, "en"),
        (7, LONG, "en"), (7, "other", None), (8, "a " * 300, "fr"), (9, "x" * 500_000, "en"), (10, "Ä" * 9 + "A", "en"), (11, "Ä" * 8 + "AB", "en"), (None, None, None)]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (7, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def test_every_order_equals_brute_force(spark):
    assert got(spark, DOCS, LABELS) == brute(DOCS, LABELS)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from([None, "", "A b", "a #", LONG, LONG + " %", "Q " + LONG, "a " * 130]), st.sampled_from([None, "", "en"])), min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(1, 6), st.integers(0, 1), st.integers(0, 1)), max_size=5))
def test_random_tables(spark, docs, labels):
    assert got(spark, docs, labels) == brute(docs, labels)


def test_path_counts_are_products_of_factorials():
    edges = {(s, f): n for s, f, n in fa.path_counts(5)}
    assert len(edges) == 80
    assert edges[0, 0] == 24 and edges[0b11, 2] == 2 * 2 and edges[0b11110, 0] == 24
    for f in range(5):
        assert sum(n for (_, g), n in edges.items() if g == f) == 120


def test_odd_inputs(spark):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    out = fa.filter_audit(odd(spark), labels)
    assert out.where("filter_order = 'ABCDE' AND step = 1").selectExpr("sum(kept + removed)").first()[0] == 13
    assert fa.filter_audit(none(spark), labels).count() == 0
    assert "n long" in EXTRA  # the operator's own column names are among the extra ones
    empty = labels.limit(0)
    assert fa.filter_audit(plain(spark, [(1, prose(1, 120))]).selectExpr("*", "'x' AS lang"), empty).count() == 600


def test_other_part_column(spark):
    docs = spark.createDataFrame([(1, "a", "s1"), (2, "a", "s2")], "doc_id long, text string, source string")
    sets = fa.failed_sets(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), part="source")
    assert {(r.part, r.mask, r.n) for r in sets.collect()} == {("s1", 0b1, 1), ("s2", 0b10001, 1)}


@pytest.mark.parametrize("text,mask", [("", 1), ("a b", 1), ("Aa" * 5, 5), ("A" + "a" * 9, 1), ("$", 9)])
def test_limits(text, mask):
    import numpy as np
    import pyarrow as pa

    from quillrank.llm import words
    (_, block), = words.scan(pa.array([text]))
    assert fa.failed_by_text(np.frombuffer(text.encode(), np.uint8), block.of(0)) == mask
