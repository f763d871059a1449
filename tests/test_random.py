"""Randomized inputs against the brute-force models in ``brute.py``."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from quillrank import pagerank, tfidf

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

node = st.integers(min_value=1, max_value=8).map(str)
arc = st.tuples(node, node).filter(lambda a: a[0] != a[1])
label = st.tuples(node, st.sampled_from(["a", "b", "c"]))
chunk = st.sampled_from(["the", "Cloud", "<b>x</b>", "a\\nb", "1 2", "&amp;", " ", "", "rain,", "<p/>"])
article = st.tuples(st.sampled_from(["T1", "T2", "T3, x"]), st.lists(chunk, max_size=6).map("".join))


def near(a, b):
    return a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@settings(**SETTINGS)
@given(arcs=st.lists(arc, max_size=14), labels=st.lists(label, max_size=8),
       variant=st.sampled_from(["A", "B", "C"]), iterations=st.integers(1, 4))
def test_pagerank_matches_model(spark, arcs, labels, variant, iterations):
    a = spark.createDataFrame(arcs, "src string, dst string")
    lab = spark.createDataFrame(labels, "id string, name string")
    kw = {"A": dict(dangling=True, normalizer="distinct_contribs"),
          "B": dict(dangling=True, normalizer="distinct_labels"), "C": {}}[variant]
    got = {r.id: r.rank for r in pagerank(a, lab, iterations=iterations, **kw).collect()}
    assert near(got, brute.pagerank(arcs, labels, iterations, variant))


@settings(**SETTINGS)
@given(articles=st.lists(article, min_size=1, max_size=6))
def test_tfidf_matches_model(spark, articles):
    df = spark.createDataFrame(articles, "title string, body string")
    got = {(r.word, r.title): (r.tf, r.df, r.w) for r in tfidf(df).collect()}
    exp = brute.tfidf(articles)
    assert got.keys() == exp.keys()
    assert all(got[k][:2] == exp[k][:2] and abs(got[k][2] - exp[k][2]) < 1e-12 for k in exp)
