"""TF-IDF goldens (FIXTURES.md) and properties."""

import math

from pyspark.sql import functions as F

import fixtures as fx
from quillrank import tfidf, tfidf_term, tfidf_topk
from quillrank.operators.tfidf import doc_count, doc_freq, term_freq, tokens
from quillrank.sinks import write_lines
from quillrank.sources import articles_from_pages, parse_articles
from quillrank.sources.tables import table


def articles(lines):
    return parse_articles(lines(fx.ARTICLE_LINES))


def rows(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_full_table(spark, lines):
    assert rows(tfidf(articles(lines)), "word", "title", "tf", "df", "w") == sorted(
        (a, b, c, d, round(e, 9)) for a, b, c, d, e in fx.TFIDF_ALL
    )


def test_term_lookup_and_topk(spark, lines):
    arts = articles(lines)
    assert rows(tfidf_term(arts, "cloud"), "title", "tf", "w") == [
        ("Alpha", 3, 0.665546249), ("Beta, Inc", 2, 0.443697499), ("Delta", 1, 0.22184875)]
    top = [tuple(r) for r in tfidf_topk(arts, "cloud", k=2).collect()]
    assert [t for t, _ in top] == ["Alpha", "Beta, Inc"]
    # k larger than the result is safe (the original crashed below 100 rows).
    assert tfidf_topk(arts, "cloud", k=100).count() == 3
    assert tfidf_topk(arts, "nothing-here", k=100).count() == 0


def test_before_comma(spark, lines):
    got = rows(tfidf_topk(articles(lines), "cloud", title_key="before_comma"), "title", "w")
    assert got == [("Alpha", 0.665546249), ("Beta", 0.443697499), ("Delta", 0.22184875)]


def test_keep_empty_false_keeps_n(spark, lines):
    t = tfidf(articles(lines), keep_empty=False)
    assert t.where("word = ''").count() == 0
    # N stays 5 (the empty article still counts as a document).
    w = t.where("word = 'the'").first()
    assert abs(w.w - 2 * math.log10(5)) < 1e-12


def test_ties_break_on_title_desc(spark, lines):
    arts = parse_articles(lines(["1\tA\t0\tx", "2\tB\t0\tx", "3\tC\t0\ty"]))
    assert [r.title for r in tfidf_topk(arts, "x", k=1).collect()] == ["B"]


def test_properties_on_pages(spark):
    arts = articles_from_pages(table(spark, "/root/testdata/sf0.001", "pages"))
    toks = tokens(arts)
    tf = term_freq(toks)
    n = doc_count(arts).first()["n"]
    df = doc_freq(tf)
    assert df.agg(F.max("df")).first()[0] <= n
    assert tf.agg(F.sum("tf")).first()[0] == toks.count()
    t = tfidf(arts)
    assert t.where("w < 0").count() == 0
    assert t.count() == tf.count() == 9653
    assert t.where("df = %d" % n).select("word").distinct().count() == 8


def test_topk_sink(spark, lines, tmp_path):
    out = f"file://{tmp_path}/tfidf"
    write_lines(tfidf_topk(articles(lines), "cloud"), out, ["title", "w"], single_file=True)
    got = spark.read.text(out).collect()
    assert [r.value.split("\t")[0] for r in got] == ["Alpha", "Beta, Inc", "Delta"]


def test_null_bodies_count_for_n(spark):
    """Both paths, the document count and DuckDB agree."""
    import duckdb

    from quillrank.plans.oracle import tfidf_ctes, with_

    arts = spark.createDataFrame([(1, "A", "x y"), (2, "B", None), (3, "C", "x"), (4, None, "x")], "article_id long, title string, body string")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES ('A', 'x y'), ('B', NULL), ('C', 'x'), (NULL, 'x')) v(title, body)")
    want = con.execute(with_(tfidf_ctes("SELECT title, body FROM t"), "SELECT word, title, round(w, 9) FROM scored ORDER BY ALL")).fetchall()
    key = lambda r: (r[0], r[1] is None, r[1] or "")
    assert doc_count(arts).first()["n"] == 3
    got = [(r.word, r.title, round(r.w, 9)) for r in tfidf(arts).collect()]
    assert [r for r in sorted(got, key=key) if r[1]] == [r for r in sorted(want, key=key) if r[1]]
    one = {(r.title, round(r.w, 9)) for r in tfidf(arts, term="y").collect()}
    assert one == {(t, w) for word, t, w in got if word == "y"}
    assert one == {("A", 0.477121255)}
