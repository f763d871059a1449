"""The keyed weight table and the salted join of hot words."""

import os
import re

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from conftest import SF_SMALL
from quillrank.operators import tfidf as ops
from quillrank.operators.keyed import WeightTable
from quillrank.operators.tfidf import hot_words, tfidf, tfidf_term, tfidf_topk
from quillrank.plans.inspect import executed, plan_text
from quillrank.plans.registry import pages_articles
from quillrank.sources import parse_articles


def rows(df):
    return sorted((r.word, r.title, r.tf, r.df, round(r.w, 9)) for r in df.collect())


@pytest.fixture()
def table(spark, tmp_path):
    return WeightTable.build(pages_articles(spark, SF_SMALL), f"file://{tmp_path}/weights", buckets=16)


def test_lookups_equal_the_single_term_query(spark, table, tmp_path):
    arts = pages_articles(spark, SF_SMALL)
    again = WeightTable.open(spark, f"file://{tmp_path}/weights")
    for term in ("the", "", "nosuchword"):
        assert rows(table.lookup(term)) == rows(again.lookup(term)) == rows(tfidf_term(arts, term))
    for kw in ({}, {"title_key": "before_comma"}):
        assert [tuple(r) for r in again.topk("the", 10, digits=9, **kw).collect()] == [tuple(r) for r in tfidf_topk(arts, "the", 10, digits=9, **kw).collect()]
    assert rows(again.rows) == rows(tfidf(arts))


def test_a_lookup_reads_one_bucket(spark, table):
    """The filter reaches the file's statistics, nothing moves, and with all other buckets' files gone the result is the same."""
    df = table.lookup("the")
    text = plan_text(df, "simple")
    assert "EqualTo(word,the)" in text and "Exchange" not in text
    want = rows(df)
    (name,) = {f for (f,) in df.select(F.input_file_name()).distinct().collect()}
    bucket, files = re.search(r"_(\d+)\.", name)[1], [f.replace("file://", "") for f in table.rows.inputFiles()]
    others = [f for f in files if re.search(r"_(\d+)\.", f)[1] != bucket]
    assert len(others) > len(files) // 2
    for f in others:
        os.truncate(f, 0)  # reading any of them would fail now
    assert rows(table.lookup("the")) == want
    with pytest.raises(Exception):
        table.rows.count(), table.rows.collect()


def test_a_table_of_terms_moves_alone(spark, table):
    terms = spark.createDataFrame([("the",), ("nosuchword",), (None,), ("the",)], "term string")
    low = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = table.lookup_all(terms, "term")
        assert rows(df) == rows(table.lookup("the"))
        final = plan_text(df, "simple").split("+- == Initial Plan ==")[0]
        assert "Bucketed: true" in final
        assert all("word" in line or "term" in line for line in re.findall(r"Exchange hashpartitioning.*", final))
        assert final.count("Exchange hashpartitioning") == 1  # of the terms
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", low)


def test_no_entry_is_left_in_the_catalog(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    WeightTable.build(pages_articles(spark, SF_SMALL), f"file://{tmp_path}/w", buckets=2)
    WeightTable.open(spark, f"file://{tmp_path}/w")
    assert {t.name for t in spark.catalog.listTables()} == before


def test_no_articles(spark, lines, tmp_path):
    empty = WeightTable.build(parse_articles(lines([])), f"file://{tmp_path}/w", buckets=2)
    assert empty.lookup("the").count() == 0
    assert WeightTable.open(spark, f"file://{tmp_path}/w").rows.count() == 0


# ------------------------------------------------------------------ hot words
def test_salted_weights_equal_the_plain_ones(spark, lines, monkeypatch):
    monkeypatch.setattr(ops, "HOT_PART", 1000)  # every word is hot
    arts = parse_articles(lines(fx.ARTICLE_LINES))
    assert rows(tfidf(arts, split_hot=True)) == rows(tfidf(arts))
    pages = pages_articles(spark, SF_SMALL)
    assert rows(tfidf(pages, split_hot=True, keep_empty=False)) == rows(tfidf(pages, keep_empty=False))


def test_hot_words_are_few_whatever_the_corpus(spark):
    df = spark.range(5000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.floor(F.lit(1e6) / (F.col("id") + 1)).cast("long").alias("df"))
    hot = hot_words(df, 8).collect()
    assert 0 < len(hot) <= 8 * ops.HOT_PART and sum(r.salts for r in hot) <= 2 * 8 * ops.HOT_PART
    assert all(r.salts >= 2 for r in hot)
    assert hot_words(df.limit(0), 8).count() == 0


def one_word_everywhere(spark, n=6000):
    """Every title has 'everywhere'; it is a third of all rows."""
    word = F.translate(F.hex(F.xxhash64("id", "k")), "0123456789", "ghijklmnop")
    other = spark.range(n).select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).select("id", F.lower(word).alias("w"))
    body = other.groupBy("id").agg(F.concat_ws(" ", F.lit("everywhere"), F.collect_list("w")).alias("body"))
    return body.select(F.concat(F.lit("t"), "id").alias("title"), "body")


def test_one_word_in_every_title_is_dealt_out_evenly(spark):
    """Without adaptive execution's skew split, the largest task of the salted join has less than twice the median."""
    arts = one_word_everywhere(spark).persist()
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}

    def sizes(split_hot):
        per = tfidf(arts, split_hot=split_hot).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        return sorted(r["count"] for r in per)

    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        salted, plain = sizes(True), sizes(False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        arts.unpersist()
    assert sum(salted) == sum(plain) == 18_000 and len(salted) == 8
    assert salted[-1] < 2 * salted[4] and plain[-1] > 3 * plain[4]


def test_the_salted_plan_reads_the_corpus_once(spark):
    df = tfidf(pages_articles(spark, SF_SMALL), split_hot=True)
    df.collect()
    assert executed(df, "ColumnarToRow") == 1 and "ReusedExchange" in plan_text(df, "simple")
