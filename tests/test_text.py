"""Tokenizers, Java-style field splitting, text sources (incl. malformed lines)."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from quillrank.functions.text import split_fields, token_array, token_array_glued
from quillrank.sources import parse_articles, parse_pairs, read_arcs, read_articles, read_labels


def arrays(spark, col_fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_split_fields_drops_trailing_empties(spark):
    got = arrays(spark, lambda c: split_fields(c, "\t"), ["9", "9\t", "\t", "", "a\t\tb", "\t5", "a\tb\t\t"])
    assert got == [["9"], ["9"], [], [""], ["a", "", "b"], ["", "5"], ["a", "b"]]


def test_split_fields_whitespace(spark):
    got = arrays(spark, lambda c: split_fields(c, r"\s+"), ["2 Beta Two", "  1 2", "7\tIsolated ", " "])
    assert got == [["2", "Beta", "Two"], ["", "1", "2"], ["7", "Isolated"], []]


def test_tokens_of_sample_article(spark, lines):
    art = parse_articles(lines(fx.ARTICLE_LINES[:1]))
    assert art.select(token_array("body")).first()[0] == fx.TOKENS_ARTICLE_1
    assert art.select(token_array_glued("body")).first()[0] == fx.GLUED_ARTICLE_1


def test_empty_and_non_letter_bodies(spark):
    plain = arrays(spark, token_array, ["", "<x/>", "123 !!"])
    glued = arrays(spark, token_array_glued, ["", "<x/>", "123 !!", " a b", "a\\nb"])
    assert plain == [[""], [""], [""]]
    # Glued: empty -> one empty word; only non-letters -> none; leading space -> leading "".
    assert glued == [[""], [""], [], ["", "a", "b"], ["ab"]]


def test_escaped_newline_is_a_separator(spark):
    assert arrays(spark, token_array, ["a\\nb", "x\\\\ny"]) == [["a", "b"], ["x", "y"]]


def test_entities_not_decoded(spark):
    assert arrays(spark, token_array, ["Rain&amp;sun"]) == [["rain", "amp", "sun"]]


def test_failfast_rejects_short_records(spark, lines):
    for bad in ["9", "9\t", "\t", ""]:
        with pytest.raises(Exception, match="malformed"):
            parse_pairs(lines([bad]), ("src", "dst")).collect()
    with pytest.raises(Exception, match="malformed"):
        parse_articles(lines(["1\tT\t2010\t"])).collect()


def test_dropmalformed_keeps_legal_odd_records(spark, lines):
    got = parse_pairs(lines(["9", "9\t", "\t", "", "a\t\tb", "\t5", "1\t2"]), ("src", "dst"),
                      mode="DROPMALFORMED").collect()
    assert sorted(tuple(r) for r in got) == [("", "5"), ("1", "2"), ("a", "")]
    arts = parse_articles(lines(["1\tT\t2010\t", "1\tT\t2010\t\tplain"]), mode="DROPMALFORMED").collect()
    assert [(r.title, r.body, r.plain) for r in arts] == [("T", "", "plain")]


def test_whitespace_labels_cut_at_first_space(spark, lines):
    got = parse_pairs(lines(fx.LABEL_LINES), ("id", "name"), "ws").collect()
    assert dict((r.id, r.name) for r in got)["2"] == "Beta"
    got = parse_pairs(lines(fx.LABEL_LINES), ("id", "name"), "tab").collect()
    assert dict((r.id, r.name) for r in got)["2"] == "Beta Two"


def test_file_readers(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "part-0.txt").write_text("\n".join(fx.ARTICLE_LINES) + "\n")
    (tmp_path / "arcs.txt").write_text("\n".join(l.replace("\t", "  ") for l in fx.ARC_LINES) + "\n")
    (tmp_path / "labels.txt").write_text("\n".join(fx.LABEL_LINES) + "\n")
    arts = read_articles(spark, f"file://{tmp_path}/a")
    assert arts.count() == 6 and arts.where("title = 'Beta, Inc'").count() == 1
    assert read_arcs(spark, f"file://{tmp_path}/arcs.txt", delimiter="ws").count() == 8
    assert read_labels(spark, f"file://{tmp_path}/labels.txt").count() == 6


def test_plain_single_space_split(spark):
    # A plain " " split keeps a tab inside its field.
    got = arrays(spark, lambda c: F.split(c, " "), ["a\tb c"])
    assert got == [["a\tb", "c"]]
