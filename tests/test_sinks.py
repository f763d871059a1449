"""Sinks: ranked lines, full tables, console; full ordering."""

import fixtures as fx
from quillrank import pagerank, rank_labels, top_k
from quillrank.operators.topk import bottom_k, sort_all
from quillrank.sinks import show, write_lines, write_table
from quillrank.sources import parse_pairs


def graph(lines):
    arcs = parse_pairs(lines(fx.ARC_LINES), ("src", "dst"))
    labels = parse_pairs(lines(fx.LABEL_LINES), ("id", "name"))
    return arcs, labels


def test_pagerank_lines_are_newline_separated(spark, lines, tmp_path):
    arcs, labels = graph(lines)
    ranked = top_k(rank_labels(pagerank(arcs, labels, iterations=10), labels), "rank", "name", "id", k=100)
    out = f"file://{tmp_path}/pagerank"
    write_lines(ranked, out, ["name", "rank"], single_file=True)
    got = [r.value.split("\t") for r in spark.read.text(out).collect()]
    assert [n for n, _ in got] == ["Gamma", "Delta", "Alpha", "Beta Two"]
    assert abs(float(got[0][1]) - fx.PAGERANK[("C", 10)]["Gamma"]) < 1e-9


def test_full_table_and_sort(spark, lines, tmp_path):
    arcs, labels = graph(lines)
    ranked = rank_labels(pagerank(arcs, labels, iterations=2), labels)
    out = f"file://{tmp_path}/ranks"
    write_table(ranked, out)
    assert spark.read.parquet(out).count() == 4
    asc = [r.name for r in sort_all(ranked, "rank", "name", "id", ascending=True).collect()]
    assert asc == ["Alpha", "Delta", "Beta Two", "Gamma"]
    assert [r.name for r in bottom_k(ranked, "rank", "name", "id", k=2).collect()] == asc[:2]


def test_show_prints(spark, lines, capsys):
    arcs, labels = graph(lines)
    show(rank_labels(pagerank(arcs, labels, iterations=1), labels), 10)
    assert "Gamma" in capsys.readouterr().out
