"""Java's string order, full orders, row numbers and ordered output."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quillrank import bottom_k, top_k
from quillrank.operators.topk import numbered, sort_all
from quillrank.sinks import write_sorted_lines

NAMES = ["", "a", "aa", "b", "Z", "é", "퟿", "", "Ａ", "Ａa", "\U00010000", "\U0001f600", "\U0001f600a", "\U0010ffff", "aＡ", "a\U0001f600"]


def units(s):
    return s.encode("utf-16-be")


@pytest.mark.parametrize("pick,reverse", [(top_k, True), (bottom_k, False)])
def test_ties_in_the_order_of_utf16_code_units(spark, pick, reverse):
    rows = [(i, n, 1.0) for i, n in enumerate(NAMES)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, name string, rank double")
    got = [r.name for r in pick(df, "rank", "name", "id", k=len(rows), order="utf16").collect()]
    assert got == sorted(NAMES, key=units, reverse=reverse)
    assert got.index("\U0001f600") < got.index("Ａ") or reverse
    by_point = [r.name for r in pick(df, "rank", "name", "id", k=len(rows)).collect()]
    assert by_point == sorted(NAMES, reverse=reverse) and by_point != got
    with pytest.raises(ValueError):
        pick(df, "rank", "name", order="utf32")


def test_the_oracles_key_is_the_same_order():
    import duckdb

    from quillrank.plans.oracle import utf16

    con = duckdb.connect()
    con.execute("CREATE TABLE n AS SELECT unnest(?::VARCHAR[]) AS name", [NAMES])
    assert [r[0] for r in con.execute(f"SELECT name FROM n ORDER BY {utf16('name')}").fetchall()] == sorted(NAMES, key=units)


def skewed(spark, n=20_000):
    """Half of the rows have one value, and a tenth one value and one name."""
    rank = F.when(F.col("id") % 2 == 0, F.lit(0.15)).otherwise(F.round(F.rand(5), 2))
    name = F.when(F.col("id") % 10 == 0, F.lit("same")).otherwise(F.concat(F.lit("n"), (F.col("id") % 997).cast("string")))
    return spark.range(n).select("id", name.alias("name"), rank.alias("rank")).repartition(7)


def test_row_numbers_are_those_of_the_whole_order(spark):
    df = skewed(spark).persist()
    want = sorted(((r.rank, r.name, r.id) for r in df.collect()), reverse=True)
    got = sorted((r.row, (r.rank, r.name, r.id)) for r in numbered(df, "rank", "name", "id").collect())
    assert [n for n, _ in got] == list(range(1, len(want) + 1)) and [r for _, r in got] == want
    low = sorted((r.place, (r.rank, r.name, r.id)) for r in numbered(df, "rank", "name", "id", ascending=True, column="place").collect())
    assert [r for _, r in low] == want[::-1]
    assert numbered(df.limit(0), "rank", "name").count() == 0
    df.unpersist()


def test_parts_by_name_are_the_total_order(spark, tmp_path):
    """Skewed values and many ties: the lines of the parts, file after file, are in order, and no file holds most of them."""
    df = skewed(spark).persist()
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted_lines(df, f"file://{tmp_path}/out", ["id", "name", "rank"], "rank", "name", "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = []
    for f in sorted(x for x in os.listdir(tmp_path / "out") if x.startswith("part-")):
        files.append([line.split("\t") for line in (tmp_path / "out" / f).read_text().splitlines()])
    rows = [(float(r), n, int(i)) for f in files for i, n, r in f]
    assert rows == sorted(rows, reverse=True) and len(rows) == 20_000
    assert len(files) > 4 and max(map(len, files)) < 2 * sum(map(len, files)) / len(files)
    df.unpersist()


def test_sort_all_by_code_units(spark):
    df = spark.createDataFrame([(n, 1.0) for n in NAMES], "name string, w double")
    assert [r.name for r in sort_all(df, "w", "name", order="utf16").collect()] == sorted(NAMES, key=units, reverse=True)
