
import pytest
from pyspark.sql import functions as F

import fixtures as fx
from quillrank import PageRank, adjacency, distinct_arcs, out_degree, pagerank, rank_labels
from quillrank.operators.graph import dangling_nodes, label_count
from quillrank.sources import arcs_from_lineitem, labels_from_part, parse_pairs
from quillrank.sources.tables import table

VARIANTS = {
    "A": ("ws", dict(dangling=True, normalizer="distinct_contribs")),
    "B": ("tab", dict(dangling=True, normalizer="distinct_labels")),
    "C": ("tab", dict(dangling=False)),
}


def tiny(lines, delim):
    arcs = parse_pairs(lines(fx.ARC_LINES), ("src", "dst"), delim)
    labels = parse_pairs(lines(fx.LABEL_LINES), ("id", "name"), delim)
    return arcs, labels


def named(ranks, labels):
    return {r.name: round(r.rank, 9) for r in rank_labels(ranks, labels).collect()}


@pytest.mark.parametrize("variant", ["A", "B", "C"])
@pytest.mark.parametrize("iterations", [1, 2, 10])
def test_goldens(spark, lines, variant, iterations):
    delim, kw = VARIANTS[variant]
    arcs, labels = tiny(lines, delim)
    assert named(pagerank(arcs, labels, iterations=iterations, **kw), labels) == fx.PAGERANK[(variant, iterations)]


@pytest.mark.parametrize("every", [1, 2, 4])
def test_write_interval_does_not_change_ranks(spark, lines, every):
    arcs, labels = tiny(lines, "tab")
    got = named(PageRank(arcs, labels).run(10, write_every=every), labels)
    assert got == fx.PAGERANK[("C", 10)]


def test_graph_layer(spark, lines):
    arcs, labels = tiny(lines, "tab")
    d = distinct_arcs(arcs)
    assert d.count() == 7
    assert {r.src: r.deg for r in out_degree(d).collect()} == {"1": 2, "2": 1, "3": 3, "5": 1}
    assert sorted(r.id for r in dangling_nodes(labels, out_degree(d)).collect()) == ["4", "7"]
    assert label_count(labels).first()["n"] == 6
    # chunks are the targets' own, so every source has the same grain
    for digits in (1, 2):
        got = {}
        for r in adjacency(arcs, chunk_digits=digits).collect():
            assert len(r.chunk) == digits
            got.setdefault(r.src, []).extend(r.dsts.split(","))
        assert {k: sorted(v) for k, v in got.items()} == {"1": ["2", "3"], "2": ["3"], "3": ["1", "4", "6"], "5": ["1"]}


def test_adjacency_grain_at_a_large_hub(spark):
    """150,000 arcs of one source: the rows are those that the oracle's statement gives."""
    import duckdb

    arcs = spark.range(150_000).select(F.lit(7).cast("long").alias("src"), F.col("id").alias("dst"))
    got = {(r.src, r.chunk): r.dsts for r in adjacency(arcs).collect()}
    con = duckdb.connect()
    want = con.execute("SELECT 7, substr(md5(CAST(range AS VARCHAR)), 1, 2) c, string_agg(CAST(range AS VARCHAR), ',' ORDER BY range) FROM range(150000) GROUP BY c").fetchall()
    assert got == {(a, c): d for a, c, d in want} and len(got) == 256


def test_empty_graph(spark, lines):
    arcs = parse_pairs(lines([]), ("src", "dst"))
    labels = parse_pairs(lines(fx.LABEL_LINES), ("id", "name"))
    for _, kw in VARIANTS.values():
        assert pagerank(arcs, labels, iterations=3, **kw).count() == 0


def test_row_order_and_duplicates_do_not_matter(spark, lines):
    arcs, labels = tiny(lines, "tab")
    shuffled = arcs.unionByName(arcs).orderBy(F.rand(7))
    a = named(pagerank(arcs, labels, iterations=4, dangling=True), labels)
    b = named(pagerank(shuffled, labels, iterations=4, dangling=True), labels)
    assert a == b


@pytest.mark.parametrize("variant", ["A", "B", "C"])
def test_hub_salting_gives_the_same_ranks(spark, lines, variant):
    """hub_degree=1 splits every source over several buckets (the skew path)."""
    delim, kw = VARIANTS[variant]
    arcs, labels = tiny(lines, delim)
    plain = named(pagerank(arcs, labels, iterations=10, **kw), labels)
    salted = named(pagerank(arcs, labels, iterations=10, hub_degree=1, partitions=4, **kw), labels)
    assert salted == plain == fx.PAGERANK[(variant, 10)]


def test_hub_salting_on_table_graph(spark):
    d = "/root/testdata/sf0.001"
    arcs = arcs_from_lineitem(table(spark, d, "lineitem"))
    labels = labels_from_part(table(spark, d, "part"))
    pr = PageRank(arcs, labels, dangling=True, hub_degree=1, partitions=8)
    assert pr.links().where("salt > 0").count() > 0
    salted = {r.id: round(r.rank, 9) for r in pr.run(5).collect()}
    plain = {r.id: round(r.rank, 9) for r in pagerank(arcs, labels, iterations=5, dangling=True).collect()}
    assert salted == plain and len(plain) > 0


def test_no_dangling_nodes_makes_variants_equal(spark):
    """Every part has in- and out-links without the flag filters."""
    d = "/root/testdata/sf0.001"
    li = table(spark, d, "lineitem")
    a = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"))
    b = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    arcs = a.join(b, ["l_orderkey", "l_linenumber"]).where("src <> dst").select("src", "dst")
    ids = arcs.select(F.col("src").alias("id")).union(arcs.select("dst")).distinct()
    labels = ids.select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    res = [
        {r.id: round(r.rank, 9) for r in pagerank(arcs, labels, iterations=3, **kw).collect()}
        for _, kw in VARIANTS.values()
    ]
    assert res[0] == res[1] == res[2] and len(res[0]) > 0


def test_relabelling_ids_keeps_the_rank_multiset(spark, lines):
    arcs, labels = tiny(lines, "tab")
    moved = arcs.select(F.concat(F.lit("x"), "src").alias("src"), F.concat(F.lit("x"), "dst").alias("dst"))
    a = sorted(round(r.rank, 9) for r in pagerank(arcs, iterations=5).collect())
    b = sorted(round(r.rank, 9) for r in pagerank(moved, iterations=5).collect())
    assert a == b


def test_sf01_reference_numbers(spark):
    """FIXTURES.md: sf0.01, 10 rounds: 172 ranked ids and the published sums."""
    d = "/root/testdata/sf0.01"
    arcs = arcs_from_lineitem(table(spark, d, "lineitem"))
    expected = {"A": 176.96476486, "B": 65.31887375, "C": 57.03438571}
    for variant, (delim, kw) in VARIANTS.items():
        labels = labels_from_part(table(spark, d, "part"), delim)
        r = pagerank(arcs, labels, iterations=10, **kw)
        agg = r.agg(F.count("*").alias("n"), F.sum("rank").alias("s")).first()
        assert agg.n == 172
        assert abs(agg.s - expected[variant]) < 1e-6


def test_intermediate_writes_go_under_the_checkpoint_dir(spark, lines):
    from quillrank.session import ensure_checkpoint_dir

    arcs, labels = tiny(lines, "tab")
    pr = PageRank(arcs, labels, dangling=True)
    ranks = pr.run(2)
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    assert all(root in f.replace("file:", "") for f in ranks.inputFiles())
    assert all(root in f.replace("file:", "") for f in pr.links().inputFiles())
    pr.close()


def test_zero_normalizer_gives_no_share(spark, lines):
    """Q20: with no label rows variant B divides by zero; the share is 0, so
    the ranks equal variant C's."""
    arcs, _ = tiny(lines, "tab")
    empty = parse_pairs(lines([]), ("id", "name"))
    b = {r.id: round(r.rank, 9) for r in pagerank(arcs, empty, iterations=3, dangling=True).collect()}
    c = {r.id: round(r.rank, 9) for r in pagerank(arcs, empty, iterations=3).collect()}
    assert b == c and len(b) > 0


def test_duplicate_labels_multiply_rows(spark, lines):
    """Q17: the label join is inner; an id with two label rows appears twice,
    an unlabelled id not at all."""
    arcs, _ = tiny(lines, "tab")
    labels = parse_pairs(lines(["3\tGamma", "3\tGamma again", "1\tAlpha"]), ("id", "name"))
    got = sorted((r.id, r.name) for r in rank_labels(pagerank(arcs, labels, iterations=2), labels).collect())
    assert got == [("1", "Alpha"), ("3", "Gamma"), ("3", "Gamma again")]


def test_no_catalog_entry_is_left(spark, lines):
    arcs, labels = tiny(lines, "tab")
    before = {t.name for t in spark.catalog.listTables()}
    pr = PageRank(arcs, labels, dangling=True)
    pr.links()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert named(pr.run(2), labels) == fx.PAGERANK[("B", 2)]


def test_one_hub_holding_a_third_of_the_arcs(spark):
    """A source with a third of all arcs is split over salt buckets (only it:
    hub_degree sits above every other out-degree); ranks equal the model's."""
    import brute

    d = "/root/testdata/sf0.001"
    base = arcs_from_lineitem(table(spark, d, "lineitem"))
    targets = base.select("dst").distinct()
    hub = targets.select(F.lit(-1).cast("long").alias("src"), "dst")
    arcs = base.unionByName(hub)
    labels = labels_from_part(table(spark, d, "part"))
    n_arcs, n_hub = arcs.count(), hub.count()
    assert 3 * n_hub >= n_arcs - n_hub  # the hub holds about a third or more
    pr = PageRank(arcs, labels, dangling=True, hub_degree=10, partitions=8)
    assert pr.links().where("src = -1").select("salt").distinct().count() > 1
    assert pr.links().where("src <> -1 AND salt > 0").count() == 0
    got = {r.id: r.rank for r in pr.run(4).collect()}
    model = brute.pagerank([tuple(r) for r in arcs.collect()], [tuple(r) for r in labels.collect()], 4, "B")
    assert got.keys() == model.keys()
    assert all(abs(got[k] - model[k]) < 1e-9 for k in got)


def test_close_contributions_of_large_degrees_stay_apart(spark):
    """1/2000000 and 1/2000001 differ; the rounding is relative, also in the oracle."""
    import duckdb

    from quillrank.operators.pagerank import significant
    from quillrank.plans.oracle import significant as sql

    values = [1 / 2_000_000, 1 / 2_000_001, 1 / 2_000_000 * (1 + 1e-15), 0.001, 0.1 + 0.2, 0.3, 1e-300, 12.5]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    got = df.agg(F.count_distinct(significant(F.col("c")))).first()[0]
    rows = ", ".join(f"({v!r}::DOUBLE)" for v in values)
    want = duckdb.connect().execute(f"SELECT count(DISTINCT {sql('c')}) FROM (VALUES {rows}) t(c)").fetchone()[0]
    assert got == want == 6
    # in the normalizer: two sources of those degrees that share a target, as analytic link rows
    pr = PageRank(spark.createDataFrame([(1, 2)], "src long, dst long"), spark.createDataFrame([], "id long, name string"), dangling=True, normalizer="distinct_contribs")
    links = spark.createDataFrame([(1, 0, 9, 0, 2_000_000, 1, 1, 0), (2, 0, 9, 0, 2_000_001, 1, 1, 0)], "src long, salt int, dst long, dst_salt int, deg long, nsalt int, dst_nsalt int, dst_dmult long")
    pr._links = links
    ranks = spark.createDataFrame([(1, 0, 1.0, 1, 0), (2, 0, 1.0, 1, 0)], "id long, salt int, rank double, nsalt int, dmult long")
    assert pr.intermediate(ranks).first()["ndist"] == 2


def test_label_ids_of_another_type_just_do_not_match(spark):
    arcs = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src long, dst long")
    labels = spark.createDataFrame([("1", "one"), ("x", "odd"), ("3", "three")], "id string, name string")
    ranks = pagerank(arcs, labels, iterations=2, dangling=True)
    got = {(r.id, r.name) for r in rank_labels(ranks, labels).collect()}
    assert got == {(1, "one"), (3, "three")}
    # x has no out-link and still counts as a label row of the normalizer
    assert PageRank(arcs, labels, dangling=True).label_rows() == 3


def test_only_what_the_result_reads_is_left(spark, lines, tmp_path):
    import os

    arcs, labels = tiny(lines, "tab")
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(f"file://{tmp_path}/ck")
    try:
        root = sc.getCheckpointDir().replace("file:", "")
        ranks = pagerank(arcs, labels, iterations=4, dangling=True)
        left = {os.path.dirname(f).replace("file://", "").replace("file:", "") for f in ranks.inputFiles()}
        dirs = {d for d, _, files in os.walk(root) if any(f.startswith("part-") for f in files)}
        assert dirs == left and len(left) == 1
        pr = PageRank(arcs, labels, dangling=True)
        pr.links()
        pr.close()
        assert {d for d, _, files in os.walk(root) if any(f.startswith("part-") for f in files)} == left
        assert pagerank(arcs, labels, iterations=0).count() == 4
    finally:
        sc.setCheckpointDir(before.rsplit("/", 1)[0])


def test_link_build_reads_the_arcs_once(spark, tmp_path):
    from quillrank.plans.inspect import plan_text
    from quillrank.sources import read_arcs

    (tmp_path / "arcs").write_text("\n".join(fx.ARC_LINES) + "\n")
    d = "/root/testdata/sf0.001"
    by_text = read_arcs(spark, f"file://{tmp_path}/arcs"), parse_pairs(spark.createDataFrame([(v,) for v in fx.LABEL_LINES], "value string"), ("id", "name"))
    by_table = arcs_from_lineitem(table(spark, d, "lineitem")), labels_from_part(table(spark, d, "part"))
    for (arcs, labels), scans in ((by_text, {"FileScan text": 1}), (by_table, {"lineitem.parquet": 2, "part.parquet": 1})):
        links = PageRank(arcs, labels, dangling=True).unwritten_links()
        links.collect()
        final = plan_text(links, "simple").split("+- == Initial Plan ==")[0]
        assert {k: final.count(k) for k in scans} == scans and "ReusedExchange" in final


class Lost(Exception):
    pass


def _graph(spark):
    d = "/root/testdata/sf0.001"
    return arcs_from_lineitem(table(spark, d, "lineitem")), labels_from_part(table(spark, d, "part"))


@pytest.mark.parametrize("variant", ["A", "B", "C"])
def test_a_lost_run_goes_on_after_its_last_round(spark, tmp_path, monkeypatch, variant):
    """The loop is killed after round 4; the rest gives the whole run's ranks, and rounds 1-4 do not run again."""
    arcs, labels = _graph(spark)
    _, kw = VARIANTS[variant]
    whole = {r.id: r.rank for r in pagerank(arcs, labels, iterations=10, **kw).collect()}
    state, rounds, builds = f"file://{tmp_path}/state", [], []
    step, build = PageRank.intermediate, PageRank._build

    def counted(self, ranks):
        if len(rounds) == 4:
            raise Lost
        rounds.append(1)
        return step(self, ranks)

    monkeypatch.setattr(PageRank, "intermediate", counted)
    monkeypatch.setattr(PageRank, "_build", lambda self, path: builds.append(1) or build(self, path))
    with pytest.raises(Lost):
        PageRank(arcs, labels, **kw).run(10, write_every=1, state=state)
    rounds.clear()
    monkeypatch.setattr(PageRank, "intermediate", lambda self, ranks: rounds.append(1) or step(self, ranks))
    got = {r.id: r.rank for r in PageRank(arcs, labels, **kw).run(10, write_every=1, state=state).collect()}
    assert len(rounds) == 6 and len(builds) == 1
    assert got.keys() == whole.keys() and all(abs(got[k] - whole[k]) < 1e-12 for k in got)
    # once more, and for two more rounds
    rounds.clear()
    assert {r.id: r.rank for r in PageRank(arcs, labels, **kw).run(10, state=state).collect()} == got and not rounds
    more = {r.id: r.rank for r in pagerank(arcs, labels, iterations=12, state=state, **kw).collect()}
    straight = {r.id: r.rank for r in pagerank(arcs, labels, iterations=12, **kw).collect()}
    assert len(builds) == 2 and all(abs(more[k] - straight[k]) < 1e-12 for k in straight)
    with pytest.raises(ValueError, match="has passed round 3"):
        PageRank(arcs, labels, **kw).run(3, state=state)


def test_a_run_lost_while_writing_leaves_whole_rounds(spark, tmp_path, monkeypatch):
    """What an unfinished build, round or manifest left behind is written anew."""
    import os

    from quillrank.operators import progress

    arcs, labels = _graph(spark)
    want = {r.id: r.rank for r in pagerank(arcs, labels, iterations=3, dangling=True).collect()}
    root = tmp_path / "state"
    for junk in ("links/part-x.parquet", "ranks/round-0001/part-y.parquet", "rounds/_round-000001.json.ab"):
        os.makedirs((root / junk).parent, exist_ok=True)
        (root / junk).write_text("torn")
    add, state = progress.Manifest.add, f"file://{root}"

    def torn(self, number, said):
        if number == 2:
            raise Lost
        add(self, number, said)

    monkeypatch.setattr(progress.Manifest, "add", torn)
    with pytest.raises(Lost):
        pagerank(arcs, labels, iterations=3, dangling=True, state=state)
    monkeypatch.setattr(progress.Manifest, "add", add)
    assert progress.Manifest(spark, state).last()["round"] == 1
    got = {r.id: r.rank for r in pagerank(arcs, labels, iterations=3, dangling=True, state=state).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    left = sorted(f for f in os.listdir(root / "rounds") if f.endswith(".json") and not f.startswith("_"))
    assert left == ["round-000003.json"] and os.listdir(root / "ranks") == ["round-0003"]


def test_a_state_of_other_input_or_settings_is_refused(spark, tmp_path):
    arcs, labels = _graph(spark)
    state = f"file://{tmp_path}/state"
    pagerank(arcs, labels, iterations=1, dangling=True, state=state)
    other = [(arcs.limit(5), labels, {}), (arcs.unionByName(arcs.limit(2)), labels, {}), (arcs, labels.limit(3), {}), (arcs, labels, dict(damping=0.5)), (arcs, labels, dict(partitions=3))]
    for a, lab, kw in other:
        with pytest.raises(ValueError, match="other input or settings"):
            pagerank(a, lab, iterations=2, dangling=True, state=state, **kw)
    # the same rows in another order are the same input
    assert pagerank(arcs.orderBy(F.rand(3)), labels, iterations=2, dangling=True, state=state).count() > 0


@pytest.mark.parametrize("variant", ["A", "B", "C"])
def test_resumed_hubs(spark, lines, tmp_path, variant):
    delim, kw = VARIANTS[variant]
    arcs, labels = tiny(lines, delim)
    kw = dict(kw, hub_degree=1, partitions=4, state=f"file://{tmp_path}/{variant}")
    pagerank(arcs, labels, iterations=2, **kw)
    assert named(pagerank(arcs, labels, iterations=10, **kw), labels) == fx.PAGERANK[(variant, 10)]


def test_adjacency_lists_of_a_source_with_a_million_arcs(spark):
    """Rows of at most n targets, at the same grain for every degree, from tasks that each hold a range."""
    from quillrank.operators.graph import adjacency_lists

    hub = spark.range(1_000_000).select(F.lit(7).cast("long").alias("src"), F.col("id").alias("dst"))
    others = spark.range(3000).select((F.col("id") % 40 + 100).alias("src"), (F.col("id") * 7 % 1013).alias("dst"))
    n = 1000
    out = adjacency_lists(hub.unionByName(others).unionByName(others), n)
    sizes = out.select("src", "part", F.size(F.split("dsts", ",")).alias("n"))
    per = {(r.src, r.part): r.n for r in sizes.collect()}
    assert {k: v for k, v in per.items() if k[0] == 7} == {(7, i): n for i in range(1000)}
    firsts = out.where("src = 7").select("part", F.split("dsts", ",")[0].cast("long").alias("a"), F.element_at(F.split("dsts", ","), -1).cast("long").alias("b")).collect()
    assert all((r.a, r.b) == (r.part * n, r.part * n + n - 1) for r in firsts)
    small = adjacency_lists(others, 8)
    degree = {r.src: r.deg for r in out_degree(distinct_arcs(others)).collect()}
    rows = [(r.src, r.part, [int(x) for x in r.dsts.split(",")]) for r in small.collect()]
    for src, deg in degree.items():
        mine = sorted((p, d) for s, p, d in rows if s == src)
        flat = [x for _, d in mine for x in d]
        assert flat == sorted(set(flat)) and len(flat) == deg
        assert [len(d) for _, d in mine] == [8] * (deg // 8) + ([deg % 8] if deg % 8 else [])
    assert adjacency_lists(others.limit(0), 8).count() == 0


def test_adjacency_lists_whatever_the_ranges(spark, lines):
    from quillrank.operators.graph import adjacency_lists

    arcs, _ = tiny(lines, "tab")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for coalesce in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            got = {(r.src, r.part, r.dsts) for r in adjacency_lists(arcs, 2).collect()}
            assert got == {("1", 0, "2,3"), ("2", 0, "3"), ("3", 0, "1,4"), ("3", 1, "6"), ("5", 0, "1")}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_split_targets_count_equal_contributions_once(spark):
    """Ten sources of each degree from 1 to 5 share a target: 5 distinct contributions, also
    where the target is split into parts; the mass counts a label id as often as it has labels."""
    arcs = [(s, 1000) for s in range(50)] + [(s, 2000 + 10 * s + k) for s in range(50) for k in range(s % 5)]
    arcs = spark.createDataFrame(arcs, "src long, dst long")
    labels = spark.createDataFrame([(1000, "a"), (1000, "a"), (1000, "b"), (2001, "c"), (0, "d"), (9999, "e")], "id long, name string")
    got = []
    for degree in (10**6, 3):
        pr = PageRank(arcs, labels, dangling=True, normalizer="distinct_contribs", hub_degree=degree, partitions=4)
        rows = {r["id"]: r for r in pr.intermediate(pr.initial()).collect()}
        pr.close()
        assert rows[1000]["ndist"] == 5 and rows[1000]["dmult"] == 3 and rows[2001]["dmult"] == 1
        assert sum(r["dmult"] for r in rows.values()) == 4
        got.append({i: (round(r["rank"], 12), r["ndist"]) for i, r in rows.items()})
    assert got[0] == got[1]


def test_arcs_of_all_lines_with_nulls_and_repeated_lines(spark):
    lines = [(1, 1, 10), (1, 1, 10), (1, 2, 20), (1, 2, 20), (1, 2, None), (1, 3, 20), (1, 4, 10), (2, None, 10), (2, 2, 30), (None, 1, 10), (None, 2, 20), (3, 1, 10), (3, 1, 11), (3, 2, 12)]
    df = spark.createDataFrame([(*x, "N", "O") for x in lines], "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string")
    got = sorted((r["src"], r["dst"]) for r in arcs_from_lineitem(df, returned_only=False).collect())
    assert got == [(10, 12), (10, 20), (11, 12), (20, 10)]


def test_buckets_are_as_many_as_the_links_need(spark):
    """A small graph at many partitions has few buckets, one file each; ranks are those of all buckets."""
    from quillrank.operators.pagerank import BUCKET_LINKS, bucket_count

    assert [bucket_count(n, 200) for n in (0, 1, 32 * BUCKET_LINKS, 33 * BUCKET_LINKS, 41 * BUCKET_LINKS, 10**12)] == [40, 40, 40, 40, 50, 200]
    assert [bucket_count(10**9, p) for p in (1, 8, 31, 33, 64)] == [1, 8, 31, 33, 64]
    assert bucket_count(5, 64) == 32 and bucket_count(5, 37) == 37
    arcs, labels = _graph(spark)
    for variant in "ABC":
        _, kw = VARIANTS[variant]
        pr = PageRank(arcs, labels, partitions=64, **kw)
        files = pr.links().inputFiles()
        assert len({f.split("_")[-1] for f in files}) == len(files) <= 32 == pr.buckets
        got, want = ({r.id: r.rank for r in x.collect()} for x in (pr.run(4), pagerank(arcs, labels, iterations=4, partitions=8, **kw)))
        pr.close()
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("variant", ["A", "B", "C"])
def test_contributions_move_once_unless_a_target_is_hot(spark, variant):
    """After the first round's count: one exchange a round, without hot targets; with them parts and partial sums as before. Ranks agree."""
    from quillrank.plans.inspect import plan_text

    arcs = [(s, 1000) for s in range(50)] + [(1000, s) for s in range(50)] + [(s, 2000 + 10 * s + k) for s in range(50) for k in range(s % 5)]
    arcs = spark.createDataFrame(arcs, "src long, dst long")
    labels = spark.createDataFrame([(1000, "a"), (2001, "b"), (2001, "c"), (9999, "d")], "id long, name string")
    _, kw = VARIANTS[variant]
    got = []
    for degree, hot in ((50, False), (49, True)):
        pr = PageRank(arcs, labels, hub_degree=degree, partitions=8, **kw)
        rows = pr.run(5).collect()
        assert pr._spread is hot and "indeg" not in pr.intermediate(pr.initial()).columns
        if not hot:
            df = pr.intermediate(pr.initial())
            df.collect()
            assert plan_text(df, "simple").split("+- == Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
        pr.close()
        got.append({r.id: r.rank for r in rows})
    assert got[0].keys() == got[1].keys() and all(abs(got[0][k] - got[1][k]) < 1e-12 for k in got[0])
