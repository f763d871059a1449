import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import none, odd, prose

from quillrank.llm import divergence as dv

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def share(c, n, v):
    return 1 + 10**9 * (c + 2) // (n + 2 * v)


def gap(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, least, k):
    """rows: (text, lang, source)."""
    rows = [(terms(t), lang or "", source or "") for t, lang, source in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        df = Counter(x for t, g, _ in rows if g == lang for x in set(t))
        kept = {t for t, n in df.items() if n >= least}
        counts, whole = defaultdict(Counter), Counter()
        for t, g, s in rows:
            if g == lang:
                counts[s].update(x for x in t if x in kept)
                whole.update(x for x in t if x in kept)
        v = len(kept)
        p = {s: {t: share(c[t], sum(c.values()), v) for t in kept} for s, c in ((s, counts[s]) for s in {r[2] for r in rows if r[1] == lang})}
        q = {t: share(whole[t], sum(whole.values()), v) for t in kept}
        for s in p:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            lead = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -n, r) for r, (n, _, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", o, -n, r) for r, (n, _, o) in enumerate(sorted(lead)[:k], 1)}
    return out


def got(spark, rows, least=2, k=3, **kw):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    out = dv.source_divergence(docs, least, k).collect()
    assert len(out) == len({(r.lang, r.source, r.part, r.item) for r in out})
    return {tuple(r) for r in out}


def corpus(seed, n, sources):
    r = random.Random(seed)
    vocab = [w.lower().strip(".") for w in prose(seed, 60).split()] + ["Éa", "éa", "日本", "😀x", "a", "b"]
    rows = []
    for _ in range(n):
        s = r.choice(sources)
        text = " ".join(r.choices(vocab, weights=[1 + (hash((s, i)) % 7) for i in range(len(vocab))], k=r.randint(0, 25)))
        rows.append((r.choice((text, text.upper() if text.isascii() else text, text.replace(" ", "_-1"))), r.choice(("en", "de", None)), s))
    return rows


@pytest.mark.parametrize("seed,n,sources", [(1, 60, ["s1", "s2", "s3"]), (2, 25, ["a", None, "ä", "z", "Z"]), (3, 6, ["only"])])
def test_equals_brute_force(spark, seed, n, sources):
    rows = corpus(seed, n, sources) + [(None, "fr", "x"), ("", "fr", "y"), ("1 2 3", "fr", "z"), ("lonely", "it", "x")]
    assert got(spark, rows) == brute(rows, 2, 3)


def test_ties_go_to_the_earlier_bytes(spark):
    rows = [("ab ﬀ 😀 zz", "en", "s")] * 3 + [("q", "en", "t")] * 3
    want = brute(rows, 2, 10)
    assert got(spark, rows, 2, 10) == want
    assert [o for _, s, part, o, _, r in sorted(want, key=lambda x: x[5]) if part == "term" and s == "s"] == ["ab", "zz", "ﬀ", "😀"]


def test_small_blocks_and_buckets_give_the_same(spark):
    rows = corpus(4, 80, [f"s{i}" for i in range(9)])
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = dv.kept_counts(docs, 2).persist()
    known = dv.groups(kept).persist()
    whole = {tuple(r) for r in dv.pair_gaps(kept, known).collect()}
    assert whole == {tuple(r) for r in dv.pair_gaps(kept, known, block=2, bucket=5).collect()}
    assert {(a, b, "pair", c, d) for a, b, c, d in whole} == {x[:5] for x in brute(rows, 2, 3) if x[2] == "pair"}
    kept.unpersist(), known.unpersist()


def test_skyband_equals_all_comparisons():
    r = np.random.default_rng(3)
    for n, spread in ((0, 1), (1, 5), (700, 4), (900, 60), (600, 10**6)):
        c, lc, term = r.integers(0, spread, n), r.integers(0, spread, n), r.permutation(n)
        beats = (c[None, :] >= c[:, None]) & (lc[None, :] <= lc[:, None]) & (term[None, :] < term[:, None])
        for k in (1, 10):
            assert sorted(dv.skyband(c, lc, term, k).tolist()) == np.flatnonzero(beats.sum(axis=1) < k).tolist()


def test_partitions_hand_on_all_leading_terms():
    r = random.Random(6)
    rows = [("l", s, f"t{i:04d}", r.randint(1, 50), r.randint(50, 90)) for s in ("a", "b") for i in range(800)]
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("c", pa.int64()), ("lc", pa.int64())])
    cut = [pa.RecordBatch.from_pylist([dict(zip(kind.names, x)) for x in rows[i : i + 97]], kind) for i in range(0, len(rows), 97)]
    for held in (1 << 18, 100):
        out = pa.Table.from_batches(dv._local(10, held)(iter(cut)), kind)
        for s in ("a", "b"):
            def first(t):
                return sorted((gap(share(x["c"], 9000, 800), share(x["lc"], 60000, 800)) * -1, x["term"]) for x in t if x["source"] == s and share(x["c"], 9000, 800) > share(x["lc"], 60000, 800))[:10]
            assert first(out.to_pylist()) == first([dict(zip(kind.names, x)) for x in rows])


def test_shares_are_exact_at_any_size(spark):
    r = random.Random(8)
    cases = [(c, n, v) for n in (1, 10**9, 10**15) for c in (0, 1, n // 3, n) for v in (1, 7, 10**8)]
    rows = spark.createDataFrame(cases, "c long, n long, v long")
    from pyspark.sql import functions as F
    assert [x[0] for x in rows.select(dv.share(F.col("c"), F.col("n"), F.col("v"))).collect()] == [share(*x) for x in cases]
    c, n, v = (np.array(x, dtype=np.int64) for x in zip(*cases))
    assert dv._share(c, n + 2 * v).tolist() == [share(*x) for x in cases]
    big = [(r.randint(0, 10**16), 10**16, 10**9) for _ in range(20)]
    assert [x[0] for x in spark.createDataFrame(big, "c long, n long, v long").select(dv.share(F.col("c"), F.col("n"), F.col("v"))).collect()] == [share(*x) for x in big]


def test_flushing_often_changes_nothing(spark):
    rows = corpus(9, 40, ["p", "q"])
    table = pa.RecordBatch.from_pylist([{"lang": b or "", "source": c or "", "text": a or ""} for a, b, c in rows])
    def summed(batches):
        out = Counter()
        for b in batches:
            for x in b.to_pylist():
                out[x["lang"], x["source"], x["term"]] += x["c"] * 1000 + x["d"]
        return out
    whole = summed(dv._count(iter([table])))
    before, dv.GATHERED = dv.GATHERED, 1
    try:
        assert summed(dv._count(table.slice(i, 3) for i in range(0, len(rows), 3))) == whole
    finally:
        dv.GATHERED = before


def test_odd_inputs(spark):
    docs = odd(spark).selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN 's' WHEN doc_id IS NOT NULL THEN 't' END AS source")
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert {tuple(r) for r in dv.source_divergence(docs, 1, 5).collect()} == brute(rows, 1, 5)
    assert dv.source_divergence(docs.drop("source").selectExpr("*", "'s' AS source")).where("part = 'term'").count() == 0  # one group: as its language
    long = spark.createDataFrame([("x" * 400_000 + " y", "en", "s"), ("y", "en", "t")], "text string, lang string, source string")
    assert {(r.source, r.item) for r in dv.source_divergence(long, 1, 5).where("part = 'term'").collect()} == {("s", "x" * 400_000), ("t", "y")}
    assert dv.source_divergence(none(spark).selectExpr("*", "'s' AS source")).count() == 0
