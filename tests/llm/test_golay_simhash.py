import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import none, odd, plain, prose
from pyspark.sql import functions as F

from quillrank.llm import golay_simhash as gs
from quillrank.llm.common import Scratch


def brute_fp(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        t = t.replace(s, " ")
    w = [x for x in t.split(" ") if x]
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def brute_roots(values):
    """value -> smallest value of its component, by all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 4:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {v: find(v) for v in root}


def partition(pairs):
    groups = {}
    for v, r in pairs:
        groups.setdefault(r, set()).add(v)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


TEXTS = ["", " \n", "one", "Two WORDS", "a b c d", "a b c d e", "A  B\tc\x0bd e", "é É İ Σ x y z", prose(1, 50), prose(2, 400), "x" * 200_000, "a b " * 40_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_brute_force(text):
    assert gs.fingerprint(text.encode()) == brute_fp(text)


def test_hash_is_sparks_own(spark):
    words = ["alpha beta gamma delta", "one", prose(3, 40)]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] % 2**64 for r in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_decoding_is_within_three_bits_of_a_codeword():
    r = np.random.default_rng(1)
    v = r.integers(0, 1 << 23, 5000)
    syndrome, error = gs._syndromes()
    word = v ^ error[syndrome[v]]
    assert (syndrome[word] == 0).all() and (np.bitwise_count(v ^ word) <= 3).all()
    assert set(np.bitwise_count(np.flatnonzero(syndrome == 0)).tolist()) == {0, 7, 8, 11, 12, 15, 16, 23}


def test_every_error_of_four_bits_leaves_a_shared_key():
    r = random.Random(2)
    for fp in (0, 2**64 - 1, r.getrandbits(64)):
        many = [fp] + [fp ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 4))) for _ in range(1500)]
        row, key = gs.golay_keys(np.array(many, dtype=np.uint64))
        assert np.bincount(row).max() <= 252
        own = key[row == 0]
        assert set(row[np.isin(key, own)].tolist()) == set(range(len(many)))


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 1000])
def test_shared_rows_whatever_the_batches(batch):
    r = random.Random(batch)
    rows = sorted({(r.randint(0, 40), r.randint(0, 99)) for _ in range(90)})
    batches = [pa.RecordBatch.from_pydict({"key": [k for k, _ in rows[i : i + batch]], "fp": [f for _, f in rows[i : i + batch]]}) for i in range(0, len(rows), batch)]
    got = sorted(tuple(x.values()) for b in gs._shared(batches) for x in b.to_pylist())
    by = {}
    for k, f in rows:
        by.setdefault(k, []).append(f)
    assert got == sorted((k, f, v[0]) for k, v in by.items() if len(v) > 1 for f in v)


def clusters(seed):
    """Chains, balls and single fingerprints."""
    r = random.Random(seed)
    out = []
    for _ in range(12):
        v = r.getrandbits(64)
        out.append(v)
        for _ in range(r.choice((0, 3, 40))):
            v = (out[-1] if r.random() < 0.5 else v) ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 6)))
            out.append(v)
    return [*out, 0, 0b1111, 0b111110000]


@pytest.mark.parametrize("per_node", [gs.PAIRS_PER_NODE, 0])
def test_components_equal_all_pairs(spark, per_node):
    values = sorted(set(clusters(5)))
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    roots = gs.linked_components(nodes, Scratch(spark, "test-golay"), per_node).collect()
    assert partition((r.node % 2**64, r.root) for r in roots) == partition(brute_roots(values).items())


def test_documents_equal_brute_force(spark):
    r = random.Random(4)
    base = [prose(100 + i, 60 + 40 * i) for i in range(8)]
    rows = []
    for i, t in enumerate(base):
        for j in range(6):
            w = t.split()
            for _ in range(j // 2):
                w[r.randrange(len(w))] = "changed"
            rows.append((10 * i + j, " ".join(w).upper() if j == 1 else " ".join(w)))
    rows += [(900, None), (901, ""), (902, "x"), (902, "x"), (903, "X")]
    got = gs.simhash_components(plain(spark, rows)).collect()
    fps = {(i, t): brute_fp(t) for i, t in rows}
    roots = brute_roots(set(fps.values()))
    least = {}
    for (i, _), v in fps.items():
        least[roots[v]] = min(i, least.get(roots[v], i))
    want = sorted((i, f"{fps[i, t]:016x}", least[roots[fps[i, t]]]) for i, t in rows)
    assert sorted((g.doc_id, g.fingerprint, g.component_id) for g in got) == want
    assert any(c != i for i, _, c in want if i < 900 and i % 10)


def test_odd_inputs(spark):
    out = gs.simhash_components(odd(spark)).collect()
    assert len(out) == 13
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.fingerprint for r in by[1]] == ["0" * 16] and by[1][0].component_id == 1 and by[2][0].component_id == 1
    assert by[6][0].component_id == 5  # an exact copy of 5
    assert sorted((r.fingerprint == "0" * 16, r.component_id) for r in by[None]) == [(False, None), (True, 1)]
    assert gs.simhash_components(none(spark)).count() == 0
