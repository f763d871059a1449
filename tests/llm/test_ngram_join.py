"""The n-gram join against all pairs in plain Python."""

import random

import pytest

import cases
from quillrank.llm.common import Scratch, components
from quillrank.llm.ngram_join import _keyed, keep_first, ngram_components


def grams(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    """Position of each row's component: that of its smallest member."""
    sets = [grams(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def altered(text, n, r):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = "zz" + str(r.randrange(10**6))
    return " ".join(w)


def planted(seed):
    r, rows = random.Random(seed), []
    line = cases.prose(999, 30)
    for b in range(6):
        base = cases.prose(100 * seed + b, r.choice((6, 40, 120)))
        rows += [base] * r.choice((1, 3)) + [altered(base, r.choice((1, 1, 2, 4)), r) for _ in range(12)]
        rows += [cases.prose(5000 * seed + 50 * b + i, 40) + " " + line for i in range(5)]
    rows += ["one", "one", "One", "two words", "two words", "", None]
    r.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,k,num,den", [(1, 4, 85, 100), (2, 5, 8, 10), (3, 1, 6, 10)])
def test_components_match_brute_force(spark, seed, k, num, den):
    rows = planted(seed)
    root, sizes = brute(rows, k, num, den)
    first = {}
    for (i, _), c in zip(rows, root):
        first[c] = min(i, first.get(c, i))
    want = {i: (n, first[c]) for (i, _), n, c in zip(rows, sizes, root)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(cases.plain(spark, rows), k, num, den).collect()}
    assert got == want
    assert any(a != c for a, (_, c) in got.items())
    kept = sorted(r.doc_id for r in keep_first(cases.plain(spark, rows), k, num, den).collect())
    assert kept == sorted(i for i, (n, c) in want.items() if c == i)


def test_one_large_group_is_not_expanded(spark):
    """A third of all rows are near copies of one text, each altered in its own place."""
    r = random.Random(5)
    base = cases.prose(1, 300)
    rows = [(i, altered(base, 1, r)) for i in range(60)] + [(60, base)] + [(100 + i, cases.prose(10 + i, 80)) for i in range(120)]
    got = {x.doc_id: x.component_id for x in ngram_components(cases.plain(spark, rows)).collect()}
    assert {got[i] for i in range(61)} == {0} and all(got[i] == i for i in range(100, 220))


def test_odd_rows(spark):
    got = [(r.doc_id, r.n_shingles > 0, r.component_id, r.class_size) for r in ngram_components(cases.odd(spark)).collect()]
    assert len(got) == len(cases.ODD)
    by = sorted(got, key=str)
    assert (1, False, 1, 1) in by and (2, False, 2, 1) in by and (3, False, 3, 1) in by and (None, False, None, 1) in by
    assert by.count((5, True, 5, 3)) == 2 and (6, True, 5, 3) in by
    assert (5, True, 5, 1) in by  # the other text of the same id is a document of its own
    kept = keep_first(cases.odd(spark))
    assert kept.columns == cases.odd(spark).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "5", "7", "None", "9", "10", "None"])
    assert ngram_components(cases.none(spark)).count() == 0 and keep_first(cases.none(spark)).count() == 0


def test_rows_without_id_give_way(spark):
    rows = [(None, cases.prose(1, 50)), (4, cases.prose(1, 50)), (None, cases.prose(2, 50)), (None, cases.prose(2, 50))]
    kept = keep_first(cases.plain(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("4", rows[0][1]), ("None", rows[2][1])])


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200), (500, 500)]
    got = {r.node: r.root for r in components(Scratch(spark, "t"), spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_near_copies_without_ids_and_two_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(None, c + " one"), (None, c + " two"), (5, a), (5, b), (6, a + " end"), (7, b + " end")]
    got = {r.text: r for r in ngram_components(cases.plain(spark, rows)).join(texts_by_key(spark, rows), "key").collect()}
    assert got[a].n_shingles == got[b].n_shingles
    assert got[c + " one"].first_key == got[c + " two"].first_key and got[c + " one"].component_id is None
    assert got[a].first_key == got[a + " end"].first_key == got[a].key and got[b].first_key == got[b + " end"].first_key == got[b].key
    kept = sorted((str(r.doc_id), r.text) for r in keep_first(cases.plain(spark, rows)).collect())
    assert len(kept) == 3 and kept[:2] == [("5", a), ("5", b)] and kept[2][1] in (c + " one", c + " two")


def texts_by_key(spark, rows, k=4):
    keyed = cases.plain(spark, rows).mapInArrow(_keyed(k), "doc_id long, text string, __key binary")
    return keyed.selectExpr("__key AS key", "text").distinct()
