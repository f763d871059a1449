"""License matches against looking into every window, and the bands' guarantee."""

import re

import duckdb
import pytest

import cases
from quillrank.llm import licenses as l


@pytest.mark.parametrize("n", [5, 8, 11, 30, 60, 200])
def test_band_settings(n):
    j = l.least_jaccard(n)
    assert l.window_of(n) >= 2 * n and 0 < j < 1 and (1 - j) ** l.bands(n) <= l.MISS


def brute(rows, templates):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        for name, body in templates.items():
            b = re.findall(r"[^\W_]+", body.lower())
            own, size = {tuple(b[j : j + 5]) for j in range(len(b) - 4)}, l.window_of(len(b))
            met = []
            for s in range(0, len(w), size // 2):
                part = w[s : s + size]
                share = len(own & {tuple(part[j : j + 5]) for j in range(len(part) - 4)}) / len(own)
                if share >= l.CONTAINED:
                    met.append((s, share))
            if met:
                out.append((i, name, round(max(x for _, x in met), 9), min(s for s, _ in met), len(met)))
    return sorted(out, key=str)


def test_planted_notices(spark):
    rows = []
    for k, (name, body) in enumerate(l.TEMPLATES.items()):
        rows.append((k, cases.prose(k, 37 + 5 * k) + " " + body.upper() + " " + cases.prose(50 + k, 60)))
        words = body.split()
        words[len(words) // 2] = "changed"
        rows.append((100 + k, cases.prose(70 + k, 20) + "\n// " + " ".join(words) + "\n" + body))
    rows += [(200, "released under the"), (201, cases.prose(1, 3000)), (202, "MIT license " * 50)]
    got = sorted(((r.doc_id, r.license, round(r.containment, 9), r.start_word, r.n_windows) for r in l.scan_licenses(cases.plain(spark, rows)).collect()), key=str)
    assert got == brute(rows, l.TEMPLATES) and {r[0] for r in got} >= set(range(len(l.TEMPLATES)))


def test_a_table_against_duckdb(spark):
    d = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}'")
    cur = con.execute(l.scan_sql())
    names = [c[0] for c in cur.description]
    want = sorted(str({**dict(zip(names, r)), "containment": round(dict(zip(names, r))["containment"], 9)}) for r in cur.fetchall())
    got = sorted(str({n: round(r[n], 9) if n == "containment" else r[n] for n in names}) for r in l.scan_licenses(spark.read.parquet(d)).collect())
    assert got == want and got


def test_plan_has_no_python(spark):
    from quillrank.plans.inspect import plan_text

    assert not re.search("Python|Pandas|Arrow", plan_text(l.scan_licenses(cases.plain(spark, [(1, "x")])), "simple"))


def test_odd_rows(spark):
    notice = l.TEMPLATES["MIT/short"]
    rows = [*cases.ODD, (11, notice), (11, notice), (None, notice)]
    got = l.scan_licenses(cases.odd(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.license) for r in got) == [("11", "MIT/short"), ("11", "MIT/short"), ("None", "MIT/short")]
    assert l.scan_licenses(cases.none(spark)).count() == 0
    assert l.scan_licenses(cases.odd(spark, rows), {}).count() == 0
    with pytest.raises(ValueError):
        l.scan_licenses(cases.none(spark), {"x": "too short"})
