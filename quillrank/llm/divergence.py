"""Source divergence audit: how a source's terms differ from its language's, exact.

Shares are whole numbers of a billion: ``p = 1 + floor(10**9 (c + 2) / (N + 2 V))``
for a term's count c of N in a group, over the language's V kept terms, and
two shares differ by ``floor((p - q)**2 / (p + q))``. Every division is one of
whole numbers (:func:`share`, :func:`gap`).

Counts. Each task counts its texts' terms by (lang, source) and hands on one
row per term; the rows meet at (lang, term), where the language's count and
document frequency are known too, so the corpus is read and shuffled once.

Terms. A term's divergence from its language rises with its count in the
group and falls with its count in the language, and ties go to the earlier
term. So a term that k others **dominate** (count in the group at least as
high, count in the language at least as low, UTF-8 earlier) is not among the
first k. Each partition hands on only its **skyband**, the terms dominated by
fewer than k others of it; the skybands of a group are merged to its own, and
what is left is ranked exactly.

Pairs. Sources of a language fall into blocks of about ``BLOCK`` by hash, and
its terms into buckets. A unit is one pair of blocks and one bucket; it sums
the gaps of its terms for its pairs of sources as a matrix. Terms that a
unit's sources don't have add one known gap each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm import words
from quillrank.llm.common import Scratch

UNIT = 1_000_000_000
#: Sources of a language per block, terms per bucket (both about), and terms compared at once.
BLOCK, BUCKET, CHUNK = 64, 4096, 256
#: Counts that a task gathers before it hands them on.
GATHERED = 1 << 21
#: Bytes of terms: ASCII letters, made small, and everything beyond ASCII.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


# ------------------------------------------------------------------ counts
def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])


class _Counts:
    """Counts and document counts by (group, term) of the texts a task has met."""

    def __init__(self):
        self.groups, self.parts, self.size = {}, [], 0

    def add(self, group: np.ndarray, block: words.Words) -> None:
        row = np.repeat(np.arange(len(block)), np.diff(block.row))
        if not len(row):
            return
        hashes, first, term = np.unique(block.hash, return_index=True, return_inverse=True)
        pair, n = np.unique(row * len(hashes) + term, return_counts=True)  # one per document and term
        cell, at = np.unique(group[pair // len(hashes)] * len(hashes) + pair % len(hashes), return_inverse=True)
        count = np.bincount(at, weights=n, minlength=len(cell)).astype(np.int64)
        self.parts.append((hashes, _spans(block.data, block.starts[first], block.ends[first]), cell // len(hashes), cell % len(hashes), count, np.bincount(at, minlength=len(cell))))
        self.size += len(cell)

    def flush(self):
        """One batch per call's worth of rows; groups get a row without a term."""
        names = list(self.groups)
        base = np.cumsum([0, *[len(p[0]) for p in self.parts]])
        hashes = np.concatenate([p[0] for p in self.parts]) if self.parts else np.zeros(0, np.uint64)
        uniq, first, term = np.unique(hashes, return_index=True, return_inverse=True)
        text = pa.chunked_array([p[1] for p in self.parts], pa.large_binary()).take(pa.array(first)) if self.parts else pa.chunked_array([], pa.large_binary())
        group = np.concatenate([p[2] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        which = term[np.concatenate([p[3] + b for p, b in zip(self.parts, base)])] if self.parts else np.zeros(0, np.int64)
        cell, at = np.unique(group * max(1, len(uniq)) + which, return_inverse=True)
        sums = [np.bincount(at, weights=np.concatenate([p[k] for p in self.parts]), minlength=len(cell)).astype(np.int64) if self.parts else np.zeros(0, np.int64) for k in (4, 5)]
        group, which = cell // max(1, len(uniq)), cell % max(1, len(uniq))
        lang, source = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(names), pa.string()), pa.array(np.zeros(len(names), np.int64)), pa.array(np.zeros(len(names), np.int64))], ["lang", "source", "term", "c", "d"])
        step = 1 << 16
        for i in range(0, len(cell), step):
            s = slice(i, i + step)
            terms = pa.array(text.take(pa.array(which[s])).combine_chunks()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(group[s])), source.take(pa.array(group[s])), terms, pa.array(sums[0][s]), pa.array(sums[1][s])], ["lang", "source", "term", "c", "d"])
        self.__init__()


def _count(batches):
    counts = _Counts()
    for batch in batches:
        lang, source, text = (batch.column(batch.schema.get_field_index(c)) for c in ("lang", "source", "text"))
        for first, block in words.scan(text, fold=_FOLD):
            keys = zip(lang.slice(first, len(block)).to_pylist(), source.slice(first, len(block)).to_pylist())
            counts.add(np.array([counts.groups.setdefault(k, len(counts.groups)) for k in keys]), block)
            if counts.size >= GATHERED:
                yield from counts.flush()
    yield from counts.flush()


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, c, lc, leads)``: counts of kept terms in each group and its language.

    ``leads`` is 1 on one row of each term of a language; each group has a row
    without a term besides. A task's bounded counts are 64-bit and exact.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    met = docs.mapInArrow(_count, "lang string, source string, term string, c long, d long").repartition("lang", "term")
    met = met.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    whole = Window.partitionBy("lang", "term")
    met = met.select("lang", "source", "term", "c", F.sum("c").over(whole).alias("lc"), F.sum("d").over(whole).alias("df"), F.min("source").over(whole).alias("low"))
    return met.where(F.col("term").isNull() | (F.col("df") >= least)).select("lang", "source", "term", "c", "lc", F.when(F.col("term").isNotNull() & (F.col("source") == F.col("low")), 1).otherwise(0).alias("leads"))


def groups(kept: DataFrame) -> DataFrame:
    """``(lang, source, n, v, ln, sources)`` of every group: its count, its language's terms, count and sources."""
    own = kept.groupBy("lang", "source").agg(F.sum(F.when(F.col("term").isNotNull(), F.col("c")).otherwise(0)).alias("n"), F.sum("leads").alias("leads"))
    of = own.groupBy("lang").agg(F.sum("leads").alias("v"), F.sum("n").alias("ln"), F.count("*").alias("sources"))
    return own.drop("leads").join(of, "lang")


# ------------------------------------------------------------------ shares
def share(c: Column, n: Column, v: Column) -> Column:
    """``1 + floor(10**9 (c + 2) / (n + 2 v))``, in 38 digits."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (c + 2).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, (n + 2 * v).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / (p + q))``; shares are at most 10**9 + 1, so 64 bits hold the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _share(c: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """As :func:`share`: three digits of the quotient at a time, so that counts up to 9 * 10**15 are exact."""
    rest, out = c + 2, np.zeros(np.broadcast_shapes(c.shape, whole.shape), dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


# ------------------------------------------------------------------ pairs
def _unit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per pair of sources (a before b) of one unit: its sum of gaps, and the terms it has summed."""
    lang, left, right, _ = [k.as_py() for k in key]
    is_group = np.array(pc.is_null(table["term"]))
    who = table.filter(pa.array(is_group))
    source, block = np.array(who["source"].to_pylist(), dtype=object), who["block"].to_numpy()
    whole = who["c"].to_numpy() + 2 * who["v"].to_numpy()
    rows = table.filter(pa.array(~is_group))
    if not rows.num_rows:
        return pa.table({"lang": [], "a": [], "b": [], "part": [], "met": []}, schema=_PAIR)
    at = {s: i for i, s in enumerate(source)}
    column = pc.index_in(rows["source"], pa.array(list(at), pa.string())).to_numpy()
    term = pc.rank(rows["term"].combine_chunks(), sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64) - 1
    order = np.argsort(term, kind="stable")
    term, column, c = term[order], column[order], rows["c"].to_numpy()[order]
    m = len(source)
    ours = np.zeros((m, m), dtype=np.int64)
    n_terms = int(term[-1]) + 1
    for i in range(0, n_terms, CHUNK):
        lo, hi = np.searchsorted(term, [i, i + CHUNK])
        counts = np.zeros((min(CHUNK, n_terms - i), m), dtype=np.int64)
        counts[term[lo:hi] - i, column[lo:hi]] = c[lo:hi]
        p = _share(counts, whole[None, :])
        for j in range(m):
            d, s = p - p[:, j : j + 1], p + p[:, j : j + 1]
            ours[j] += (d * d // s).sum(axis=0)
    a, b = np.nonzero((block[:, None] == left) & (block[None, :] == right) & ((left != right) | (source[:, None] < source[None, :])))
    return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(source[a], pa.string()), pa.array(source[b], pa.string()), pa.array(ours[a, b]), pa.array(np.full(len(a), n_terms))], schema=_PAIR)


_PAIR = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("part", pa.int64()), ("met", pa.int64())])


def pair_gaps(kept: DataFrame, known: DataFrame, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """``(lang, source, item, value)`` for each ordered pair of a language's sources."""
    of = known.groupBy("lang").agg(F.first("v").alias("v"), (F.ceil(F.count("*") / block)).cast("int").alias("blocks"))
    of = of.withColumn("buckets", F.ceil(F.greatest(F.col("v"), F.lit(1)) / bucket).cast("int"))
    mine = F.pmod(F.xxhash64("source"), F.col("blocks").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    rows = kept.where("term IS NOT NULL").select("lang", "source", "term", "c").join(of, "lang").withColumn("block", mine)
    rows = rows.select("lang", "source", "term", "c", "v", "block", F.pmod(F.xxhash64("term", F.lit(1)), F.col("buckets").cast("long")).cast("int").alias("bucket"), other)
    marks = known.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("n").alias("c")).join(of, "lang").withColumn("block", mine)
    marks = marks.select("lang", "source", "term", "c", "v", "block", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "blocks")
    marks = marks.select("lang", "source", "term", "c", "v", "block", "bucket", other)
    units = rows.unionByName(marks).withColumns({"left": F.least("block", "o"), "right": F.greatest("block", "o")})
    sums = units.groupBy("lang", "left", "right", "bucket").applyInArrow(_unit, "lang string, a string, b string, part long, met long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("met").alias("met"))

    # every pair has a row, also where no unit has a term; absent terms add their gap
    zero = share(F.lit(0), F.col("n"), F.col("v"))
    ends = known.select("lang", "source", "v", F.when(F.col("v") > 0, zero).otherwise(0).alias("z")).join(of.select("lang", "blocks"), "lang").withColumn("block", mine)
    a = ends.select("lang", F.col("source").alias("a"), F.col("z").alias("za"), "v", F.col("block").alias("ba"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bb"))
    b = ends.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"), F.col("block").alias("bb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("ba"))
    pairs = a.join(b, ["lang", "ba", "bb"]).where("ba < bb OR (ba = bb AND a < b)").join(sums, ["lang", "a", "b"], "left")
    rest = (F.col("v") - F.coalesce("met", F.lit(0))) * F.when(F.col("v") > 0, gap(F.col("za"), F.col("zb"))).otherwise(0)
    pairs = pairs.select("lang", "a", "b", (F.coalesce("part", F.lit(0)) + rest).cast("long").alias("value"))
    two = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")
    return pairs.select("lang", two, "value").select("lang", "s.source", "s.item", "value")


# ------------------------------------------------------------------ terms
def skyband(c: np.ndarray, lc: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Indices of the points that fewer than k others dominate (``term``: ranks of the UTF-8 order).

    One point dominates another where its c is at least as high, its lc at
    least as low and its term earlier. In the order of c, lc and term a point's
    dominators come first, and its first k dominators are kept themselves, so
    comparing with what is kept is enough.
    """
    order = np.lexsort((term, lc, -c))
    kc, kl, kt = (np.zeros(0, np.int64) for _ in range(3))
    kept = []
    for i in range(0, len(order), CHUNK):
        o = order[i : i + CHUNK]
        x, y, z = c[o], lc[o], term[o]
        beaten = ((kc[None, :] >= x[:, None]) & (kl[None, :] <= y[:, None]) & (kt[None, :] < z[:, None])).sum(axis=1)
        inner = (x[None, :] >= x[:, None]) & (y[None, :] <= y[:, None]) & (z[None, :] < z[:, None])
        stays = beaten + inner.sum(axis=1) < k  # within the chunk all dominators count, which gives the same points
        o = o[stays]
        kept.append(o)
        kc, kl, kt = np.concatenate([kc, c[o]]), np.concatenate([kl, lc[o]]), np.concatenate([kt, term[o]])
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _band(table: pa.Table, k: int) -> pa.Table:
    rank = pc.rank(table["term"].combine_chunks(), sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    return table.take(pa.array(skyband(table["c"].to_numpy(), table["lc"].to_numpy(), rank, k)))


def _local(k: int, held: int = 1 << 18):
    """A partition's skyband of each group; more than ``held`` rows are handed on and begun anew."""
    def run(batches):
        bands, schema = {}, None
        for batch in batches:
            schema = batch.schema
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table.append_column("__g", pa.array(np.arange(table.num_rows)))
            code = table.group_by(["lang", "source"]).aggregate([("__g", "list")])
            for lang, source, at in zip(code["lang"].to_pylist(), code["source"].to_pylist(), code["__g_list"]):
                mine = table.take(at.values).drop_columns(["__g"])
                old = bands.get((lang, source))
                bands[lang, source] = (old or []) + [mine]
                if sum(t.num_rows for t in bands[lang, source]) > 4 * CHUNK:
                    bands[lang, source] = [_band(pa.concat_tables(bands[lang, source]), k)]
            if sum(t.num_rows for b in bands.values() for t in b) > held:
                for b in bands.values():
                    yield from _band(pa.concat_tables(b), k).combine_chunks().to_batches()
                bands = {}
        for b in bands.values():
            yield from _band(pa.concat_tables(b), k).combine_chunks().to_batches()

    return run


def leading_terms(kept: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """``(lang, source, item, value, rank)``: each group's first k terms of higher share than in its language."""
    def merged(table: pa.Table) -> pa.Table:
        return _band(table, k)

    cells = kept.where("term IS NOT NULL AND c > 0").select("lang", "source", "term", "c", "lc")
    kind = "lang string, source string, term string, c long, lc long"
    bands = cells.mapInArrow(_local(k), kind).groupBy("lang", "source").applyInArrow(merged, kind)
    at = bands.join(known, ["lang", "source"]).withColumns({"p": share(F.col("c"), F.col("n"), F.col("v")), "q": share(F.col("lc"), F.col("ln"), F.col("v"))})
    at = at.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return ranked(at).where(F.col("rank") <= k)


def ranked(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))))


def source_divergence(docs: DataFrame, least: int = 10, k: int = 10) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs (text, lang, source)``.

    Part ``pair``: the group's divergence from every other source of its
    language, all ranks. Part ``term``: its first k terms of higher share than
    in the language. Terms are runs of ASCII letters (A-Z made small) and
    characters beyond ASCII; a language keeps those in at least ``least`` of its
    rows. Null texts, languages and sources are empty strings; repeated rows
    count as often as they are there; a group without terms has its pairs (value
    0 where the language keeps none) and no terms. Other columns are ignored;
    an empty table gives no rows. Ranks begin at 1, by value, then by the item's UTF-8.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    kept = scratch.save(kept_counts(docs, least), "kept")
    known = scratch.save(groups(kept), "known")
    pairs = ranked(pair_gaps(kept, known)).withColumn("part", F.lit("pair"))
    terms = leading_terms(kept, known, k).withColumn("part", F.lit("term"))
    return scratch.finish(pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank"))


def divergence_sql(least: int = 10, k: int = 10) -> str:
    """DuckDB statement of the registered query, in 128-bit whole numbers."""
    def share_of(c: str, n: str) -> str:
        return f"(1 + ({UNIT}::HUGEINT * ({c} + 2)) // ({n} + 2 * v))"

    return f"""
WITH base AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM base),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM base),
kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= {least}),
cell AS (SELECT lang, source, term, count(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
whole AS (SELECT lang, term, sum(c) AS c FROM cell GROUP BY ALL),
lang_n AS (SELECT lang, sum(c) AS n, count(*) AS v FROM whole GROUP BY lang),
grp_n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n, coalesce(any_value(v), 0) AS v FROM grp g LEFT JOIN cell USING (lang, source) LEFT JOIN lang_n l ON g.lang = l.lang GROUP BY ALL),
p AS (SELECT g.lang, g.source, w.term, {share_of('coalesce(c.c, 0)', 'g.n')} AS p, coalesce(c.c, 0) AS c, v
    FROM grp_n g JOIN whole w ON g.lang = w.lang LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term),
gaps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
q AS (SELECT p.lang, source, p.term AS item, p, c, {share_of('(SELECT c FROM whole w WHERE w.lang = p.lang AND w.term = p.term)', '(SELECT n FROM lang_n l WHERE l.lang = p.lang)')} AS q FROM p),
term AS (SELECT lang, source, 'term' AS part, item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM q WHERE c > 0 AND p > q),
ranks AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranks WHERE part = 'pair' OR rank <= {k}"""
