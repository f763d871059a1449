"""Word n-gram Jaccard self-join by vertical partitioning, exact.

The global n-gram order (rare first, by corpus frequency, then by hash) is
cut into fragments. A document's set is cut with it, overlaps are counted
fragment by fragment and summed per pair.

Steps, each a Spark job written to the shared folder:

1. **Order.** Every task counts the grams of its texts and reports those it
   met more than once; the sums of the most frequent ``MAX_FREQUENT`` (a fixed
   bound, 16 bytes each) make up the tail of the global order. Any order gives
   the right result; this one keeps a line that many documents share out of
   the first fragment.
2. **Classes.** Documents of equal sets become one node, so a group of copies
   costs one row however large it is.
3. **First fragment.** Only the first ``n - ceil(t n) + l`` grams of each
   node are compared across nodes; by the prefix principle two linked nodes
   share at least ``l`` of them. Nodes that share fewer with everyone are done.
4. **Live grams.** For the nodes left, grams that no other such node has are
   counted out; a node of fewer than ``ceil(t n)`` live grams links with none.
5. **Pairs.** Within each gram of the live prefix, every node is first paired
   with the bucket's node of the most live grams only. What is verified forms
   components; then only pairs across components that length, live-gram and
   position bounds leave open are generated. A group of copies is therefore
   not expanded into all its pairs, and no link that joins two components is lost.
6. **Verification.** Each pair's overlap is the sum over fragments of partial
   overlaps, in whole-set integer arithmetic: ``den * inter >= num * union``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.llm import words
from quillrank.llm.common import Scratch, components, largest, magnitude

#: Grams ranked by frequency in the global order; the others go first, by hash.
MAX_FREQUENT = 1 << 16
#: A gram reported fewer times than this stays among the others.
MIN_FREQUENT = 16
#: Grams gathered in a task before it counts them.
COUNT_BLOCK = 1 << 21
#: Fragments that verification cuts the order into.
FRAGMENTS = 8


def _distinct(batches, k: int, columns: tuple[str, ...]):
    """Per block of rows: the other columns, and one sorted distinct gram array per row."""
    for batch in batches:
        others = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for first, block in words.scan(batch.column(batch.schema.get_field_index("text")), lower=True):
            grams, at = block.grams(k)
            yield [c.slice(first, len(block)) for c in others], [np.unique(grams[at[i] : at[i + 1]]) for i in range(len(block))]


def _count(k: int):
    def run(batches):
        held, size = [], 0

        def flush():
            g, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(g[c > 1].view(np.int64)), pa.array(c[c > 1].astype(np.int64))], ["h", "c"])

        for _, sets in _distinct(batches, k, ()):
            for s in sets:
                held.append(s)
                size += len(s)
            if size >= COUNT_BLOCK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def frequent_grams(docs: DataFrame, k: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent grams and their reported counts, at most ``MAX_FREQUENT`` of them, sorted by gram."""
    counts = docs.select("text").mapInArrow(_count(k), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    counts = scratch.save(counts.where(F.col("c") >= MIN_FREQUENT), "frequent")
    top = largest(counts, magnitude(F.col("c")), MAX_FREQUENT, "h").toArrow()
    h = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], top["c"].to_numpy()[order]


def _list_array(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _key(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _prefixes(k: int, num: int, den: int, frequent):
    def run(batches):
        hot, counts = frequent.value
        for (ids,), sets in _distinct(batches, k, ("doc_id",)):
            keys, first = [], []
            for s in sets:
                keys.append(_key(s))
                n = len(s)
                take = n - -(-num * n // den) + 1 + n // 10
                if take < n and len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    rank = np.where(hot[at] == s, counts[at], 0)
                    if rank.any():
                        s = s[np.lexsort((s, rank))]
                first.append(s[:take])
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), _list_array(first)],
                ["doc_id", "n", "key", "prefix"])

    return run


def _sets(k: int):
    """Key and set of each text; a task gives equal sets once."""
    def run(batches):
        seen = set()
        for _, sets in _distinct(batches, k, ()):
            new = {}
            for s in sets:
                key = _key(s)
                if key is not None and key not in seen:
                    seen.add(key)
                    new[key] = s
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), _list_array(list(new.values()))], ["key", "grams"])

    return run


def _verified(pairs: DataFrame, live: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: partial overlaps per fragment, summed."""
    width = 64 - (FRAGMENTS - 1).bit_length()
    fragments = F.expr(f"transform(sequence(0, {FRAGMENTS - 1}), f -> struct(f AS f, filter(live, x -> shiftrightunsigned(x, {width}) = f) AS part))")
    cut = live.select("node", "n", F.explode(fragments).alias("s")).select("node", "n", "s.f", "s.part").where("size(part) > 0")
    left = cut.select(F.col("node").alias("a"), F.col("n").alias("na"), "f", F.col("part").alias("pa"))
    right = cut.select(F.col("node").alias("b"), F.col("n").alias("nb"), "f", F.col("part").alias("pb"))
    partial = pairs.join(left, "a").join(right, ["b", "f"]).select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).cast("long").alias("c"))
    whole = partial.groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return whole.where(f"c * {den + num} >= {num} * (na + nb)").select("a", "b")


def _possible(x: str, y: str, num: int, den: int) -> str:
    """SQL: length, live-gram and position bounds leave a pair open."""
    need = f"{num} * ({x}.n + {y}.n)"
    return " AND ".join([f"{den} * least({x}.n, {y}.n) >= {num} * greatest({x}.n, {y}.n)",
                         f"least({x}.rest, {y}.rest) * {den + num} >= {need}"])


def ngram_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, class_size, key, first_key)`` per row of ``docs(doc_id, text)``.

    Two documents link when ``den * |A n B| >= num * |A u B|`` over their sets
    of distinct lower-cased k-word shingles. ``component_id`` is the smallest
    doc_id reachable by links (itself included). A null text is an empty one:
    set size 0, linked with nothing. A text of fewer than k words, but one, is
    one shingle. A row without a doc_id takes part and gets the smallest id of
    its component, null where there is none. Repeated rows are repeated in the
    result; rows of one id and different texts are separate documents. Other
    columns are ignored. An empty table gives an empty result. ``class_size``
    rows have the same set; ``key`` stands for it (null for an empty one), and
    ``first_key`` for the set of the row that ``component_id`` names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_grams(docs, k, scratch))

    sized = scratch.save(docs.mapInArrow(_prefixes(k, num, den, frequent), "doc_id long, n long, key binary, prefix array<long>"), "sized")
    nodes = sized.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    first = nodes.select("node", F.explode("prefix").alias("h"))
    met = first.groupBy("h").agg(F.count("*").alias("df")).where("df > 1").select("h")
    enough = first.join(met, "h").groupBy("node").agg(F.count("*").alias("c"))
    least = F.expr(f"1 + ((n * {num} + {den - 1}) div {den}) div 10")
    kept = nodes.drop("prefix").join(enough, "node").where(F.col("c") >= least).select("node", "n", "key", "doc_id")
    kept = scratch.save(kept, "kept")

    # one text of each node: its id's, or any without an id; other texts of these ids find no node of their key, or their own
    texts = docs.join(kept.where("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    sets = texts.select("text").mapInArrow(_sets(k), "key binary, grams array<long>").join(kept.select("node", "n", "key"), "key")
    sets = scratch.save(sets.groupBy("node").agg(F.first("n").alias("n"), F.first("grams").alias("grams")), "sets")

    rows = sets.select("node", "n", F.explode("grams").alias("h"))
    df = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    live = rows.join(df, "h").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    live = live.select("node", "n", F.col("o.h").alias("live")).where(F.size("live") * den >= F.col("n") * num)
    live = scratch.save(live, "live")
    scratch.drop("sets")

    r, least = F.size("live").cast("long"), F.expr(f"(n * {num} + {den - 1}) div {den}")
    prefix = live.select("node", "n", r.alias("r"), F.posexplode(F.slice("live", F.lit(1), (r - least + 1).cast("int"))).alias("p", "h"))
    prefix = scratch.save(prefix.select("node", "n", "r", "h", (F.col("r") - F.col("p")).alias("rest")), "prefix")

    # the fullest node of each bucket first
    lead = prefix.groupBy("h").agg(F.max(F.struct((F.col("r") / F.col("n")).alias("part"), F.col("node"), F.col("n"), F.col("rest"))).alias("l"), F.count("*").alias("m")).where("m > 1").select("h", "l.*")
    star = prefix.alias("x").join(lead.alias("y"), F.expr("x.h = y.h AND x.node <> y.node AND " + _possible("x", "y", num, den)))
    star = scratch.save(star.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "star")
    links = scratch.save(_verified(star, live, num, den), "links")
    roots = scratch.save(components(scratch, links), "roots")

    # then what bounds leave open across components
    mine = prefix.join(roots, "node", "left").select("node", "n", "h", "rest", F.coalesce("root", "node").alias("root"))
    mine = scratch.save(mine, "mine")
    across = mine.alias("x").join(mine.alias("y"), F.expr("x.h = y.h AND x.node < y.node AND x.root <> y.root AND " + _possible("x", "y", num, den)))
    across = across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = scratch.save(_verified(across, live, num, den), "more")
    roots = scratch.save(components(scratch, links.union(more)), "final")

    member = nodes.select("key", "node", "doc_id").join(roots, "node", "left").select("key", "doc_id", F.coalesce("root", "node").alias("root"))
    named = member.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("f"))
    named = named.select("root", F.col("f.doc_id").alias("component_id"), F.col("f.key").alias("first_key"))
    member = member.join(named, "root").select("key", "component_id", "first_key")
    sizes = sized.where("n > 0").groupBy("key").agg(F.count("*").alias("class_size"))
    member = member.join(sizes, "key")
    out = sized.select("doc_id", "n", "key").join(member, "key", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"),
                     F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                     F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), "key", "first_key")
    return scratch.finish(out)


def _keyed(k: int):
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for others, sets in _distinct([batch], k, tuple(names)):
                yield pa.RecordBatch.from_arrays([*others, pa.array([_key(s) for s in sets], pa.binary())], [*names, "__key"])

    return run


def keep_first(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, all columns as they are.

    Rows without words link with nothing and all stay. Rows without an id go
    where their component has an id. Of several rows of the id that stays and of
    one shingle set (or without any id), the one whose row is smallest as JSON does.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    found = ngram_components(docs, k, num, den).where("key IS NOT NULL")
    stays = (F.col("key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    lost = found.where(~stays).select(F.col("doc_id").alias("__id"), F.col("key").alias("__lost")).distinct()
    again = found.where(stays).groupBy("key", "doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"), F.col("key").alias("__lost"))

    rows = docs.mapInArrow(_keyed(k), T.StructType([*docs.schema.fields, T.StructField("__key", T.BinaryType())]))
    mine = (F.col("__key") == F.col("__lost")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    rows = rows.join(lost, mine, "left_anti")
    if not again.limit(1).count():
        return rows.select(*kept)
    row = F.struct(*kept)
    once = rows.join(again, mine, "left_semi").groupBy("__key").agg(F.min_by(row, F.to_json(row)).alias("r")).select("r.*")
    return rows.join(again, mine, "left_anti").select(*kept).unionByName(once)
