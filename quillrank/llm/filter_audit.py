"""Filter interaction audit: what every order of a set of filters removes, by part.

A document is removed by the first filter of an order that it fails, so what
an order does depends on a document only through the set of filters it fails.
Documents are therefore counted by (part, failed set) first, and the rest is
arithmetic on the subset lattice: a state is the set of filters already
applied, an edge applies one more. **Forward-backward path counting** counts
the orders that reach each state and those that leave it; an edge's removals
times the orders through it, summed over a filter's edges, give its Shapley
sum, and the steps of each order are read from the same edges.

The texts are read once. The filters of texts are counted in Arrow tasks, on
whole texts. A document's text is identical to a smaller id's where that id is
the smallest of its 128-bit digest in the whole table: copies are combined
per task before they are shuffled, so a group of copies of any size moves as
a few rows.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm import words

LETTERS = "ABCDE"
#: Fixed values of the filters.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def failed_by_text(data: np.ndarray, hashes: np.ndarray) -> int:
    """Bits of the filters A, B, C and D that one text fails, from its bytes and its words' hashes."""
    n, chars = len(hashes), int(np.count_nonzero((data & 0xC0) != 0x80))
    upper = int(np.count_nonzero((data >= 65) & (data <= 90)))
    bad = [n < MIN_WORDS, 100 * len(np.unique(hashes)) < DISTINCT_PERCENT * n, 100 * upper > UPPER_PERCENT * chars, bool(_SYMBOL[data].any())]
    return sum(b << k for k, b in enumerate(bad))


def _features(batches):
    for batch in batches:
        doc, part, text = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "part", "text"))
        for first, block in words.scan(text):
            mask, digest = [], []
            for i in range(len(block)):
                own = block.data[block.text[i] : block.text[i + 1]]
                mask.append(failed_by_text(own, block.of(i)))
                digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([doc.slice(first, len(block)), part.slice(first, len(block)), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
                                             ["doc_id", "part", "mask", "digest"])


def failed_sets(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and set of failed filters (bit k: filter k).

    ``docs`` needs doc_id and text, and the column that names the part; null
    texts and parts are empty strings. Each row is a document; rows of one id
    are copies of none of smaller id. A row without an id is nobody's smaller
    id, has none itself, and has no label. A document is good (toxic) where any
    of its label rows has quality (toxic) 1. Other columns are ignored, and an
    empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = docs.mapInArrow(_features, "doc_id long, part string, mask int, digest binary")
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.expr("coalesce(quality = 1, false)").cast("long")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)").cast("long")).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").withColumns({c: F.col("n") * F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})

    # per text and part: all rows, those of the smallest id, and those without one
    nameless = F.expr("CASE WHEN doc_id IS NULL THEN n ELSE 0 END")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", "good", "toxic")))
    texts = rows.groupBy("digest", "mask", "part").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"), F.sum(nameless).alias("nameless"), least.alias("least"))
    first = texts.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    texts = texts.join(first, "digest").withColumn("own", F.expr("coalesce(least.doc_id = first, false)"))
    kept = {"n": F.expr("nameless + CASE WHEN own THEN least.n ELSE 0 END"), **{c: F.expr(f"CASE WHEN own THEN least.{c} ELSE 0L END") for c in ("good", "toxic")}}
    copy = 1 << (len(LETTERS) - 1)
    both = F.array(F.struct(F.col("mask").alias("mask"), *[v.alias(c) for c, v in kept.items()]),
                   F.struct((F.col("mask") + F.lit(copy)).alias("mask"), *[(F.col(c) - v).alias(c) for c, v in kept.items()]))
    split = texts.select("part", F.explode(both).alias("s")).select("part", "s.*").where("n > 0")
    return split.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])


def path_counts(n: int) -> list[tuple[int, int, int]]:
    """``(state, filter, orders through)`` of each edge of the lattice of n filters.

    Forward: orders that reach a state are the sum over its in-edges of those
    that reach the state before; backward likewise from the full set.
    """
    full = (1 << n) - 1
    reach, leave = {0: 1}, {full: 1}
    for s in range(1, full + 1):  # a state's predecessors are smaller numbers
        reach[s] = sum(reach[s ^ (1 << f)] for f in range(n) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | 1 << f] for f in range(n) if not s >> f & 1)
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(full) for f in range(n) if not s >> f & 1]


def lattice_audit(sets: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order's steps, per part, from ``sets (part, mask, n, good, toxic)``.

    The lattice has ``k * 2**(k-1)`` edges and ``k * k!`` steps for k filters (80 and
    600 here), whatever the data; they are literal rows. Columns: part,
    filter_order, step, and the counts of documents kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. An empty ``sets`` gives no rows.
    """
    spark, k = sets.sparkSession, len(letters)
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(through).alias("through")) for s, f, through in path_counts(k)])
    bit = F.expr("shiftleft(1, e.filter)")
    fails, gone = (F.col("mask").bitwiseAND(bit) != 0), (F.col("mask").bitwiseAND(F.col("e.state")) != 0)

    def total(when, what="n"):
        return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")

    edge = sets.select("part", "mask", "n", "good", "toxic", F.explode(edges).alias("e")).groupBy("part", "e.state", "e.filter", "e.through").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"), total(~gone & fails, "good").alias("good_lost"), total(~gone & fails, "toxic").alias("toxic_lost"))
    whole = edge.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("through")).cast("long").alias("shapley"))
    steps = [("".join(letters[f] for f in p), i + 1, sum(1 << f for f in p[:i]), p[i]) for p in permutations(range(k)) for i in range(k)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    return edge.join(whole, ["part", "filter"]).join(steps, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The five filters over whole ``docs``: see :func:`failed_sets` and :func:`lattice_audit`.

    A: under 100 words; B: under 80 % distinct words; C: over 10 % of the code
    points are A-Z; D: holds a symbol; E: identical to a smaller doc_id's text.
    """
    return lattice_audit(failed_sets(docs, labels, part))


def audit_sql() -> str:
    """DuckDB statement of the registered query, by brute force over orders and failed sets."""
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH base AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
doc AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < {MIN_WORDS} THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
    FROM base LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM doc GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
perm AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
step AS (SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS f, '[' || substr(filter_order, 1, step::INT - 1) || '0]' AS before FROM perm, range(1, 6) r(step)),
cell AS (SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT regexp_matches(fails, before) AND NOT contains(fails, f)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT regexp_matches(fails, before) AND contains(fails, f)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (regexp_matches(fails, before) AND contains(fails, f)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT regexp_matches(fails, before) AND contains(fails, f)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT regexp_matches(fails, before) AND contains(fails, f)), 0)::BIGINT AS toxic_lost
    FROM sets, step GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM cell"""
