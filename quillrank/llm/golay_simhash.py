"""SimHash near duplicates found by Golay-code fuzzy hashing, exact.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each padded
with zeros to the 23 bits of the perfect Golay code. Decoding maps every word
to the only codeword within three errors. A segment's **fuzzy keys** are the
codewords of the word itself and of all words one bit away: one key where the
word is within two bits of its codeword, six otherwise. Two words at most two
bits apart have a word at most one bit from both, so they share a key.

Four errors over three segments leave, by the pigeonhole principle, either

* no segment with more than two errors: all three share a fuzzy key, or
* a segment with three or four: of the other two, one has no error and the
  other one at most, so the first is equal and the second shares a fuzzy key.

Each fingerprint therefore gives the triples of its segments' keys (216 at
most) and, per ordered pair of segments, the first one's bits with each key of
the second (36 at most); linked fingerprints share one of these. Equal
fingerprints are one node, whatever the number of documents.

Of each shared key every fingerprint is first compared with the smallest one
of the key, and what is within the limit forms components. Keys that still
join several components are then worked off exactly: all pairs across
components where these are fewer than ``PAIRS_PER_NODE`` per fingerprint,
else by midpoints (two words are at most four bits apart just where some word
is at most two bits from both), 2081 rows for each fingerprint. No group of
near copies is expanded into all its pairs.
"""

from __future__ import annotations

import functools
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import Scratch, components
from quillrank.llm.words import mix

MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
#: Generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
#: Words around a fingerprint at most two bits away; no more pairs than this are formed per fingerprint.
PAIRS_PER_NODE = 1 + 64 + 64 * 63 // 2
#: Shingles hashed at once, and fingerprints whose keys are made at once.
SHINGLES, NODES = 1 << 15, 1 << 9
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: bytes, k: int = 4, seed: int = 42) -> int:
    """SimHash of one text: a bit is 1 where more than half of the k-word shingles' XXH64 have it."""
    raw = np.frombuffer(text.lower().translate(_SPACES), dtype=np.uint8)
    gap = raw == 32
    kept = ~gap
    kept[1:] |= ~gap[:-1]  # the first space after a word stays
    norm = raw[kept].tobytes().rstrip(b" ")
    if not norm:
        return 0
    cuts = np.flatnonzero(np.frombuffer(norm, dtype=np.uint8) == 32)
    starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(norm)]])
    n = max(1, len(starts) - k + 1)
    ends = ends[k - 1 :] if len(ends) >= k else ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, SHINGLES):
        spans = zip(starts[i : min(i + SHINGLES, n)].tolist(), ends[i : min(i + SHINGLES, n)].tolist())
        h = np.array([xxhash.xxh64_intdigest(norm[a:b], seed) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            out = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", k) for t in text], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(out.view(np.int64))], ["doc_id", "fp"])

    return run


# ------------------------------------------------------------------ keys
@functools.cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each 23-bit word, and the error of at most three bits of each syndrome."""
    bits = np.zeros(23, dtype=np.int64)
    for i in range(23):
        r = 1 << i
        for j in range(i, 10, -1):
            if r >> j & 1:
                r ^= GENERATOR << (j - 11)
        bits[i] = r
    syndrome = np.zeros(1, dtype=np.int16)
    for b in bits:
        syndrome = np.concatenate([syndrome, syndrome ^ np.int16(b)])
    error = np.zeros(2048, dtype=np.int32)
    for w in range(4):
        for places in combinations(range(23), w):
            e = sum(1 << p for p in places)
            error[syndrome[e]] = e
    return syndrome, error


def decode(v: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within three bits of each 23-bit word."""
    syndrome, error = _syndromes()
    return ((v ^ error[syndrome[v]]) >> 11).astype(np.int64)


def fuzzy_keys(v: np.ndarray, width: int) -> np.ndarray:
    """(n, 6) codeword indices of words and their one-bit neighbours, -1 where there are fewer."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    near = np.sort(decode(v[:, None] ^ flips[None, :]), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return -np.sort(-near, axis=1)[:, :6]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)``: the 64-bit keys of each fingerprint (uint64)."""
    seg = [((fp >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64) for at, w in SEGMENTS]
    near = [fuzzy_keys(s, w) for s, (_, w) in zip(seg, SEGMENTS)]
    n = len(fp)
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    triple = np.where((a >= 0) & (b >= 0) & (c >= 0), a << 24 | b << 12 | c, -1).reshape(n, -1)
    pairs = [np.where(near[j] >= 0, (1 + t) << 36 | seg[i][:, None] << 12 | near[j], -1) for t, (i, j) in enumerate(permutations(range(3), 2))]
    key = np.concatenate([triple, *pairs], axis=1)
    row, at = np.nonzero(key >= 0)
    return row, mix(key[row, at].view(np.uint64))


def _keys(batches):
    for batch in batches:
        fp = batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False)
        for i in range(0, len(fp), NODES):
            part = fp[i : i + NODES]
            row, key = golay_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part[row])], ["key", "fp"])


def _shared(batches):
    """Of rows sorted by key and fingerprint, those of keys with several, with the key's first fingerprint."""
    key, lead, held = None, None, None  # the open key, its first fingerprint, whether that is still unsaid
    for batch in batches:
        k, fp = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        if not len(k):
            continue
        begins = np.concatenate([[True], k[1:] != k[:-1]])
        at = np.flatnonzero(begins)
        first = fp[at][np.cumsum(begins) - 1]
        goes_on = key is not None and k[0] == key
        if goes_on:
            first[k == key] = lead
        many = ~begins
        many[at] = np.diff(np.append(at, len(k))) > 1
        many[k == k[0]] |= goes_on
        out_k, out_f, out_l = k[many], fp[many], first[many]
        if goes_on and held:
            out_k, out_f, out_l = np.append(out_k, key), np.append(out_f, lead), np.append(out_l, lead)
        if goes_on and at[-1] == 0:
            held = False
        else:
            key, lead, held = k[-1], fp[at[-1]], at[-1] == len(k) - 1
        yield pa.RecordBatch.from_arrays([pa.array(out_k), pa.array(out_f), pa.array(out_l)], ["key", "fp", "lead"])


def _midpoints(batches):
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    two = np.array([x | y for x, y in combinations(one.tolist(), 2)], dtype=np.uint64)
    flips = np.concatenate([np.zeros(1, np.uint64), one, two])
    for batch in batches:
        fp = batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False)
        for i in range(0, len(fp), NODES):
            part = fp[i : i + NODES]
            mid = part.view(np.uint64)[:, None] ^ flips
            yield pa.RecordBatch.from_arrays([pa.array(mid.reshape(-1).view(np.int64)), pa.array(np.repeat(part, len(flips)))], ["mid", "fp"])


# ------------------------------------------------------------------ links
def linked_components(nodes: DataFrame, scratch: Scratch, pairs_per_node: float = PAIRS_PER_NODE) -> DataFrame:
    """``(node, root)`` of the distinct fingerprints ``nodes (fp)`` that link with others."""
    keys = nodes.select("fp").mapInArrow(_keys, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
    met = scratch.save(keys.mapInArrow(_shared, "key long, fp long, lead long"), "met")

    def near(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.where(F.col(a) != F.col(b)).where(F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS).select(
            F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    links = scratch.save(near(met, "fp", "lead"), "links")
    roots = scratch.save(components(scratch, links), "roots")

    # keys of several components, without the first fingerprint: its pairs are done
    mine = met.where("fp <> lead").join(roots, met["fp"] == roots["node"], "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    mine = scratch.save(mine, "mine")
    parts = mine.groupBy("key", "root").agg(F.count("*").alias("n"))
    crossing = parts.groupBy("key").agg(F.expr("(pow(sum(n), 2) - sum(pow(n, 2))) / 2").alias("pairs"), F.count("*").alias("roots")).where("roots > 1")
    left = scratch.save(mine.join(crossing.select("key", "pairs"), "key"), "open")
    work = left.agg(F.count_distinct("fp").alias("n")).first()["n"]
    if work:
        pairs = left.groupBy("key").agg(F.first("pairs").alias("p")).agg(F.sum("p")).first()[0]
        if pairs <= pairs_per_node * work:
            x, y = left.select("key", F.col("fp").alias("x"), F.col("root").alias("rx")), left.select("key", F.col("fp").alias("y"), F.col("root").alias("ry"))
            more = near(x.join(y, "key").where("x < y AND rx <> ry"), "x", "y")
        else:
            mids = left.select("fp").distinct().mapInArrow(_midpoints, "mid long, fp long")
            first = mids.groupBy("mid").agg(F.min("fp").alias("lead"), F.count("*").alias("n")).where("n > 1").select("mid", "lead")
            more = near(mids.join(first, "mid"), "fp", "lead")
        more = scratch.save(more, "more")
        roots = scratch.save(components(scratch, links.union(more)), "roots")
    return roots


def simhash_components(docs: DataFrame, k: int = 4, *, pairs_per_node: float = PAIRS_PER_NODE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs (doc_id, text)``.

    Texts are lower-cased (A-Z), shingles are k words, repeats included; a text
    of fewer words, but one, is one shingle, and one without words or a null
    text has fingerprint zero and links like any other. Fingerprints link at
    four or fewer differing bits. ``component_id`` is the smallest doc_id
    reachable by links. A row without a doc_id takes part and gets the smallest
    id of its component, null where there is none. Repeated rows are repeated;
    other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "golay-simhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = scratch.save(docs.mapInArrow(_fingerprints(k), "doc_id long, fp long"), "marked")
    nodes = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "nodes")
    roots = linked_components(nodes, scratch, pairs_per_node)
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    member = member.join(named, "root").select("fp", "component_id")
    out = marked.join(member, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return scratch.finish(out)
