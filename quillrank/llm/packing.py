"""Concatenate and cut: documents packed into fixed windows of tokens.

Two passes of prefix sums. The first tokenizes: each task writes its
documents' ids with their offset among the task's own tokens. The tasks'
totals (one number per task, the only thing on the driver) summed up give
every task its global offset. The second pass cuts the one long token stream
at every multiple of the window; a document that crosses a cut gives a
boundary record for each window it touches. Nothing but the last window needs
padding, no row is shuffled, and no task holds more than one batch.

The token table is written to the shared folder before the second pass, so a
task run anew after a lost executor reads the same offsets.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import Scratch

WINDOW, END = 2048, 1
#: Words whose ids a worker keeps at most, those last met; longer words are not kept.
CACHE_WORDS, CACHE_BYTES = 300_000, 64
_PUNCTUATION = b"!\"#$%&()*+,-./:;=>?@[]^_`{}~"  # no apostrophe, and nothing that begins a special token
#: Unknown words encoded in one call, and bytes of texts handled at once.
CALL_WORDS, BLOCK = 4096, 1 << 22


def cuts_at_spaces(path: str) -> bool:
    """Whether a tokenizer file provably encodes a text as its space-separated words one by one.

    True if nothing in it can join or see across ASCII white space: NFC, lower
    casing and folding of white space as the only normalizers, a splitter that
    drops what its pattern doesn't match, with a pattern that matches no white
    space, and added tokens without white space.
    """
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    norms = t["normalizer"] or {}
    norms = norms.get("normalizers", [norms]) if norms else []
    calm = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " " for n in norms)
    pre = t["pre_tokenizer"] or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    split = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "\\s" not in first["pattern"].get("Regex", "\\s").replace("[^\\s", "")
    rest = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in steps[1:])
    split = split and "." not in first["pattern"]["Regex"] and " " not in first["pattern"]["Regex"]
    added = all(not any(c.isspace() for c in a["content"]) for a in t["added_tokens"])
    return bool(calm and split and rest and added and t["post_processor"] is None and t["truncation"] is None and t["padding"] is None)


def _bytes_of() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write bytes with (a published mapping)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merges_alone(path: str) -> bool:
    """Whether every merged token of a byte-level BPE file with word ends, merged alone, ends up as that token.

    Then adjacent tokens whose joined text is a token are always the pair that
    the file merges: where the token's ends have stayed boundaries, its inside
    has merged as it does alone. So merging by the rank of the joined text, as
    rank-based libraries do, gives the file's own result. Also false where two
    merges give one text, since there is no rank by text then.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("dropout") or model.get("ignore_merges"):
        return False
    rank = {tuple(m): i for i, m in enumerate(model["merges"])}
    if len({a + b for a, b in rank}) != len(rank):
        return False
    for a, b in rank:
        z = a + b
        word, end = (z[:-4], "</w>") if z.endswith("</w>") else (z, "")
        parts = [*word[:-1], word[-1] + end]
        while len(parts) > 1:
            r, i = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if r == len(rank):
                return False
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return True


class PlainWords:
    """Ids of words of small Latin letters by a rank-based library; exact where :func:`merges_alone` holds."""

    #: Stands for the end of a word in the ranks; no plain word has it.
    STOP = "\0"

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte, stop = _bytes_of(), self.STOP.encode()

        def raw(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(byte[c] for c in token[: -4 if end else None]) + stop * end

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + stop: 256 + b for b in range(256) if b}
        ranks[stop + stop] = 256
        for i, (a, b) in enumerate(model["merges"]):
            ranks[raw(a) + raw(b)] = 512 + i
        ids = {raw(t): i for t, i in model["vocab"].items()}
        order = sorted(ranks, key=ranks.get)
        self.id = np.array([ids.get(t, 0) for t in order], "<u4")
        self.ends = np.array([t.endswith(stop) and len(t) > 1 for t in order])
        self.coder = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def plain(word: str) -> bool:
        """One pre-token that no normalizer changes: letters below U+0250, none of them capital."""
        return word.isalpha() and word == word.lower() and (word.isascii() or max(word) < "\u0250")

    def encode(self, found: list[str]) -> list[bytes]:
        ranks = np.array(self.coder.encode_ordinary(self.STOP.join(found) + self.STOP), np.int64)
        stops = ((np.flatnonzero(self.ends[ranks]) + 1) * 4).tolist()
        raw = self.id[ranks].tobytes()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]


def _ends_plainly(word: bytes) -> bool:
    """Whether a word's last character is a letter or digit: of ASCII, or a letter below U+0250."""
    if word[-1] < 128:
        return word[-1:].isalnum()
    last = word.decode()[-1]
    return last.isalpha() and last < "\u0250" and len(last.lower()) == 1  # a capital dotted I becomes two


class Kept:
    """Ids of at most ``CACHE_WORDS`` words, in arrays: about 30 bytes a word, where a dict of bytes takes 200."""

    def __init__(self):
        self.words, self.flat = pa.array([], pa.binary()), np.zeros(0, "<u4")
        self.start, self.size, self.used = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.clock = 0

    def find(self, words: pa.Array) -> np.ndarray:
        """Place of each word, -1 where it is not kept."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        self.used[at[at >= 0]] = self.clock
        return at

    def add(self, new: dict[bytes, bytes]) -> None:
        """Words that are not kept yet; those met longest ago make room."""
        new = {w: ids for w, ids in new.items() if len(w) <= CACHE_BYTES}
        size = np.fromiter(map(len, new.values()), np.int32, len(new)) // 4
        words = pa.concat_arrays([self.words, pa.array(list(new), pa.binary())])
        flat, size = np.concatenate([self.flat, np.frombuffer(b"".join(new.values()), "<u4")]), np.concatenate([self.size, size])
        used = np.concatenate([self.used, np.full(len(new), self.clock, np.int32)])
        self.clock += 1
        if len(words) > CACHE_WORDS:
            last = np.zeros(len(words), bool)
            last[np.argpartition(used, -CACHE_WORDS)[-CACHE_WORDS:]] = True
            words, flat, size, used = words.filter(pa.array(last)), flat[np.repeat(last, size)], size[last], used[last]
        self.words, self.flat, self.size, self.used = words, flat, size, used
        self.start = np.cumsum(size, dtype=np.int32) - size


class Encoder:
    """Token ids of texts, equal to the library's for the whole text.

    Where :func:`cuts_at_spaces` holds, each distinct word is encoded once and
    kept; unknown words of a block go to the library in one string, with one of
    the file's own special tokens between them. Otherwise texts are encoded whole.
    Only words that it has not kept go through a library at all.
    """

    def __init__(self, path: str, ranked: bool = False):
        """``ranked``: whether :func:`merges_alone` holds, so plain words need not go through the slower library."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept = Kept()
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.lstrip and not t.rstrip and not t.single_word]
        special = [s for s in special if s[0].startswith("<|")]
        others = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not t.content.startswith("<|")]
        self.mark, self.mark_id = special[-1] if special and not others and cuts_at_spaces(path) else (None, None)
        self.words = PlainWords(path) if ranked and self.mark is not None else None
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, unknown: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words without ``<|``, which begins every special token of the file."""
        mark, out = self.mark.encode(), {}
        if self.words:
            plain, others = [], []
            for w in unknown:
                (plain if PlainWords.plain(w.decode()) else others).append(w)
            if plain:
                out.update(zip(plain, self.words.encode([w.decode() for w in plain]), strict=True))
            unknown = others
        for at in range(0, len(unknown), CALL_WORDS):
            part = unknown[at : at + CALL_WORDS]
            ids = self._ids(mark.join(part).decode())
            cuts = np.flatnonzero(ids == self.mark_id)
            lo = (np.concatenate([[0], cuts + 1]) * 4).tolist()
            hi = (np.concatenate([cuts, [len(ids)]]) * 4).tolist()
            raw = ids.tobytes()
            out.update(zip(part, [raw[i:j] for i, j in zip(lo, hi)], strict=True))
        return out

    def _new(self, unknown: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not kept, and of their parts that are not."""
        # punctuation after a letter or digit is a pre-token of its own
        ends, parts, plain = [], set(), []
        for w in unknown:
            stem = w.rstrip(_PUNCTUATION)
            if stem and len(stem) < len(w) and _ends_plainly(stem):
                ends.append((w, stem, w[len(stem):]))
                parts.update(ends[-1][1:])
            else:
                plain.append(w)
        parts = list(parts.difference(plain))
        at = self.kept.find(pa.array(parts, pa.binary()))
        out = self._learn([*plain, *(w for w, i in zip(parts, at.tolist()) if i < 0)])
        known = {w: self.kept.flat[self.kept.start[i] : self.kept.start[i] + self.kept.size[i]].tobytes() for w, i in zip(parts, at.tolist()) if i >= 0}
        get = lambda w: known[w] if w in known else out[w]
        out.update([(w, get(stem) + get(tail)) for w, stem, tail in ends])
        return out

    def _known(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in one array, and each word's place and number there, of distinct words without special tokens.

        Where texts go whole the only word is the empty one.
        """
        if self.mark is None:
            return np.zeros(0, "<u4"), *np.zeros((2, len(distinct)), np.int32)
        at = self.kept.find(distinct)
        flat, start, size = self.kept.flat, np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
        hit, missing = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        start[hit], size[hit] = self.kept.start[at[hit]], self.kept.size[at[hit]]
        if len(missing):
            unknown = distinct.take(pa.array(missing)).to_pylist()
            new = self._new(unknown)
            pieces = [new[w] for w in unknown]
            size[missing] = np.fromiter(map(len, pieces), np.int32, len(pieces)) // 4
            start[missing] = len(flat) + np.cumsum(size[missing]) - size[missing]
            flat = np.concatenate([flat, np.frombuffer(b"".join(pieces), "<u4")])
            self.kept.add(new)
        return flat, start, size

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in one array, and how many each has; ``end`` comes after each text.

        Words are cut and made distinct by Arrow, so Python sees each distinct word of a
        block once and the ids are put together by whole-array arithmetic.
        """
        whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False) if self.mark is not None else np.ones(len(texts), bool)
        plain = pc.if_else(pa.array(~whole), texts, "")  # texts that may hold a special token go whole
        lists = pc.ascii_split_whitespace(pc.ascii_lower(plain) if self.mark is not None and self.lowers else plain)
        found = lists.flatten().dictionary_encode()
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        word = found.indices.to_numpy(zero_copy_only=False).copy()
        flat, start, size = self._known(found.dictionary.cast(pa.binary()))
        pieces = [flat]
        for i in np.flatnonzero(whole):
            word[at[i]] = len(size) + len(pieces) - 1
            pieces.append(self._ids(texts[int(i)].as_py()))
        if end is not None:
            word = np.insert(word, at[1:], len(size) + len(pieces) - 1)
            pieces.append(np.array([end], "<u4"))
            at = at + np.arange(len(at))
        more = np.array([len(p) for p in pieces], np.int32)
        flat, start, size = np.concatenate(pieces), np.concatenate([start, (np.cumsum(more) - more)[1:].astype(np.int32)]), np.concatenate([size, more[1:]])
        length = size[word]
        total = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        place = np.repeat(start[word] - total[:-1].astype(np.int32), length)
        place += np.arange(len(place), dtype=np.int32)
        return flat[place], np.diff(total[at])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian uint32 bytes."""
        out, n = self.ids(pa.array([t.decode() for t in texts], pa.string()))
        edges = np.concatenate([[0], np.cumsum(n)]) * 4
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str, ranked: bool) -> Encoder:
    """The worker's own encoder of a file, kept for its next task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, ranked)
    return _encoders[path]


def blocks(column: pa.Array, size: int):
    """``(first row, texts as bytes)`` in runs of about ``size`` bytes; a null text is an empty one."""
    first, held, n = 0, [], 0
    for i, t in enumerate(column):
        held.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
        n += len(held[-1])
        if n >= size:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


def spans(texts: pa.Array, size: int):
    """``(first, end)`` of runs of rows of about ``size`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield lo, hi
        lo = hi


TOKENS = "doc_id long, ids binary, doc_tokens long, part int, at long"


def _tokenize(path: str, ranked: bool):
    def run(batches):
        enc, part, at = encoder(path, ranked), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for lo, hi in spans(texts, BLOCK):
                ids, n = enc.ids(texts.slice(lo, hi - lo), END)
                pa.default_memory_pool().release_unused()  # else it keeps what the block's words took
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                edges = pa.py_buffer((np.concatenate([[0], np.cumsum(n)]) * 4).astype(np.int64).tobytes())
                column = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, edges, pa.py_buffer(ids.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), column, pa.array(n), pa.array(np.full(hi - lo, part, np.int32)), pa.array(before)],
                                                 ["doc_id", "ids", "doc_tokens", "part", "at"])

    return run


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _cut(bases, window: int):
    def run(batches):
        for batch in batches:
            doc, n = batch.column(0), batch.column(2).to_numpy()
            begin = bases.value[batch.column(3).to_numpy()] + batch.column(4).to_numpy()
            first, last = begin // window, (begin + n - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            seq = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces) + first[row]
            lo = np.maximum(begin[row], seq * window)
            hi = np.minimum((begin + n)[row], (seq + 1) * window)
            start, length = lo - begin[row], hi - lo
            ids = batch.column(1)
            for a in range(0, len(row), 4096):
                part = slice(a, a + 4096)
                raw = [ids[int(r)].as_buffer()[int(4 * s) : int(4 * (s + m))].to_pybytes() for r, s, m in zip(row[part], start[part], length[part])]
                yield pa.RecordBatch.from_arrays([doc.take(pa.array(row[part])), pa.array(start[part]), pa.array(length[part]), pa.array(raw, pa.binary()),
                                                  pa.array(n[row[part]]), pa.array(seq[part]), pa.array(lo[part] % window)], [c.split()[0] for c in PIECES.split(", ")])

    return run


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """The pieces of ``docs(doc_id, text)`` in sequences of ``window`` tokens: ``PIECES``.

    A document is its ids by the tokenizer at ``path``, then ``END``. ``ids``
    holds a piece's ids as little-endian uint32. A null or empty text is the
    single id ``END``. Repeated rows are documents of their own; a row without
    an id is packed with a null doc_id. Other columns are ignored; an empty
    table has no pieces. Sequences follow the input's order of splits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = scratch.save(docs.mapInArrow(_tokenize(path, merges_alone(path)), TOKENS), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect()
    each = np.zeros(max((r["part"] for r in totals), default=-1) + 1, np.int64)
    for r in totals:
        each[r["part"]] = r["n"]
    bases = spark.sparkContext.broadcast(np.cumsum(each) - each)
    return tokens.mapInArrow(_cut(bases, window), PIECES)
