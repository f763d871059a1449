"""Token counts of whole texts by a sentencepiece BPE model, with a whole-token shortcut.

What is proved offline, from the model file alone, when a worker loads it:

* No piece has a space mark after another character (``splits_at_spaces``). A
  merge can then never reach over the place where a space follows something
  else, so a text is counted as the sum over its *pre-tokens*: each maximal
  run of spaces with the characters up to the next space.
* For each piece ``mark + w``, the library is asked once whether ``w`` encodes
  to exactly that one token (``whole``). A pre-token in that set counts 1 and
  is never merged.

Only the remaining distinct pre-tokens of a block of texts go through the
library's merges, once each while they stay in the worker's bounded cache. A
text with a space mark of its own, or any text where the proof fails for the
model, goes through the library whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.packing import blocks

LIMIT = 4096
MARK = "▁"
CACHE_WORDS, CACHE_BYTES = 500_000, 64
#: Bytes of texts handled at once.
BLOCK = 1 << 19
_RUNS = re.compile(rb" *[^ ]+| +")


class Counter:
    """Counts equal to ``len(encode(text))`` of the library, without begin, end or other added tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [i for i in range(len(pieces)) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) or self.model.is_byte(i))]
        self.splits_at_spaces = self._adds_and_keeps_spaces() and not any(MARK in pieces[i].lstrip(MARK) for i in plain)
        words = [(i, pieces[i][1:]) for i in plain if pieces[i].startswith(MARK) and len(pieces[i]) > 1 and MARK not in pieces[i][1:]]
        encoded = self.model.encode([w for _, w in words], num_threads=1)
        self.whole = {w.encode(): 1 for (i, w), ids in zip(words, encoded, strict=True) if ids == [i]} if self.splits_at_spaces else {}
        self.whole[b""] = 1  # a lone space mark at the end
        self.young, self.old = dict(self.whole), {}

    def _adds_and_keeps_spaces(self) -> bool:
        """One space mark goes before the text, and no space or character is folded away."""
        probe = "a  b ééａ \n\tc "
        return self.model.decode(self.model.encode(probe)) == probe and len(self.model.encode("  ", out_type=str)) >= 1 \
            and "".join(self.model.encode(" a", out_type=str)) == MARK * 2 + "a"

    def count(self, texts: list[bytes]) -> list[int]:
        """The counts of some texts; b"" has none."""
        if not self.splits_at_spaces:
            return [len(x) for x in self.model.encode([t.decode() for t in texts], num_threads=1)]
        mark, split, aside = MARK.encode(), [], {}
        for i, t in enumerate(texts):
            if mark in t:
                aside[i] = len(self.model.encode(t.decode()))
                split.append([])
            elif b"  " in t or t[:1] == b" " or t[-1:] == b" ":
                # the mark that goes before the text is the first space of the first run
                split.append([u[1:] for u in _RUNS.findall(b" " + t)])
            else:
                split.append(t.split(b" ") if t else [])
        distinct = set().union(*split)
        unknown = distinct.difference(self.young)
        if unknown and len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, dict(self.whole)
            unknown = distinct.difference(self.young)
        if unknown:
            self.young.update([(w, self.old[w]) for w in unknown if w in self.old])
            new = [w for w in unknown if w not in self.young]
            self.young.update(zip(new, map(len, self.model.encode([w.decode() for w in new], num_threads=1)), strict=True))
        out = [aside[i] if i in aside else sum(map(self.young.__getitem__, s)) for i, s in enumerate(split)]
        for w in unknown:
            if len(w) > CACHE_BYTES:
                del self.young[w]
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's own counter of a model file, kept for its next task."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def _counted(path: str):
    def run(batches):
        c = counter(path)
        for batch in batches:
            counts = [n for _, texts in blocks(batch.column(1), BLOCK) for n in c.count(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.array(counts, np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs(doc_id, text)``.

    A null or empty text has no bytes and no tokens. Repeated rows and rows
    without an id are counted like others; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return docs.mapInArrow(_counted(path), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
