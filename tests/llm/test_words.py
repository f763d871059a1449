"""Word scanning against bytes.split."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quillrank.llm import words


@pytest.mark.parametrize("size", [1, 50, 1 << 16])
def test_words_and_grams_match_split(monkeypatch, size):
    monkeypatch.setattr(words, "BLOCK", size)
    r = random.Random(3)
    texts = ["", None, " a b", "ab cd ab", "x y\x0b\x0cz", "A b", "\x1c\x85 q"] + ["".join(r.choice("ab \n\té \x0b") for _ in range(r.randint(0, 30))) for _ in range(400)]
    seen, rows = {}, 0
    for first, block in words.scan(pa.array(texts)):
        grams, at = block.grams(4)
        for i in range(len(block)):
            own = (texts[first + i] or "").encode().split()
            assert len(own) == len(block.of(i))
            want = [tuple(own[j : j + 4]) for j in range(len(own) - 3)] if len(own) >= 4 else [tuple(own)] * bool(own)
            got = grams[at[i] : at[i + 1]]
            assert len(want) == len(got)
            for a, b in [*zip(own, block.of(i)), *zip(want, got)]:
                assert seen.setdefault(a, b) == b
            rows += 1
    assert rows == len(texts) and len(set(map(int, seen.values()))) == len(seen)


def test_lower_case_is_ascii_only():
    (_, a), = words.scan(pa.array(["ABC É"]), lower=True)
    (_, b), = words.scan(pa.array(["abc É"]))
    assert np.array_equal(a.hash, b.hash)


def test_slices_and_empty_arrays():
    whole = pa.array(["skip", "a b", None, "c"])
    (_, part), = words.scan(whole.slice(1))
    (_, own), = words.scan(pa.array(["a b", "", "c"]))
    assert np.array_equal(part.hash, own.hash) and np.array_equal(part.row, own.row)
    assert list(words.scan(pa.array([], pa.string()))) == []
