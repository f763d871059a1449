"""Log-likelihood of whole documents by a gated recurrent language model in numpy.

**Counts** of all tokens of all training documents are taken by Spark. The
``TOP`` most frequent are the model's words, in classes of ``CLASS`` by rank;
all others belong to one tail class and share its mass by their counts, so
every text, unknown tokens included, has a probability.

**Model**: a gated recurrent unit (Cho et al., 2014) of ``HIDDEN`` units whose
output is factored: P(class | state) * P(word | class, state). Biases start as
the corpus's log counts, so training begins at the unigram model.

**Training**: every training document takes part. Each task trains a replica
on its share by backpropagation truncated to windows of ``STEPS`` tokens, the
state being carried over; its first tokens run in few lanes and the others in
many at a higher rate. The replicas' weights are averaged by Spark and the
next round starts from there. Only one set of weights (about
``2 * TOP * HIDDEN`` numbers) ever reaches the driver.

**Scoring**: documents run in lanes side by side, window after window; the
state is carried across windows from a document's first token to its end, so
the sum is the likelihood of the complete text. Counts of the ``HEAD`` most
frequent tokens are broadcast (a fixed bound); the rest of a document's tokens
are joined with the count table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm import words
from quillrank.llm.common import Scratch, largest, magnitude
from quillrank.llm.toxicity import held_out

TOP, CLASS, HEAD = 2048, 64, 1 << 18
HIDDEN, STEPS, LANES = 16, 32, 512
#: Lanes and learning rate of a replica's first WARM tokens, when many small steps matter, and after them.
WARM, WARM_LANES, TRAIN_LANES = 1 << 18, 32, 128
ROUNDS, RATE, WIDE_RATE = 2, 0.01, 0.02
#: Tokens that are dealt to lanes at once: so many that the longest documents don't leave most lanes empty.
COUNT_BLOCK, SCORE_TOKENS, WARM_TOKENS, TRAIN_TOKENS, SEED = 1 << 21, 1 << 21, 1 << 17, 1 << 22, 5
#: Weights that Adam works on at once: what they need fits the processor's own cache.
ADAM = 1 << 14
#: The end of a document as a token; no word is empty.
END = words.mix(np.array([1], np.uint64))[0]
LN10 = float(np.log(10))


# ------------------------------------------------------------------ tokens
def _tokens(block: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block's rows, each row followed by END; and where rows begin."""
    at = block.row + np.arange(len(block.row))
    out = np.full(at[-1], END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[at[1:] - 1] = False
    out[keep] = block.hash[block.row[0] : block.row[-1]]
    return out, at


def _count(batches):
    held, size = [], 0

    def flush():
        h, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    for batch in batches:
        for _, block in words.scan(batch.column(0), lower=True):
            held.append(_tokens(block)[0])
            size += len(held[-1])
            if size >= COUNT_BLOCK:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


class Vocabulary:
    """The HEAD tokens with their counts and ids; id ``top`` is the tail."""

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, kinds: int):
        """``h`` and ``c`` by falling count; ``total`` tokens of ``kinds`` kinds in all."""
        self.total, self.kinds, self.top = total, kinds, min(TOP, len(h))
        self.top_counts = c[: self.top].astype(float)
        self.tail = total - int(c[: self.top].sum()) + (kinds - self.top) + 1  # mass that tail tokens share: count + 1 each, and 1 for the unknown
        self.head, self.words = Places(h), Places(h[: self.top])
        order = self.head.order
        self.log, self.id = np.log10(c[order] + 1.0), np.minimum(order, self.top).astype(np.int32)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id of each token, and log10(count + 1); -1 in the latter where it is not of the HEAD."""
        if not len(self.id):
            return np.full(len(tokens), self.top, np.int32), np.full(len(tokens), -1.0)
        at, hit = self.head.find(tokens)
        return np.where(hit, self.id[at], self.top).astype(np.int32), np.where(hit, self.log[at], -1.0)

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        """Id of each token alone: only the model's words are looked up, a table that the processor's own cache holds."""
        if not self.top:
            return np.full(len(tokens), self.top, np.int32)
        at, hit = self.words.find(tokens)
        return np.where(hit, self.words.order[at], self.top).astype(np.int32)


class Places:
    """Where 64-bit hashes lie among sorted ones."""

    def __init__(self, h: np.ndarray):
        self.order = np.argsort(h)
        self.hash = h[self.order]
        bits = max(1, len(h).bit_length() + 1)  # hashes are spread evenly, so their first bits lead to the place or just before it
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hash, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token, and whether it is there at all. There must be hashes."""
        at, end = self.first[tokens >> self.shift], len(self.hash)
        found = self.hash[np.minimum(at, end - 1)]
        low = np.flatnonzero(found < tokens)
        while len(low):
            at[low] += 1
            low = low[at[low] < end]
            found[low] = self.hash[at[low]]
            low = low[found[low] < tokens[low]]
        return np.minimum(at, end - 1), found == tokens


# ------------------------------------------------------------------ model
def classes(top: int) -> int:
    return -(-top // CLASS)


def shapes(top: int) -> dict[str, tuple[int, ...]]:
    """Weights; ids top and top + 1 are the tail token and the start."""
    h = HIDDEN
    return {"E": (top + 2, h), "W": (h, 3 * h), "U": (h, 3 * h), "b": (3 * h,), "Wc": (h, classes(top) + 1), "bc": (classes(top) + 1,), "Ww": (h, top), "bw": (top,)}


def start(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    rng, top = np.random.default_rng(SEED), vocabulary.top
    m = {k: np.zeros(s, np.float32) for k, s in shapes(top).items()}
    m["E"] = rng.normal(0, 0.3, m["E"].shape).astype(np.float32)
    m["W"] = rng.normal(0, 0.3, m["W"].shape).astype(np.float32)
    m["U"] = rng.normal(0, 0.3, m["U"].shape).astype(np.float32)
    m["b"][:HIDDEN] = 1.0  # states last at first
    m["bw"] = np.log(vocabulary.top_counts + 1).astype(np.float32)
    mass = [vocabulary.top_counts[k * CLASS : (k + 1) * CLASS].sum() + 1 for k in range(classes(top))]
    m["bc"] = np.log(np.array([*mass, vocabulary.tail], float)).astype(np.float32)
    m["bc"] -= m["bc"].max()
    return m


def flat(m: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([m[k].ravel() for k in m])


def unflat(v: np.ndarray, top: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes(top).items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _gates(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """W with b, and U, a unit a row, negative where a sigmoid follows: what it needs is exp(-x)."""
    sign = np.ones((3 * HIDDEN, 1), m["U"].dtype)
    sign[: 2 * HIDDEN] = -1
    return np.vstack([m["W"], m["b"]]).T * sign, m["U"].T * sign


def _inputs(m: dict[str, np.ndarray]) -> np.ndarray:
    """E, each row with a 1 for the biases."""
    return np.hstack([m["E"], np.ones((len(m["E"]), 1), m["E"].dtype)])


class Window:
    """What :func:`forward` keeps of a window, (steps, units, lanes) each, so that each gate of a step is one run of memory."""

    def __init__(self, steps: int, lanes: int, dtype, learn: bool):
        kept = steps if learn else 1  # of all but the states; without learning, each step's takes the place of the last one's
        self.states, self.before, self.c = (np.empty((k, HIDDEN, lanes), dtype) for k in (steps, kept, kept))
        self.gates = np.empty((kept, 3 * HIDDEN, lanes), dtype)  # z, r, and what c has of the state before r
        self.resets = {}


def forward(read: np.ndarray, u: np.ndarray, resets: np.ndarray, h: np.ndarray, learn: bool) -> tuple[np.ndarray, Window]:
    """Last state and all of a window: ``read`` (steps, 3 * units, lanes) is what the inputs give the gates, ``u`` as
    :func:`_gates` gives it. ``resets`` (steps, lanes) clear a lane's state ``h`` (units, lanes)."""
    n, w = HIDDEN, Window(*resets.shape, read.dtype, learn)
    some = resets.any(1)
    with np.errstate(over="ignore"):  # 1 / (1 + inf) is the 0 it should be
        for t, a in enumerate(read):
            k = t if learn else 0
            before, g, c, state = w.before[k], w.gates[k], w.c[k], w.states[t]
            before[:] = h
            if some[t]:
                before[:, resets[t]] = 0
                w.resets[t] = resets[t]
            np.dot(u, before, out=g)
            zr = g[: 2 * n]
            zr += a[: 2 * n]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[n:], g[2 * n :], out=c)
            c += a[2 * n :]
            np.tanh(c, out=c)
            np.subtract(before, c, out=state)
            state *= zr[:n]
            state += c
            h = state
    return h, w


def _soft(logits, at: np.ndarray, learn: bool, void=None):
    """Natural log of the softmax of each row of ``logits()`` at one of its columns, 1 / its sum, and the exponentials.

    With ``learn``, instead of these the gradient of -log, times the sum. ``void`` are places that count for nothing.
    """
    place = None
    for safe in (False, True):
        x = logits()
        if safe:
            x -= x.max(1, keepdims=True)
        if place is None:
            place = np.arange(len(x)) * x.shape[1] + at
        flat_x = x.reshape(-1)
        mine = flat_x[place]
        with np.errstate(over="ignore"):
            np.exp(x, out=x)
            if void is not None:
                x[void] = 0
            total = x @ np.ones(x.shape[1], x.dtype)
        if not len(total) or (total.max() < 1e26 and total.min() > 1e-26):
            break  # else the exponentials were too large or too small
    lp = (mine - np.log(total)).astype(np.float64)
    if learn:
        flat_x[place] -= total
    return lp, (1 / total)[:, None], x


def output(m: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray, grads: dict[str, np.ndarray] | None = None):
    """Natural log probability of each target given its state (the last axis), both factors; with ``grads`` also d(-sum)/d(state)."""
    n, top, learn = HIDDEN, m["Ww"].shape[1], grads is not None
    cls = np.where(targets < top, targets // CLASS, classes(top)).astype(np.int16)
    rows = np.ones((*states.shape[:-1], n + 1), states.dtype)  # the 1 is for the biases
    rows[..., :n] = states
    rows = rows.reshape(-1, n + 1)
    weights = np.vstack([m["Wc"], m["bc"]])
    lp, share, x = _soft(lambda: rows @ weights, cls, learn)
    back = None
    if learn:
        g = x.T @ (rows * share)
        grads["Wc"] += g[:, :n].T
        grads["bc"] += g[:, n]
        back = x @ m["Wc"].T
        back *= share
    order = np.argsort(cls, kind="stable")  # a class's targets side by side; the tail has no second factor
    edges = np.searchsorted(cls, np.arange(classes(top) + 1), sorter=order)
    order = order[: edges[-1]]
    if not len(order):
        return lp, back
    rows, weights = rows[order], np.empty((classes(top) * CLASS, n + 1), states.dtype)
    weights[:top, :n], weights[:top, n], weights[top:, :n], weights[top:, n] = m["Ww"].T, m["bw"], m["Ww"][:, -1], m["bw"][-1]
    spans = [(slice(edges[k], edges[k + 1]), slice(k * CLASS, (k + 1) * CLASS)) for k in np.flatnonzero(np.diff(edges)).tolist()]

    def logits():
        x = np.empty((len(order), CLASS), states.dtype)
        for mine, span in spans:
            np.dot(rows[mine], weights[span].T, out=x[mine])
        return x

    void = (slice(edges[-2], None), slice(top - (classes(top) - 1) * CLASS, None)) if top % CLASS else None
    more, share, x = _soft(logits, targets[order] % CLASS, learn, void)
    lp[order] += more
    if learn:
        rows *= share
        g, back_too, plain = np.zeros_like(weights), np.empty((len(order), n), states.dtype), weights[:, :n].copy()
        for mine, span in spans:
            np.dot(x[mine].T, rows[mine], out=g[span])
            np.dot(x[mine], plain[span], out=back_too[mine])
        grads["Ww"] += g[:top, :n].T
        grads["bw"] += g[:top, n]
        back_too *= share
        back[order] += back_too
    return lp, back


def backward(m, inputs, embedded: np.ndarray, w: Window, dstates: np.ndarray, grads) -> None:
    """Backpropagation through one window; the gradient stops at its first step. ``dstates`` is overwritten.

    Only what a step has of the later ones is computed step by step; all else before or after, for the whole window.
    """
    n = HIDDEN
    z, r, un = w.gates[:, :n], w.gates[:, n : 2 * n], w.gates[:, 2 * n :]
    keep = 1 - z
    to_c = w.c * w.c
    np.subtract(1, to_c, out=to_c)
    to_c *= keep
    steps, lanes = inputs.shape
    da = np.empty((steps, 3 * n, lanes), dstates.dtype)  # first what to multiply the state's gradient with
    du = da.reshape(steps, 3, n, lanes)
    np.subtract(w.before, w.c, out=du[:, 0])
    du[:, 0] *= z
    du[:, 0] *= keep
    np.multiply(to_c, r, out=du[:, 2])
    np.multiply(du[:, 2], un, out=du[:, 1])
    np.subtract(1, r, out=keep)
    du[:, 1] *= keep
    dh, through = np.zeros((n, lanes), dstates.dtype), np.empty((n, lanes), dstates.dtype)
    for t in range(steps - 1, -1, -1):
        here, of = dstates[t], du[t]
        here += dh
        of *= here
        np.dot(m["U"], da[t], out=dh)
        np.multiply(here, z[t], out=through)
        dh += through
        if t in w.resets:
            dh[:, w.resets[t]] = 0
    grads["U"] += np.matmul(da, w.before.transpose(0, 2, 1)).sum(0).T
    np.multiply(dstates, to_c, out=du[:, 2])  # as the inputs have it, without r
    both = np.matmul(da, embedded).sum(0).T
    grads["W"] += both[:-1]
    grads["b"] += both[-1]
    # the rows of an input's own, summed at once: words run by run, the many of the tail and the starts as products
    flat_in, top = inputs.ravel(), len(m["E"]) - 2
    order = np.argsort(flat_in.astype(np.int16) if len(m["E"]) < 1 << 15 else flat_in, kind="stable")
    ordered, rows = flat_in[order], np.matmul(da.transpose(0, 2, 1), m["W"].T).reshape(-1, n)[order]
    tail, first = np.searchsorted(ordered, [top, top + 1])
    grads["E"][top] += np.ones(first - tail, rows.dtype) @ rows[tail:first]
    grads["E"][top + 1] += np.ones(len(rows) - first, rows.dtype) @ rows[first:]
    begin = np.flatnonzero(np.diff(ordered[:tail], prepend=-1))
    if len(begin):
        grads["E"][ordered[begin]] += np.add.reduceat(rows[:tail], begin, axis=0)


def lanes(lengths: np.ndarray, n: int) -> list[list[int]]:
    """Documents dealt to at most n lanes, longest first to the shortest lane; lanes by falling length."""
    heap = [(0, i) for i in range(min(n, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable"):
        size, i = heapq.heappop(heap)
        out[i].append(int(d))
        heapq.heappush(heap, (size + int(lengths[d]), i))
    return sorted(out, key=lambda ds: -int(lengths[ds].sum()))


def windows(size: np.ndarray):
    """Windows over lanes of falling ``size`` that lie one after another: live lanes, places, and which are valid (None: all).

    Arrays are (steps, lanes); lanes that have ended are left out of later windows.
    """
    offset, last = np.cumsum(size) - size, int(size.sum()) - 1
    for t in range(0, int(size[0]) if len(size) else 0, STEPS):
        live = int(np.searchsorted(-size, -t, side="left"))
        step = np.arange(t, min(t + STEPS, int(size[0])))[:, None]
        where = offset[:live] + step
        if size[live - 1] > step[-1, 0]:
            yield live, where, None
        else:
            yield live, np.minimum(where, last, out=where), step < size[:live]


def run_windows(m, ids: np.ndarray, at: np.ndarray, n: int, learn=None) -> np.ndarray:
    """Log probability of every token of documents ``ids[at[d]:at[d + 1]]``, run in n lanes; ``learn(grads, tokens)`` changes m after each window."""
    top = m["Ww"].shape[1]
    dealt = lanes(np.diff(at), n)
    place = np.concatenate([np.arange(at[d], at[d + 1]) for ds in dealt for d in ds])  # lane after lane
    targets, begins = ids[place], np.zeros(len(ids), bool)
    begins[at[:-1]] = True
    before = np.concatenate([targets[:1], targets[:-1]])
    before[begins[place]] = top + 1
    lp, out = np.empty(len(ids)), np.empty(len(ids))
    h = np.zeros((HIDDEN, len(dealt)), m["E"].dtype)
    (w, u), table = _gates(m), _inputs(m)
    grads = {k: np.empty_like(v) for k, v in m.items()}
    for live, where, valid in windows(np.array([sum(int(at[d + 1] - at[d]) for d in ds) for ds in dealt])):
        inputs = before[where]
        if valid is not None:
            inputs = np.where(valid, inputs, top)
        mine = where.ravel() if valid is None else where[valid]
        embedded = table[inputs]
        read = np.matmul(w, embedded.transpose(0, 2, 1))
        h, kept = forward(read, u, inputs == top + 1, h[:, :live], learn is not None)
        states = kept.states.transpose(0, 2, 1)
        if valid is not None:
            states = states[valid]
        if learn is None:
            lp[mine] = output(m, states, targets[mine])[0]
            continue
        for g in grads.values():
            g.fill(0)
        lp[mine], back = output(m, states, targets[mine], grads)
        if valid is None:
            dstates = back.reshape(*inputs.shape, HIDDEN)
        else:
            dstates = np.zeros((*inputs.shape, HIDDEN), back.dtype)
            dstates[valid] = back
        backward(m, inputs, embedded, kept, dstates.transpose(0, 2, 1).copy(), grads)
        learn(grads, len(mine))
        (w, u), table = _gates(m), _inputs(m)
    out[place] = lp
    return out


class Adam:
    """Adam (Kingma and Ba, 2015) on mean gradients, clipped."""

    def __init__(self, m: dict[str, np.ndarray], rate: float):
        self.m, self.rate, self.t = m, rate, 0
        self.a, self.v = (np.zeros_like(flat(m)) for _ in range(2))

    def __call__(self, grads: dict[str, np.ndarray], n: int) -> None:
        self.t += 1
        g = flat(grads)
        norm = np.sqrt(float(g @ g)) / n
        g *= g.dtype.type(min(1.0, 1.0 / max(norm, 1e-9)) / n)
        for k in range(0, len(g), ADAM):
            p, a, v = g[k : k + ADAM], self.a[k : k + ADAM], self.v[k : k + ADAM]
            a *= 0.9
            v *= 0.99
            a += 0.1 * p
            p *= p
            p *= 0.01
            v += p
            np.multiply(v, 1 / (1 - 0.99**self.t), out=p)
            np.sqrt(p, out=p)
            p += 1e-8
            np.divide(a, p, out=p)
            p *= self.rate / (1 - 0.9**self.t)
        at = 0
        for w in self.m.values():
            w -= g[at : at + w.size].reshape(w.shape)
            at += w.size


# ------------------------------------------------------------------ Spark
def _train(vocabulary, weights, rate: float):
    """One replica per task, its weights as (i, w) with the number of tokens it saw; ``rate`` multiplies the rates."""
    def run(batches):
        v = vocabulary.value
        m = unflat(weights.value, v.top)
        learn, seen, done = Adam(m, RATE * rate), 0, 0
        ids, ends = [], [0]

        def fit():
            learn.rate = (RATE if done < WARM else WIDE_RATE) * rate
            run_windows(m, np.concatenate(ids), np.array(ends), WARM_LANES if done < WARM else TRAIN_LANES, learn)

        for batch in batches:
            for _, block in words.scan(batch.column(0), lower=True):
                tokens, at = _tokens(block)
                ids.append(v.ids(tokens))
                seen += len(tokens)
                ends += (ends[-1] + at[1:]).tolist()
                if ends[-1] >= (WARM_TOKENS if done < WARM else TRAIN_TOKENS):
                    fit()
                    done, ids, ends = seen, [], [0]
        if ids:
            fit()
        if seen:
            w = flat(m).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w), dtype=np.int32)), pa.array(w * seen), pa.array(np.full(len(w), seen, np.int64))], ["i", "w", "n"])

    return run


SCORED = ("row long, doc_id long, n_tokens long, n_known long, top_log double, tail_log double, n_tail long, lp double, "
          "rest array<long>, rest_n array<int>")


def _score(vocabulary, weights):
    def run(batches):
        v = vocabulary.value
        m = unflat(weights.value, v.top)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            held, size = [], 0
            for first, block in words.scan(batch.column(1), lower=True):
                held.append((first, *_tokens(block)))
                size += len(held[-1][1])
                if size >= SCORE_TOKENS or first + len(block) == batch.num_rows:
                    begin = held[0][0]
                    yield _scored(v, m, row + begin, batch.column(0).slice(begin, first + len(block) - begin), held)
                    held, size = [], 0
            row += batch.num_rows

    return run


def _scored(v: Vocabulary, m, row: int, doc_ids: pa.Array, held: list) -> pa.RecordBatch:
    tokens = np.concatenate([t for _, t, _ in held])
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(a) for *_, a in held]))])
    ids, logs = v.find(tokens)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    lp = run_windows(m, ids, at, LANES)
    per = lambda w: np.bincount(doc, weights=w, minlength=len(at) - 1)
    tail, known = ids == v.top, logs >= 0
    rest = ~known
    n, rest_h, rest_doc = len(at) - 1, tokens[rest], doc[rest]
    order = np.lexsort((rest_h, rest_doc))
    rest_h, rest_doc = rest_h[order], rest_doc[order]
    new = np.ones(len(rest_h), bool)
    new[1:] = (rest_h[1:] != rest_h[:-1]) | (rest_doc[1:] != rest_doc[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(rest_h))).astype(np.int32)
    offsets = pa.array(np.searchsorted(rest_doc[begin], np.arange(n + 1)).astype(np.int32))
    columns = [pa.array(row + np.arange(n)), doc_ids, pa.array(np.diff(at)), pa.array(per(known).astype(np.int64)), pa.array(per(np.where(known & ~tail, logs, 0))),
               pa.array(per(np.where(known & tail, logs, 0))), pa.array(per(tail).astype(np.int64)), pa.array(per(lp)),
               pa.ListArray.from_arrays(offsets, pa.array(rest_h[begin].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(count))]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])


def train(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Averaged weights after ROUNDS rounds over ``texts(text)``, one replica per split."""
    context = texts.sparkSession.sparkContext
    weights, shared = flat(start(vocabulary)), context.broadcast(vocabulary)
    for k in range(ROUNDS):
        mean = texts.mapInArrow(_train(shared, context.broadcast(weights), 1 / 2**k), "i int, w double, n long")
        got = mean.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).orderBy("i").toArrow()
        weights = got["w"].to_numpy().astype(np.float32) if got.num_rows else weights
    return weights


def document_scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs(doc_id, text)``.

    Held out are rows whose id's crc32 as text is 2 modulo 7; all others (rows
    without an id too) are learned from. A null or empty text is its end token
    alone. Repeated rows count as often as they occur and are scored alike.
    Other columns are ignored. Without training rows every score is 0.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "gated-lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = docs.where(~held_out(F.col("doc_id"), 7, 2))
    counts = scratch.save(learned.select("text").mapInArrow(_count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = largest(counts, magnitude(F.col("c")), HEAD, "h").toArrow()
    h, c = head["h"].to_numpy().view(np.uint64), head["c"].to_numpy()
    order = np.lexsort((h, -c))
    vocabulary = Vocabulary(h[order], c[order], int(whole["n"]), int(whole["v"]))

    weights = train(learned.select("text"), vocabulary)
    share = spark.sparkContext.broadcast
    scored = scratch.save(docs.mapInArrow(_score(share(vocabulary), share(weights)), SCORED), "scored", compression="zstd")

    rest = scored.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("r")).select("row", F.col("r.rest").alias("h"), F.col("r.rest_n").alias("k"))
    rest = rest.join(counts, "h").groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("rest_log"), F.sum("k").alias("rest_known"))
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    base = F.col("top_log") + F.col("tail_log") + rest_log - F.col("n_tokens") * float(np.log10(vocabulary.total + vocabulary.kinds + 1))
    model = F.col("lp") / LN10 + F.col("tail_log") + rest_log - F.col("n_tail") * float(np.log10(vocabulary.tail))
    out = scored.drop("rest", "rest_n").join(rest, "row", "left")
    return out.select("doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
                      F.lit(vocabulary.total).cast("long").alias("train_tokens"), base.alias("base_score"), model.alias("score"))
