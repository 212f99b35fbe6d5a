"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time.  Bytes select
rows of input tables; one gated recurrent layer reads the text forwards, one
backwards; every position gets label probabilities from both states.  The
probabilities of a document are the mean over its letter positions.

Prediction reads every byte of the text: it is cut into windows of ``WINDOW``
bytes, each read by both layers from a fresh state, many windows at a time, so
memory is bounded whatever the length.

Training rows are a bounded sample (``SAMPLE`` documents, or ``LABEL_ROWS`` for
each label if that is more, shared evenly among the languages by weighted hash
order; ``SAMPLE_CHARS`` characters of each, from a hashed place).  Every label is
learned; hidden units and training steps grow with their number.  Only text
and label are used; prediction sees the text alone.

Defined results: ``und`` with score 0 for a null, empty or letterless text and
where no labelled row exists; a null or unknown label is not learned; ties go
to the first label in sort order; repeated rows are predicted alike; empty
tables give empty results.  Columns of the input pass through
``annotate_language`` unless they have the name of a result column.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import annotate, utf8

HIDDEN = 8
WINDOW = 256
SAMPLE = 1600
SAMPLE_CHARS = 1500
LABEL_ROWS = 16
FEW_LABELS = 8
TRAIN_WINDOW = 64
BATCH = 384
STEPS = 200
RATE = 0.02
SEED = 11
BLOCK_WINDOWS = 2048
UNKNOWN = "und"

# Letter bytes: ASCII letters and all bytes of non-ASCII characters.
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


class Direction(NamedTuple):
    """One gated recurrent layer: input table (256 x 3h, biases included) and recurrent weights (h x 3h)."""

    table: np.ndarray
    inner: np.ndarray


class Model(NamedTuple):
    labels: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # 2h x labels
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(d: Direction, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """New state and what the gradient needs: update gate, reset gate, candidate, its recurrent part."""
    n = h.shape[1]
    a = d.table[x]
    g = h @ d.inner
    gates = _sigmoid(a[:, :2 * n] + g[:, :2 * n])
    z, r = gates[:, :n], gates[:, n:]
    u = g[:, 2 * n:]
    c = np.tanh(a[:, 2 * n:] + r * u)
    return c + z * (h - c), z, r, c, u


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _run(d: Direction, x: np.ndarray, order: range) -> tuple[np.ndarray, dict]:
    """States after each position (T x B x h) and the tape of the steps."""
    n = d.inner.shape[0]
    states = np.zeros((*x.shape, n), np.float32)
    h = np.zeros((x.shape[1], n), np.float32)
    tape = {}
    for t in order:
        before = h
        h, *rest = _step(d, x[t], before)
        tape[t] = (before, *rest)
        states[t] = h
    return states, tape


def _back(d: Direction, x: np.ndarray, order: range, tape: dict, dstates: np.ndarray) -> Direction:
    """Gradients of one layer by backpropagation through time."""
    n = d.inner.shape[0]
    dtable, dinner = np.zeros_like(d.table), np.zeros_like(d.inner)
    dh = np.zeros((x.shape[1], n), np.float32)
    da = np.zeros((*x.shape, 3 * n), np.float32)
    for t in reversed(order):
        before, z, r, c, u = tape[t]
        dh = dh + dstates[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (before - c) * z * (1 - z)
        dr = dc * u * r * (1 - r)
        da[t] = np.concatenate([dz, dr, dc], axis=1)
        dg = np.concatenate([dz, dr, dc * r], axis=1)
        dinner += before.T @ dg
        dh = dh * z + dg @ d.inner.T
    flat = da.reshape(-1, 3 * n)
    for k in range(3 * n):
        dtable[:, k] = np.bincount(x.ravel(), flat[:, k], 256)
    return Direction(dtable, dinner)


def loss_and_gradients(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the letter positions of windows x (T x B) with labels y, and its gradients."""
    ahead, astern = range(len(x)), range(len(x) - 1, -1, -1)
    f, ftape = _run(m.forward, x, ahead)
    b, btape = _run(m.backward, x, astern)
    both = np.concatenate([f, b], axis=2)
    p = _softmax(both @ m.out + m.bias)
    weight = _LETTER[x].astype(np.float32)
    weight /= max(1.0, weight.sum())
    at = np.arange(x.shape[1])
    loss = float(-(weight * np.log(p[:, at, y] + 1e-12)).sum())
    p[:, at, y] -= 1
    p *= weight[:, :, None]
    dout = np.einsum("tbh,tbl->hl", both, p)
    dboth = p @ m.out.T
    n = f.shape[2]
    df = _back(m.forward, x, ahead, ftape, dboth[:, :, :n])
    db = _back(m.backward, x, astern, btape, dboth[:, :, n:])
    return loss, [*df, *db, dout, p.sum(axis=(0, 1))]


def _weights(m: Model) -> list[np.ndarray]:
    return [*m.forward, *m.backward, m.out, m.bias]


def initial(labels: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    layers = [Direction(draw(256, 3 * hidden, scale=0.3), draw(hidden, 3 * hidden, scale=hidden**-0.5)) for _ in range(2)]
    return Model(labels, *layers, draw(2 * hidden, len(labels), scale=0.3), np.zeros(len(labels), np.float32))


def train(texts: list[str], langs: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED) -> Model:
    """Fit the network on random windows of the texts, labels drawn evenly (Adam, falling rate)."""
    labels = sorted(set(langs))
    model = initial(labels, hidden, seed)
    rng = np.random.default_rng(seed + 1)
    by_label = [[np.frombuffer(utf8(t), np.uint8) for t, g in zip(texts, langs, strict=True) if g == k] for k in labels]
    weights = _weights(model)
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        y = rng.integers(0, len(labels), BATCH)
        x = np.full((TRAIN_WINDOW, BATCH), 32, np.uint8)
        for k, label in enumerate(y):
            own = by_label[label]
            t = own[rng.integers(0, len(own))]
            at = rng.integers(0, max(1, len(t) - TRAIN_WINDOW + 1))
            part = t[at:at + TRAIN_WINDOW]
            x[:len(part), k] = part
        _, grads = loss_and_gradients(model, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * (1 - step / (steps + 1))
        for w, g, a, b in zip(weights, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


class _Reader:
    """One layer for prediction: states as h x B, so that every gate is one contiguous block."""

    def __init__(self, d: Direction, width: int):
        n = self.n = d.inner.shape[0]
        half = np.repeat(np.float32([0.5, 0.5, 1]), n)  # sigmoid(x) = (1 + tanh(x / 2)) / 2
        self.table = np.ascontiguousarray((d.table * half).T)
        self.inner = np.ascontiguousarray((d.inner * half).T)
        self.a, self.g = np.empty((2, 3 * n, width), np.float32)

    def step(self, x: np.ndarray, h: np.ndarray) -> None:
        """Advance the states h in place by the bytes x."""
        n, a, g = self.n, self.a, self.g
        np.take(self.table, x, axis=1, out=a, mode="clip")
        np.matmul(self.inner, h, out=g)
        gates, u, c = g[:2 * n], g[2 * n:], a[2 * n:]
        gates += a[:2 * n]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        u *= gates[n:]
        c += u
        np.tanh(c, out=c)
        h -= c
        h *= gates[:n]
        h += c


def pooled(m: Model, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities over the letter positions of each text (all bytes are read); zeros without letters."""
    sums, counts = np.zeros((len(texts), len(m.labels))), np.zeros(len(texts))
    windows = [(k, at) for k, t in enumerate(texts) for at in range(0, len(t), WINDOW)]
    windows.sort(key=lambda w: min(WINDOW, len(texts[w[0]]) - w[1]))  # windows of like length together
    n = m.forward.inner.shape[0]
    out_f, out_b = np.ascontiguousarray(m.out[:n].T), np.ascontiguousarray(m.out[n:].T)
    for low in range(0, len(windows), BLOCK_WINDOWS):
        part = windows[low:low + BLOCK_WINDOWS]
        owner = np.array([k for k, _ in part])
        raw = [texts[k][at:at + WINDOW] for k, at in part]
        length = np.array([len(r) for r in raw])
        high = int(length.max())
        x = np.ascontiguousarray(np.frombuffer(b"".join(r.ljust(high) for r in raw), np.uint8).reshape(-1, high).T)
        weight = (_LETTER[x] & (np.arange(high)[:, None] < length)).astype(np.float32)
        x = x.astype(np.intp)
        width = len(part)
        ahead, astern = _Reader(m.forward, width), _Reader(m.backward, width)
        h = np.zeros((n, width), np.float32)
        logits = np.empty((high, len(m.labels), width), np.float32)
        for t in range(high):
            ahead.step(x[t], h)
            np.matmul(out_f, h, out=logits[t])
        h[:] = 0
        total = np.zeros((len(m.labels), width), np.float32)
        p, bias = np.empty_like(total), m.bias[:, None].astype(np.float32)
        for t in range(high - 1, -1, -1):
            astern.step(x[t], h)
            if length[0] <= t:  # shortest first: the backward layer starts at each window's own end
                h *= length > t
            np.matmul(out_b, h, out=p)
            p += logits[t]
            p += bias
            np.exp(p, out=p)
            p *= weight[t] / p.sum(axis=0)
            total += p
        np.add.at(sums, owner, total.T)
        np.add.at(counts, owner, weight.sum(axis=0))
    return sums / np.maximum(counts, 1)[:, None]


def held_out(doc_id) -> F.Column:
    """True for one document in five by the checksum of its id (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(labelled: DataFrame, size: int = SAMPLE, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[str]]:
    """A bounded sample of (text, lang): weighted hash order gives each language about the same share.

    The labels are the model's outputs, so their counts, one row for each, come to the driver.
    """
    rows = labelled.where("text is not null and lang is not null").withColumn("h", F.xxhash64(*[F.col(f"`{c}`") for c in labelled.columns]))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return [], []
    size = max(size, LABEL_ROWS * len(counts))
    n = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, float(r.n))])
    u = (F.pmod(F.xxhash64("h"), F.lit(1 << 40)) + 1) / F.lit(float((1 << 40) + 1))
    # About x rows of each language lie below x, so the first filter leaves a few times ``size`` rows in all.
    low = 4.0 * size / len(counts) + 50
    keyed = rows.withColumn("order", -F.log(u) * n[F.col("lang")]).where(F.col("order") < low)
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    part = keyed.select("order", "h", F.substring("text", start, F.lit(chars)).alias("text"), "lang")
    got = part.orderBy("order", "h", "lang").limit(size).collect()
    return [r.text for r in got], [r.lang for r in got]


RESULT = "lang_pred string, score double"


def annotate_language(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows with lang_pred and score appended."""

    def make():
        def run(rows):
            for low in range(0, len(rows), 2000):
                texts = [t for (t,) in rows[low:low + 2000]]
                lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
                if model is None:
                    yield from ((UNKNOWN, 0.0) for _ in texts)
                    continue
                p = pooled(model, [utf8(t) if on else b"" for t, on in zip(texts, lettered, strict=True)])
                best = p.argmax(axis=1)
                for on, k, row in zip(lettered, best.tolist(), p, strict=True):
                    yield (model.labels[k], min(1.0, float(row[k]))) if on else (UNKNOWN, 0.0)
        return run

    return annotate(documents, make, ["text"], RESULT)


def fit(labelled: DataFrame, size: int = SAMPLE) -> Model | None:
    """Train on a bounded sample of labelled rows (text, lang); None without any."""
    texts, langs = sample(labelled, size)
    if not texts:
        return None
    more = max(0, len(set(langs)) - FEW_LABELS)
    return train(texts, langs, HIDDEN + more // 8, STEPS + 2 * more)
