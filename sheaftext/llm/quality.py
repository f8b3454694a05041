"""Document quality: a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence comes from counts of the line itself and of the lines before and after it
(capitals, digits, kinds of symbols, words that repeat, word and line length), cut into bins and weighted; two
more weights a pair of labels say how lines follow each other. Forward-backward gives each line's probability
of being good, and a document's quality is their mean, weighted by line length, through a final logistic
curve.

Weights are fitted to the labels of at most ``PER_CLASS`` labelled documents of either label, a documented bound,
whose lines take the label of the document; all documents are scored whole. Defined results: a null or empty text is
one empty line; without labels of both kinds the score is the share of good labels (1 without any labels).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, crc_mod_column, table
from sheaftext.llm.labelled import FOLDS, HELD_OUT, train, training_ids
from sheaftext.llm.toxicity import _logistic, _sigmoid
from sheaftext.llm.words import words

PER_CLASS = 2500
BINS = 6
ROUNDS = 120
RATE = 0.08
RIDGE = 1e-3
THRESHOLD = 0.5


def _class(*members: int) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(members)] = 1
    return out


_CLASSES = [
    _class(*range(48, 58)),
    _class(*b"!?"),
    _class(*b"*%$#&@^~"),
    _class(*b"|<>{}[]\\/_=+"),
    _class(*b".,;:'\"()-"),
    _class(*range(192, 256)),  # first bytes of letters beyond ASCII
]


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of every line, and each text's offsets of lines."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets)
    starts = np.insert(breaks + 1, before[:-1], offsets[:-1])
    ends = np.insert(breaks, before[1:], offsets[1:])
    return starts, ends, np.concatenate([[0], np.cumsum(np.diff(before) + 1)])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of every line, line lengths, and each text's offsets of lines."""
    starts, ends, at = lines_of(data, offsets)

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(float)

    size = (ends - starts).astype(float)
    lower = per_line((data >= 97) & (data <= 122))
    accented = np.zeros(len(data), bool)
    if len(data) > 1:
        accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    upper = per_line(((data >= 65) & (data <= 90)) | accented)
    columns = [upper / np.maximum(upper + lower, 1), *(per_line(c[data]) / np.maximum(size, 1) for c in _CLASSES)]
    w = words(data, offsets, fold=True)
    line = np.searchsorted(starts, w.starts, "right") - 1
    n = np.bincount(line, minlength=len(starts)).astype(float)
    same = np.zeros(len(w.hashes), bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((w.hashes, line))
    h, l = w.hashes[order], line[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (l[1:] == l[:-1])
    columns.append(np.bincount(line, same, minlength=len(starts)) / np.maximum(n, 1))
    columns.append(np.bincount(l, again, minlength=len(starts)) / np.maximum(n, 1))
    columns.append(np.bincount(line, w.ends - w.starts, minlength=len(starts)) / np.maximum(n, 1))
    columns.append(np.log1p(size))
    return np.stack(columns, axis=1), size + 1, at


def binned(x: np.ndarray, edges: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Indicators of bins of every line, then of the line before and the line after in the same text."""
    own = np.stack([(x > edges[:, b]) for b in range(edges.shape[1])], axis=2).reshape(len(x), -1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[at[:-1]] = False
    after[at[1:] - 1] = False
    return np.concatenate([own, before, after, np.ones((len(x), 1), bool)], axis=1)


def forward_backward(evidence: np.ndarray, at: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good of every line, and expected label pairs per text (as seen from every line but the first).

    Texts advance together, one line a step; those that have ended leave."""
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    starts, sizes = at[:-1][order], n[order]
    step = np.exp(follow - follow.max())
    half = np.clip(evidence, -60, 60) / 2
    weight = np.exp(np.stack([-half, half], axis=1) - np.abs(half)[:, None])
    alpha, beta = np.empty_like(weight), np.ones_like(weight)
    active = [int(np.searchsorted(-sizes, -t, "left")) for t in range(int(sizes[0]) if len(sizes) else 0)]
    for t, k in enumerate(active):
        here = starts[:k] + t
        a = weight[here] if t == 0 else (alpha[here - 1] @ step) * weight[here]
        alpha[here] = a / a.sum(axis=1, keepdims=True)
    for t in range(len(active) - 1, 0, -1):
        here = starts[: active[t]] + t
        b = (beta[here] * weight[here]) @ step.T
        beta[here - 1] = b / b.sum(axis=1, keepdims=True)
    both = alpha * beta
    good = both[:, 1] / both.sum(axis=1)
    inner = np.ones(len(evidence), bool)
    inner[at[:-1]] = False
    here = np.flatnonzero(inner)
    pair = alpha[here - 1][:, :, None] * step[None] * (weight[here] * beta[here])[:, None, :]
    return good, pair / pair.sum(axis=(1, 2), keepdims=True)


def _quality(good: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Length-weighted share of good lines, as log-odds."""
    share = np.add.reduceat(good * size, at[:-1]) / np.add.reduceat(size, at[:-1]) if len(at) > 1 else np.zeros(0)
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def fit(rows: list[tuple[int, bytes, int]]) -> bytes:
    """The model as bytes: bin edges, weights, label pairs, final curve."""
    y = np.array([r[2] for r in rows], float)
    if not len(rows) or y.min() == y.max():
        return pickle.dumps({"weights": None, "shift": 40.0 * (2 * y.mean() - 1) if len(rows) else 40.0})
    raw = b"".join(r[1] for r in rows)
    x, size, at = features(np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int64))
    marks = np.linspace(0, 1, BINS + 1)[:-1]
    edges = np.stack([np.quantile(np.concatenate([c[c > 0], [0]]), marks) for c in x.T])
    bins = binned(x, edges, at).astype(np.float32)
    doc = np.repeat(np.arange(len(y)), np.diff(at))
    rng = np.random.default_rng(11)
    check = rng.random(len(y)) < 0.2  # these fit the final curve only
    if len(set(y[check])) < 2 or len(set(y[~check])) < 2:
        check[:] = False
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    per_text = np.where(check, 0, weight) / np.diff(at)  # a text counts once, however many lines it has
    per_line = (per_text[doc] / len(y)).astype(np.float32)
    inner = np.ones(len(doc), bool)
    inner[at[:-1]] = False
    w, follow = np.zeros(bins.shape[1], np.float32), np.zeros((2, 2))
    truth = np.zeros((2, 2))
    for k in (0, 1):
        truth[k, k] = per_line[inner & (y[doc] == k)].sum()
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, ROUNDS + 1):
        good, pairs = forward_backward((bins @ w).astype(float), at, follow)
        g_w = bins.T @ (per_line * (y[doc] - good)).astype(np.float32) - RIDGE * w
        g_f = truth - (pairs * per_line[inner][:, None, None]).sum(axis=0) - 10 * RIDGE * follow
        for x_, g, m, v in ((w, g_w, moments[0], moments[1]), (follow, g_f, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x_ += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    good, _ = forward_backward((bins @ w).astype(float), at, follow)
    q = _quality(good, size, at)
    use = check if check.any() else ~check
    a, b = _logistic(q[use], y[use], weight[use])
    return pickle.dumps({"weights": w, "edges": edges, "follow": follow, "scale": a, "shift": b})


def line_scores(model: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of good of every line, line lengths, each text's offsets of lines."""
    x, size, at = features(data, offsets)
    good, _ = forward_backward((binned(x, model["edges"], at).astype(np.float32) @ model["weights"]).astype(float), at, model["follow"])
    return good, size, at


def scores(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model["weights"] is None:
        return _sigmoid(np.full(len(offsets) - 1, model["shift"]))
    good, size, at = line_scores(model, data, offsets)
    return _sigmoid(model["scale"] * _quality(good, size, at) + model["shift"])


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` scored: (doc_id, score, lines), one row per row; ``lines`` are the probabilities of its lines."""
    model = pickle.loads(train(docs, training_ids(labels, "quality", per_class), fit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            if model["weights"] is None:
                score = scores(model, data, offsets)
                _, _, at = lines_of(data, offsets)
                good = np.repeat(score, np.diff(at))
            else:
                good, size, at = line_scores(model, data, offsets)
                score = _sigmoid(model["scale"] * _quality(good, size, at) + model["shift"])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(good.astype(np.float32)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64()), lists], ["doc_id", "score", "lines"])

    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(run, "doc_id bigint, score double, lines array<float>")


def op10_quality(spark, sf_dir):
    done = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = crc_mod_column("doc_id", FOLDS) == HELD_OUT
    return done.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


