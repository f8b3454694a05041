"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 6 bytes, those at its ends marked) and itself, hashed to a table of
embeddings; its vector is their mean. A window of two words is the mean of its words' vectors, and a linear
softmax over it gives toxic or clean. A text is as toxic as its worst window (windows overlap by one word), so
a few words in a very long text count as much as in a short one. Words not seen in training share n-grams
with words that were, also when misspelled.

Embeddings, softmax and a final logistic scale are fitted on at most ``PER_CLASS`` labelled documents of either
label with ``TRAIN_BYTES`` of text, documented bounds; all documents are scored whole. One task fits: it holds the sample as word numbers and the subwords of each different
word, and takes a step of Adagrad for each part of at most ``PART_BYTES`` of text, ``ROUNDS`` times, with the vectors of that part only. Scoring looks at each different word of a chunk once. Defined results: null, empty and wordless texts get the score of an empty window; without labels of both
kinds the score is the share of toxic labels (0 without any labels).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, crc_mod_column, release, table
from sheaftext.llm.labelled import FOLDS, HELD_OUT, train, training_ids
from sheaftext.llm.words import SYMBOLS, mix, rolling, words

PER_CLASS = 2500
BUCKETS = 1 << 17
GRAMS = (3, 4, 5, 6)  # bytes
DIM = 8
HALF = 1  # words in half a window
ROUNDS = 8
RATE = 0.3
THRESHOLD = 0.7
PART_BYTES = 1 << 19  # of a part, at most
PARTS = 32  # at least, if the sample has as many texts
_U = np.uint64


def grams(w, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of some words, and each word's offsets."""
    starts, ends = w.starts[picked], w.ends[picked]
    owner, hashes = [np.arange(len(picked))], [w.hashes[picked] ^ _U(0x5851F42D4C957F2D)]
    for n in GRAMS:
        count = np.maximum(ends - starts - n + 1, 0)
        who = np.repeat(np.arange(len(picked)), count)
        at = np.repeat(starts, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        h = rolling(w.prefix, at, at + n)
        owner.append(who)
        hashes.append(h)
        for edge, mark in ((at == starts[who], 0x14057B7EF767814F), (at + n == ends[who], 0x2545F4914F6CDD1D)):
            owner.append(who[edge])
            hashes.append(mix(h[edge] ^ _U(mark)))
    owner, hashes = np.concatenate(owner), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    return (hashes[order] & _U(BUCKETS - 1)).astype(np.int32), np.searchsorted(owner[order], np.arange(len(picked) + 1))


def _means(rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Means of runs of rows; every run has one row at least."""
    return np.add.reduceat(rows, offsets[:-1], axis=0) / np.diff(offsets).astype(rows.dtype)[:, None] if len(offsets) > 1 else rows[:0]


class Bags:
    """Texts as windows over a table of different words."""

    def __init__(self, word: np.ndarray, offsets: np.ndarray, subwords: np.ndarray, subword_offsets: np.ndarray):
        """``word``: number of each word, ``offsets``: of each text's words; then the subwords of each number."""
        self.word, self.grams, self.gram_offsets = word, subwords, subword_offsets
        n = np.diff(offsets)
        blocks = -(-n // HALF)
        block_doc = np.repeat(np.arange(len(n)), blocks)
        inside = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        self.block_starts = np.repeat(offsets[:-1], blocks) + inside * HALF
        self.block_sizes = np.minimum(HALF, np.repeat(offsets[1:], blocks) - self.block_starts)
        last = np.append(block_doc[1:] != block_doc[:-1], True)[: len(block_doc)]
        alone = last & (inside == 0)
        self.first = np.flatnonzero(~last | alone)  # a window is this block and the next
        self.second = np.where(alone[self.first], -1, self.first + 1)
        self.size = self.block_sizes[self.first] + np.where(self.second < 0, 0, self.block_sizes[self.second])
        self.doc = block_doc[self.first]
        self.docs = len(n)

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Bags:
        w = words(data, offsets, SYMBOLS)
        _, picked, word = np.unique(w.hashes, return_index=True, return_inverse=True)
        return cls(word, w.offsets, *grams(w, picked))

    def windows(self, of_word: np.ndarray) -> np.ndarray:
        """Mean of a quantity of words (by number of the word) over every window."""
        if not len(self.first):
            return np.zeros((0, *of_word.shape[1:]))
        sums = np.add.reduceat(of_word[self.word], self.block_starts, axis=0)
        total = sums[self.first] + np.where((self.second < 0).reshape(-1, *[1] * (of_word.ndim - 1)), 0, sums[self.second])
        return total / self.size.astype(of_word.dtype).reshape(-1, *[1] * (of_word.ndim - 1))

    def worst(self, of_window: np.ndarray, empty: float) -> np.ndarray:
        out = np.full(self.docs, -np.inf)
        np.maximum.at(out, self.doc, of_window)
        return np.where(np.isinf(out), empty, out)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Sample:
    """Labelled texts in parts: numbers of their words, and the subwords of every different word, once."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        self.parts, self.labels, known, found = [], [], {}, []
        first = 0
        sizes = np.cumsum([len(r[1]) for r in rows])
        most = min(PART_BYTES, int(sizes[-1]) // PARTS) if len(rows) else 0
        while first < len(rows):
            to = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + most, "right")))
            texts = [r[1] for r in rows[first:to]]
            w = words(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), SYMBOLS)
            each, picked, word = np.unique(w.hashes, return_index=True, return_inverse=True)
            new = np.array([h not in known for h in each.tolist()], bool)
            known.update(zip(each[new].tolist(), range(len(known), len(known) + int(new.sum()))))
            found.append(grams(w, picked[new]))
            numbers = np.array([known[h] for h in each.tolist()], np.int32)
            self.parts.append((numbers, word.astype(np.int32), w.offsets))
            self.labels.append(np.array([r[2] for r in rows[first:to]], float))
            first = to
        self.subwords = np.concatenate([np.zeros(0, np.int32), *(g for g, _ in found)])
        self.offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(o) for _, o in found)]))]).astype(np.int64)

    def bags(self, k: int) -> Bags:
        numbers, word, offsets = self.parts[k]
        sizes = self.offsets[numbers + 1] - self.offsets[numbers]
        at = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(self.offsets[numbers] - at[:-1], sizes) + np.arange(at[-1])
        return Bags(word, offsets, self.subwords[place], at)


def fit(rows: list[tuple[int, bytes, int]]) -> bytes:
    """The model as bytes. Adagrad, one step a part and round; the gradient of a text goes to its worst windows."""
    held = Sample(rows)
    y = np.concatenate([np.zeros(0), *held.labels])
    if not len(y) or y.min() == y.max():
        return pickle.dumps({"table": np.zeros(BUCKETS, np.float32), "bias": 0.0, "scale": 0.0, "shift": 40.0 * (2 * y.mean() - 1) if len(y) else -40.0})
    rng = np.random.default_rng(7)
    table_, soft, bias = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.5, (2, DIM)).astype(np.float32), np.zeros(2, np.float32)
    state = [(x, np.full(x.shape, 1e-8, np.float32)) for x in (table_, soft, bias)]
    of_label = np.array([0.5 / (1 - y.mean()), 0.5 / y.mean()])
    check = rng.random(len(y)) < 0.2  # these fit the final scale only
    if len(set(y[check])) < 2 or len(set(y[~check])) < 2:
        check[:] = False
    cuts = np.cumsum([0, *map(len, held.labels)])
    for step in range(ROUNDS):
        sharp = 0.3 + 1.7 * step / ROUNDS  # windows of a text share its gradient by a softmax that sharpens to the worst one
        for k in rng.permutation(len(held.parts)):
            bags, labels = held.bags(k), held.labels[k]
            used = ~check[cuts[k] : cuts[k + 1]]
            if used.any() and len(bags.first):
                _step(bags, labels, np.where(used, of_label[labels.astype(int)], 0) / used.sum(), sharp, state)
    folded = (2 * HALF * (table_ @ (soft[1] - soft[0]))).astype(np.float32)
    model = {"table": folded, "bias": float(bias[1] - bias[0]), "scale": 1.0, "shift": 0.0}
    margin = np.concatenate([margins(held.bags(k), model) for k in range(len(held.parts))])
    use = check if check.any() else ~check
    a, b = _logistic(np.clip(margin[use], -6, 6), y[use], of_label[y[use].astype(int)], pull=3.0)  # no single text decides the curve
    return pickle.dumps(model | {"scale": a, "shift": b})


def _step(bags: Bags, y: np.ndarray, weight: np.ndarray, sharp: float, state) -> None:
    """One Adagrad step on the texts of a part."""
    (table_, _), (soft, _), (bias, _) = state
    scale = 2 * HALF
    mean = bags.windows(_means(table_[bags.grams], bags.gram_offsets))
    logits = scale * (mean @ soft.T) + bias
    margin = (logits[:, 1] - logits[:, 0]).astype(float)
    top = bags.worst(margin, 0)
    e = np.exp(np.clip(sharp * (margin - top[bags.doc]), -50, 0))
    part = e / np.bincount(bags.doc, e, minlength=bags.docs)[bags.doc]
    of_text = np.bincount(bags.doc, part * margin, minlength=bags.docs)
    reached = np.bincount(bags.doc, minlength=bags.docs) > 0
    g = part * np.where(reached, weight * (_sigmoid(of_text) - y), 0)[bags.doc]
    live = np.flatnonzero(np.abs(g) > 1e-9)
    g, first, second, size = g[live].astype(np.float32), bags.first[live], bags.second[live], bags.size[live]
    toward_soft = scale * (g @ mean[live])
    toward = soft[1] - soft[0]
    per_block = np.zeros(len(bags.block_starts), np.float32)
    np.add.at(per_block, first, g / size)
    np.add.at(per_block, second[second >= 0], (g / size)[second >= 0])
    marked = np.flatnonzero(per_block)
    lengths = bags.block_sizes[marked]
    at = np.repeat(bags.block_starts[marked], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sizes = np.diff(bags.gram_offsets)
    per_word = np.bincount(bags.word[at], np.repeat(per_block[marked], lengths), minlength=len(sizes)) / sizes
    per_gram = np.bincount(bags.grams, np.repeat(per_word, sizes), minlength=BUCKETS)
    touched = np.flatnonzero(per_gram)
    for (x, s), rows, d in zip(state, (touched, slice(None), slice(None)), ((scale * per_gram[touched, None] * toward[None, :]).astype(np.float32), np.stack([-toward_soft, toward_soft]), np.array([-g.sum(), g.sum()], np.float32))):
        s[rows] += d * d
        x[rows] -= RATE * d / np.sqrt(s[rows])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: float = 0.01) -> tuple[float, float]:
    """A rising logistic curve through margins by Newton steps, pulled to the plain one by ``pull`` texts."""
    t = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(t[0] * x + t[1])
        d = weight * (p - y)
        grad = np.array([(d * x).sum(), d.sum()]) + pull * (t - [1, 0])
        h = weight * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + pull, (h * x).sum()], [(h * x).sum(), h.sum() + pull]])
        t = t - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return max(float(t[0]), 0.01), float(t[1])


def margins(bags: Bags, model: dict) -> np.ndarray:
    of_word = _means(model["table"][bags.grams][:, None], bags.gram_offsets)[:, 0] if len(bags.grams) else np.zeros(0)
    return bags.worst(bags.windows(of_word) + model["bias"], min(model["bias"], 0.0))


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` scored: (doc_id, score), one row per row."""
    model = pickle.loads(train(docs, training_ids(labels, "toxic", per_class), fit))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket: half a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, data, offsets in chunks(batches):
            score = _sigmoid(m["scale"] * margins(Bags.of(data, offsets), m) + m["shift"])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])
        release()

    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def score_column(model: dict):
    """A column function from UTF-8 bytes to scores, for a model already fitted."""

    def run(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, data, offsets in chunks([pa.RecordBatch.from_arrays([column], ["text"])]):
            out.append(_sigmoid(model["scale"] * margins(Bags.of(data, offsets), model) + model["shift"]))
        return pa.array(np.concatenate(out), pa.float64())

    return F.arrow_udf(run, "double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    model = pickle.loads(train(docs, training_ids(labels, "toxic", per_class), fit))
    return docs.where(score_column(model)(as_bytes("text")) < threshold)


def op9_toxicity(spark, sf_dir):
    done = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = crc_mod_column("doc_id", FOLDS) == HELD_OUT
    return done.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


