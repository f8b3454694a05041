"""Hidden Markov language model over the words of documents.

Training counts every word of the training documents. Frequent words are symbols of their own; all others fall
into classes by their last bytes, and a word's probability within its class comes from its count, one extra
word standing for all unseen ones. Latent states emit symbols. Baum-Welch runs over all training documents, cut
into sequences of ``SEGMENT`` words: tasks return expected counts, which are summed across partitions before the driver
renews the (small, bounded) parameters. States start from how the most frequent words occur together in documents.

A text's score is its exact log-probability: the scaled forward recursion over all its symbols, plus the words'
probabilities within their classes. Counts of rare words are joined by word hash after adding them up per
text; the frequent ones, which could make hot keys, are answered from a table of at most ``LISTED`` words.

Nothing but the corpus counts grows with the input: symbols, states, classes and listed words are fixed
parameters. Defined results: a null or empty text is the end token alone; without training documents every
token is unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, crc_mod_column, flat, materialise, packed, table
from sheaftext.llm.words import BLANKS, rolling, words

LISTED = 1 << 17
OWN = 1 << 14
CLASSES = 2048
STATES = 8
ROUNDS = 4
SEGMENT = 256
SEEDS = 128  # frequent symbols whose company starts the states
HELD = 500_000  # counts kept in a task before they are sent
FOLDS, HELD_OUT = 7, 2
_U = np.uint64


def classes_of(w) -> np.ndarray:
    """Class of each word: a hash of its last three bytes."""
    return (rolling(w.prefix, np.maximum(w.ends - 3, w.starts), w.ends) & _U(CLASSES - 1)).astype(np.int32)


def _merged(hashes: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return h, classes[first], np.bincount(inverse, counts, minlength=len(h)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    n = 0

    def batch(parts: tuple) -> pa.RecordBatch:
        h, c, k = parts
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c), pa.array(k)], ["word", "class", "n"])

    for _, data, offsets in chunks(batches):
        w = words(data, offsets, BLANKS)
        held.append(_merged(w.hashes, classes_of(w), np.ones(len(w.hashes), np.int64)))
        n += len(held[-1][0])
        if n > 2 * HELD:
            held = [_merged(*map(np.concatenate, zip(*held)))]
            n = len(held[0][0])
            if n > HELD:
                yield batch(held[0])
                held, n = [], 0
    if held:
        yield batch(_merged(*map(np.concatenate, zip(*held))))


class Vocabulary(NamedTuple):
    listed: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray
    symbols: np.ndarray  # of listed words; -1 for those without one of their own
    own: int
    class_log: np.ndarray  # log10 of a class's denominator
    unigram: np.ndarray  # of symbols: own words, classes, end
    tokens: int
    distinct: int
    texts: int


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, class, n) over the training texts, written once."""
    rows = texts.mapInArrow(_counted, "word bigint, class int, n bigint")
    return materialise(rows.groupBy("word").agg(F.first("class").alias("class"), F.sum("n").alias("n")), "word-counts")


def vocabulary(counts: DataFrame, texts: int, listed: int = LISTED, own: int = OWN) -> Vocabulary:
    level = F.floor(16 * F.log2(F.col("n").cast("double"))).cast("int")
    levels = sorted(((r.level, r.words, r.n) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()), reverse=True)
    taken, least = 0, None
    for lv, many, _ in levels:  # as many whole levels as fit
        if taken + many > listed:
            break
        taken, least = taken + many, lv
    top = counts.where(level >= least).toArrow() if least is not None else pa.table({"word": pa.array([], pa.int64()), "class": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    h, cls, n = top["word"].to_numpy().view(np.uint64), top["class"].to_numpy(), top["n"].to_numpy()
    order = np.lexsort((h, -n))
    symbol = np.full(len(h), -1, np.int32)
    symbol[order[:own]] = np.arange(min(own, len(h)))
    held = min(own, len(h))
    sums = np.zeros((2, CLASSES))
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        sums[:, r["class"]] = r["n"], r["words"]
    mine = symbol >= 0
    sums[0] -= np.bincount(cls[mine], n[mine], minlength=CLASSES)
    sums[1] -= np.bincount(cls[mine], minlength=CLASSES)
    of_symbol = np.concatenate([n[order[:own]], sums[0], [texts]]) + 1.0
    by = np.argsort(h)
    return Vocabulary(
        h[by], n[by], symbol[by], held, np.log10(sums[0] + sums[1] + 1), of_symbol / of_symbol.sum(),
        int(sum(x[2] for x in levels)) + texts, int(sum(x[1] for x in levels)) + (texts > 0), texts,
    )


_ENCODED = "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, within double, symbols binary, rare array<struct<word:bigint,n:bigint>>"


def _encoded(v: Vocabulary):
    logs = np.log10(v.counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            w = words(data, offsets, BLANKS)
            texts = len(offsets) - 1
            owner = np.repeat(np.arange(texts), np.diff(w.offsets))
            cls = classes_of(w)
            at = np.minimum(np.searchsorted(v.listed, w.hashes), max(len(v.listed) - 1, 0))
            hit = v.listed[at] == w.hashes if len(v.listed) else np.zeros(len(w.hashes), bool)
            symbol = np.where(hit, v.symbols[at], -1) if len(v.listed) else np.full(len(w.hashes), -1)
            log = np.where(hit, logs[at], 0.0) if len(v.listed) else np.zeros(len(w.hashes))
            by_class = symbol < 0
            symbol = np.where(by_class, v.own + cls, symbol)
            base = np.bincount(owner, log, minlength=texts) + np.log10(v.texts + 1.0)
            within = np.bincount(owner, by_class * (log - v.class_log[cls]), minlength=texts)
            known = np.bincount(owner, hit, minlength=texts).astype(np.int64) + (v.texts > 0)
            n = np.diff(w.offsets)
            ends = np.insert(symbol, w.offsets[1:], v.own + CLASSES).astype(np.uint16)  # the end token after each text
            cuts = (w.offsets + np.arange(texts + 1)) * 2
            rare_word, rare_owner = w.hashes[~hit], owner[~hit]
            order = np.lexsort((rare_word, rare_owner))
            rw, ro = rare_word[order], rare_owner[order]
            first = np.ones(len(rw), bool)
            first[1:] = (rw[1:] != rw[:-1]) | (ro[1:] != ro[:-1])
            begin = np.flatnonzero(first)
            times = np.diff(np.append(begin, len(rw)))
            lists = pa.StructArray.from_arrays([pa.array(rw[begin].view(np.int64)), pa.array(times.astype(np.int64))], names=["word", "n"])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(ro[begin], np.arange(texts + 1)), pa.int32()), lists)
            raw = pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(ends.tobytes())])
            arrays = [part.column(0), part.column(1), pa.array(n + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(within), raw, rare]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "known", "base", "within", "symbols", "rare"])

    return run


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(batch.column(0))
    return np.frombuffer(data.tobytes(), np.uint16).astype(np.int64), offsets // 2


def summed(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], np.ndarray], parts: int = 16) -> np.ndarray:
    """The sum over tasks of one vector a task (as float64), added up in ``parts`` pieces on the executors."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = np.array_split(task(batches), parts)
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([packed(p) for p in pieces], pa.binary())], ["part", "numbers"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(raw, np.float64)
                total[p] = total[p] + x if p in total else x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([packed(x) for x in total.values()], pa.binary())], ["part", "numbers"])

    rows = df.mapInArrow(send, "part int, numbers binary").repartition(parts, "part").mapInArrow(add, "part int, numbers binary").collect()
    return np.concatenate([np.frombuffer(bytes(r.numbers), np.float64) for r in sorted(rows, key=lambda r: r.part)]) if rows else np.zeros(0)


class Model(NamedTuple):
    start: np.ndarray  # states
    follow: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


def _company(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((size, size))
        for batch in batches:
            s, at = _symbols(batch)
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            low = s < size
            seen = np.zeros((len(at) - 1, size), np.float32)
            seen[owner[low], s[low]] = 1
            total += seen.T @ seen
        return total.reshape(-1)

    return task


def first_model(company: np.ndarray, v: Vocabulary, states: int) -> Model:
    """States from anchors: frequent symbols whose company lies farthest from that of the anchors before."""
    size = int(np.sqrt(len(company)))
    share = np.ones((len(v.unigram), states))
    if size:
        rows = company.reshape(size, size) + 1e-3
        rows = np.sqrt(rows / rows.sum(axis=1, keepdims=True))
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        near, anchors = rows @ rows.mean(axis=0), []
        for _ in range(min(states, size)):
            anchors.append(int(np.argmin(near)))
            alike = rows @ rows[anchors[-1]]
            near = alike if len(anchors) == 1 else np.maximum(near, alike)
        share[:size, : len(anchors)] = np.exp(12 * (rows @ rows[anchors].T))
    share /= share.sum(axis=1, keepdims=True)
    share = 0.9 * share + 0.1 / states
    emit = v.unigram[:, None] * share
    follow = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(follow, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), follow, emit / emit.sum(axis=0))


def _segments(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of pieces of at most ``SEGMENT`` symbols, longest first."""
    n = np.diff(at)
    count = -(-n // SEGMENT)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = np.repeat(at[:-1], count) + inside * SEGMENT
    sizes = np.minimum(SEGMENT, np.repeat(at[1:], count) - starts)
    order = np.argsort(-sizes, kind="stable")
    return starts[order], sizes[order]


def expected_counts(m: Model, s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions of sequences: one forward and one backward pass."""
    states = len(m.start)
    starts, sizes = _segments(at)
    begun, moved, sent = np.zeros(states), np.zeros((states, states)), np.zeros((len(m.emit), states))
    emit, follow, back = m.emit.astype(np.float32), m.follow.astype(np.float32), m.follow.T.astype(np.float32).copy()
    some = 4096
    for a in range(0, len(starts), some):
        own, length = starts[a : a + some], sizes[a : a + some]
        steps = int(length[0])
        active = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]
        alphas, weights = [], []
        alpha = np.broadcast_to(m.start.astype(np.float32), (len(own), states))
        for t, k in enumerate(active):
            e = emit[s[own[:k] + t]]
            alpha = (alpha[:k] if t == 0 else alpha[:k] @ follow) * e
            alpha = alpha / alpha.sum(axis=1, keepdims=True)
            alphas.append(alpha)
            weights.append(e)
        beta = np.ones((0, states), np.float32)
        symbols, gammas = [], []
        for t in range(steps - 1, -1, -1):
            k = active[t]
            if len(beta) < k:
                beta = np.concatenate([beta, np.ones((k - len(beta), states), np.float32)])
            gamma = alphas[t] * beta
            gamma /= gamma.sum(axis=1, keepdims=True)
            symbols.append(s[own[:k] + t])
            gammas.append(gamma)
            if t:
                right = weights[t] * beta
                left = alphas[t - 1][:k]
                scale = ((left @ follow) * right).sum(axis=1, keepdims=True)
                moved += (left / scale).T @ right * m.follow
                beta = right @ back
                beta /= beta.sum(axis=1, keepdims=True)
        begun += gammas[-1].sum(axis=0)
        symbols, gammas = np.concatenate(symbols), np.concatenate(gammas)
        for k in range(states):
            sent[:, k] += np.bincount(symbols, gammas[:, k], minlength=len(m.emit))
    return begun, moved, sent


def _expected(m: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        totals = [np.zeros(m.start.shape), np.zeros(m.follow.shape), np.zeros(m.emit.shape)]
        for batch in batches:
            for total, found in zip(totals, expected_counts(m, *_symbols(batch))):
                total += found
        return np.concatenate([x.reshape(-1) for x in totals])

    return task


def renewed(sums: np.ndarray, v: Vocabulary, states: int) -> Model:
    begun, moved, sent = sums[:states] + 1, sums[states : states + states**2].reshape(states, states) + 1, sums[states + states**2 :].reshape(-1, states)
    sent = sent + 200 * v.unigram[:, None]
    return Model(begun / begun.sum(), moved / moved.sum(axis=1, keepdims=True), sent / sent.sum(axis=0))


def baum_welch(symbols: DataFrame, v: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Train on a column of symbol lists."""
    model = first_model(summed(symbols, _company(min(SEEDS, v.own))), v, states)
    for _ in range(rounds):
        model = renewed(summed(symbols, _expected(model)), v, states)
    return model


def forward_log10(m: Model, s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact log10 probability of every sequence: all of them advance together, one symbol a step."""
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    starts, sizes = at[:-1][order], n[order]
    log = np.zeros(len(n))
    alpha = np.broadcast_to(m.start, (len(n), len(m.start)))
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left").tolist()
    product = np.ones(len(n))
    for t, k in enumerate(active):
        alpha = (alpha[:k] if t == 0 else alpha[:k] @ m.follow) * m.emit[s[starts[:k] + t]]
        total = alpha.sum(axis=1)
        alpha = alpha / total[:, None]
        product[:k] *= total
        if t % 16 == 15:  # logarithms only now and then; 16 factors stay within range
            log += np.log10(product)
            product[:] = 1
    log += np.log10(product)
    out = np.empty(len(n))
    out[order] = log
    return out


def language_scores(docs: DataFrame, held_out=None, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of ``docs`` (doc_id, text).

    ``held_out``: a boolean column; rows where it is true are scored but never learned from.
    """
    held = F.lit(False) if held_out is None else held_out
    rows = docs.select("doc_id", held.alias("held_out"), as_bytes("text").alias("text"))
    training = rows.where("not held_out")
    counts = word_counts(training.select("text"))
    v = vocabulary(counts, training.count())
    coded = rows.mapInArrow(_encoded(v), _ENCODED).withColumn("row", F.monotonically_increasing_id())
    coded = materialise(coded, "symbols")
    model = baum_welch(coded.where("not held_out").select("symbols"), v, states, rounds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, at = _symbols(batch)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(forward_log10(model, s, at))], ["row", "chain"])

    chain = coded.select("symbols", "row").mapInArrow(score, "row bigint, chain double")
    each = coded.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    found = each.join(counts.select("word", "n"), "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log"), F.sum("times").alias("more"))
    joined = coded.drop("symbols", "rare").join(chain, "row").join(found, "row", "left")
    log, more = F.coalesce("log", F.lit(0.0)), F.coalesce("more", F.lit(0))
    per_token = float(np.log10(v.tokens + v.distinct + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more).alias("n_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * per_token).alias("base_score"), (F.col("chain") + F.col("within") + log).alias("score"),
    )


def op2_hidden_markov(spark, sf_dir):
    return language_scores(table(spark, sf_dir, "documents"), crc_mod_column("doc_id", FOLDS) == HELD_OUT)


