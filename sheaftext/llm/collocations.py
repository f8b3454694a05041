"""Phrase collocations by best-first branch and bound over prefixes.

A phrase is 2 to 5 words of one piece of text; its score is the least, over its cuts into two parts, of a*n/(l*r), where a, l and r
count the phrase and its parts and n all words of the language. As r is at least a, no phrase that begins with word w scores more
than n/f(w): this bound of a branch is known from the counts of words alone.

1. Texts are encoded once, as a written table of 64-bit word numbers (0 ends a piece; the number also stands for the language), with the
   counts of words. Words that are too rare end a piece, as no candidate holds them.
2. The frontier is the first words not yet expanded, best bound first. A round expands, in every language, the words from the best bound down to
   a share of the text, or, once as many phrases as asked for have survived, all words whose bound reaches the last
   of these scores (ties included).
   a. Pairs that begin with such a word are counted by number; those that may be frequent go into a bitmap.
   b. Phrases of 2 to 5 words that begin with such a pair are counted exactly, each with its neighbour to the left and right when
      that is always the same word: then a longer phrase is as frequent, and the shorter one is dropped.
   c. Prefix counts are known by then. Counts of the other parts are asked for only where the phrase can still reach the last score.
3. When no word of the frontier can reach a language's last score any more, what is found is proven complete.

Counting never gathers the occurrences of a phrase: tasks count first, counts travel packed by fragments of the hash space.
A bitmap only saves work (a wrong hit is counted and then dropped by its exact words) and has a fixed largest size, ``BITS``. Languages are
columns everywhere; nothing per word, phrase or language is held by the driver.

Defined results: null, empty and blank texts have no words; a null language is ``und``. Pieces never cross rows. Repeated rows count as often as
they occur. Texts of any length are cut at piece ends; a single piece is held whole. Scores are exact; ties are ordered as
stated in :func:`collocations`. Other columns, ids included, are ignored. An empty table has no phrases. Should two words
ever get one number (not expected below 10^9 different words), the run stops and says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaftext.llm.common import CHUNK_BYTES, as_bytes, flat, materialise, packed, partitions, release, table
from sheaftext.llm.words import _PLACE, mix, words

LEAST = 100
LONGEST = 5
FIRST = 2000
SHARE = 1 / 16  # of a language's words: the first round's part of the frontier
BITS = 1 << 27  # of a bitmap, at most
HELD = 1 << 18  # counts that a task holds before it sends them
NAMED = 1 << 16  # different words that a task holds before it sends them
PER_FRAGMENT = 1 << 19  # counts of a fragment
_U = np.uint64
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?\n\x0b\x0c\r"]] = True
_SEPARATORS = _ENDS.copy()
_SEPARATORS[[0x20, 0x09]] = True

ENCODED = "lang string, tokens binary, numbers array<bigint>, counts array<bigint>, names array<binary>"


class Vocabulary:
    """Counts of words by number, each with its bytes; sent on when they are many."""

    def __init__(self):
        self.numbers, self.counts, self.names = np.zeros(0, np.uint64), np.zeros(0, np.int64), pa.array([], pa.binary())

    def add(self, numbers: np.ndarray, counts: np.ndarray, names: pa.Array) -> None:
        joined, n = np.concatenate([self.numbers, numbers]), np.concatenate([self.counts, counts])
        self.numbers, first, which = np.unique(joined, return_index=True, return_inverse=True)
        self.counts = np.bincount(which, n, len(first)).astype(np.int64)
        self.names = pa.concat_arrays([self.names, names]).take(pa.array(first))

    def row(self, lang: str) -> pa.RecordBatch:
        lists = [pa.array([v], t) for v, t in ((self.numbers.view(np.int64), pa.list_(pa.int64())), (self.counts, pa.list_(pa.int64())))]
        names = pa.ListArray.from_arrays(pa.array([0, len(self.names)], pa.int32()), self.names)
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.binary()), *lists, names], ["lang", "tokens", "numbers", "counts", "names"])


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Slices of at most ``CHUNK_BYTES`` that end with a piece; a longer piece is one slice."""
    cuts = np.append(np.flatnonzero(_ENDS[data]) + 1, len(data))
    at = 0
    while at < len(data):
        k = np.searchsorted(cuts, at + CHUNK_BYTES, "right") - 1
        to = int(cuts[k]) if k >= 0 and cuts[k] > at else int(cuts[np.searchsorted(cuts, at, "right")])
        yield data[at:to]
        at = to


def numbered_words(data: np.ndarray, lang: str):
    """Numbers of the words of a text, 0 where a piece ends, and their start and end bytes (without the zeros)."""
    w = words(data, np.array([0, len(data)]), _SEPARATORS)
    salt = _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
    numbers = np.maximum(mix(w.hashes ^ salt), _U(1))
    piece = np.cumsum(_ENDS[data])[w.starts]
    after = np.zeros(len(numbers), np.int64)
    after[1:] = np.cumsum(piece[1:] != piece[:-1])
    tokens = np.zeros(len(numbers) + int(after[-1] if len(after) else 0) + 1, np.uint64)
    tokens[np.arange(len(numbers)) + after] = numbers
    return tokens, numbers, w


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Vocabulary] = {}
    for batch in batches:
        lang = batch.column("lang").to_numpy(zero_copy_only=False)
        data, offsets = flat(batch.column("text"))
        for name in sorted(set(lang)):
            own = np.flatnonzero(lang == name)
            joined = np.frombuffer(b"\n".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in own), np.uint8)
            for part in _parts(joined):
                tokens, numbers, w = numbered_words(part, name)
                if not len(numbers):
                    continue
                each, first, which, counts = np.unique(numbers, return_index=True, return_inverse=True, return_counts=True)
                length, head, tail = w.ends - w.starts, w.lower[w.starts], w.lower[w.ends - 1]
                if any((v != v[first][which]).any() for v in (length, head, tail)):
                    raise ValueError("two words have one number")
                raw = w.lower.tobytes()
                names = pa.array([raw[a:b] for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist())], pa.binary())
                vocabulary = known.setdefault(name, Vocabulary())
                vocabulary.add(each, counts, names)
                if sum(len(v.numbers) for v in known.values()) > NAMED:
                    yield from (v.row(k) for k, v in known.items())
                    known = {}
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([packed(tokens)], pa.binary()), *(pa.nulls(1, pa.list_(t)) for t in (pa.int64(), pa.int64(), pa.binary()))], ["lang", "tokens", "numbers", "counts", "names"])
    yield from (v.row(k) for k, v in known.items())
    release()


def holds(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    place = numbers & _U(len(bitmap) * 8 - 1)
    return (bitmap[place >> _U(3)] >> (place & _U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def phrase_numbers(tokens: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    total = np.full(len(starts), size, np.uint64)
    for j in range(size):
        total += tokens[starts + j] * _PLACE[j]
    return mix(total)


class Counts:
    """Phrases of one length: words, counts and the words always next to them (0: none or several)."""

    def __init__(self, size: int):
        self.size, self.parts, self.rows = size, [], 0

    def add(self, hashes, keys, counts, left, right) -> None:
        self.parts.append((hashes, keys, counts, left, right))
        self.rows += len(hashes)

    def merged(self):
        """Equal phrases as one. Equal hashes of different phrases only leave rows apart, never together."""
        if not self.parts:
            return None
        hashes, keys, counts, left, right = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((*keys.T[::-1], hashes)) if keys.shape[1] else np.argsort(hashes)
        hashes, keys, counts, left, right = (v[order] for v in (hashes, keys, counts, left, right))
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1]).any(axis=1)
        at = np.flatnonzero(new)
        if len(at):
            same = lambda v: np.where(np.minimum.reduceat(v, at) == np.maximum.reduceat(v, at), v[at], _U(0))
            merged = hashes[at], keys[at], np.add.reduceat(counts, at), same(left), same(right)
        else:
            merged = hashes, keys, counts, left, right
        self.parts, self.rows = [merged], len(at)
        return merged

    def sent(self, fragments: int) -> Iterator[pa.RecordBatch]:
        merged = self.merged()
        if merged is None or not len(merged[0]):
            return
        fragment = ((merged[0] >> _U(40)) * _U(fragments) >> _U(24)).astype(np.int64)  # sorted, as hashes are
        cuts = np.searchsorted(fragment, np.arange(fragments + 1))
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        columns = [[packed(v[cuts[f] : cuts[f + 1]]) for f in full] for v in merged]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(np.full(len(full), self.size), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["fragment", "size", "hashes", "keys", "counts", "left", "right"])
        self.parts, self.rows = [], 0


SENT = "fragment bigint, size int, hashes binary, keys binary, counts binary, left binary, right binary"


def _tally(spans: Callable[[np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray, bool]]], fragments: int):
    """Counts of the phrases that ``spans`` picks from tokens: (words, starts, hashes, with words and neighbours or by hash alone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counts] = {}
        for batch in batches:
            for raw in batch.column("tokens"):
                tokens = np.frombuffer(raw.as_buffer(), np.uint64)
                for size, starts, hashes, whole in spans(tokens):
                    if not len(starts):
                        continue
                    order = np.argsort(hashes, kind="stable")
                    starts, hashes = starts[order], hashes[order]
                    none = np.zeros(len(starts), np.uint64)
                    keys = np.stack([tokens[starts + j] for j in range(size)], axis=1) if whole else np.zeros((len(starts), 0), np.uint64)
                    left = np.where(starts > 0, tokens[starts - 1], _U(0)) if whole else none
                    right = tokens[starts + size] if whole else none  # tokens end with 0
                    own = Counts(size)
                    own.add(hashes, keys, np.ones(len(starts), np.int64), left, right)
                    held.setdefault(size, Counts(size)).add(*own.merged())
            if sum(c.rows for c in held.values()) > HELD:
                for c in held.values():
                    c.merged()
                if sum(c.rows for c in held.values()) > HELD // 2:
                    for c in held.values():
                        yield from c.sent(fragments)
        for c in held.values():
            yield from c.sent(fragments)
        release()

    return run


def _summed(least: int):
    """One fragment and length: phrases counted at least so often."""

    def run(rows: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        c = Counts(size)
        for hashes, keys, counts, left, right in zip(*(rows.column(k) for k in ("hashes", "keys", "counts", "left", "right"))):
            h, n, a, b = (np.frombuffer(v.as_buffer(), t) for v, t in ((hashes, np.uint64), (counts, np.int64), (left, np.uint64), (right, np.uint64)))
            c.add(h, np.frombuffer(keys.as_buffer(), np.uint64).reshape(len(h), -1), n, a, b)
        hashes, keys, counts, left, right = c.merged()
        often = counts >= least
        raw = keys[often].astype(">u8").tobytes()
        step = 8 * keys.shape[1]
        names = [raw[i : i + step] for i in range(0, len(raw), step)] if step else [b""] * int(often.sum())
        kinds = pa.int64()
        out = pa.table({"key": pa.array(names, pa.binary()), "size": pa.array(np.full(len(names), size), pa.int32()), "a": pa.array(counts[often], kinds), "left": pa.array(left[often].view(np.int64), kinds), "right": pa.array(right[often].view(np.int64), kinds), "hash": pa.array(hashes[often].view(np.int64), kinds)})
        del c, hashes, keys, counts, left, right, often, raw, names
        release()
        return out

    return run


def _bitmap(numbers: DataFrame, column: str):
    """A shared bitmap of the low bits of a column of numbers: 16 bits each, up to ``BITS`` in all."""
    many = numbers.count()
    bits = min(BITS, max(1 << 16, 1 << (16 * many).bit_length()))
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    pages = numbers.groupBy(F.shiftright(place, 15).alias("page")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in pages.collect():  # 4,096 pages of 4 kB at most
        out[r.page * 4096 : r.page * 4096 + 4096] = np.frombuffer(r.bits, np.uint8)
    return numbers.sparkSession.sparkContext.broadcast(out)


def _pairs(frequent, opened):
    def spans(tokens):
        often = holds(frequent.value, tokens) & (tokens != 0)
        starts = np.flatnonzero(often[:-1] & often[1:])
        starts = starts[holds(opened.value, tokens[starts])]
        yield 2, starts, phrase_numbers(tokens, starts, 2), False

    return spans


def _phrases(frequent, opened, pairs, longest: int):
    def spans(tokens):
        often = holds(frequent.value, tokens) & (tokens != 0)
        starts = np.flatnonzero(often[:-1] & often[1:])
        starts = starts[holds(opened.value, tokens[starts])]
        hashes = phrase_numbers(tokens, starts, 2)
        chosen = holds(pairs.value, hashes)
        starts = starts[chosen]
        yield 2, starts, hashes[chosen], True
        for size in range(3, longest + 1):
            starts = starts[starts + size <= len(tokens) - 1]
            starts = starts[often[starts + size - 1]]
            yield size, starts, phrase_numbers(tokens, starts, size), True

    return spans


def _asked(frequent, firsts, asked, longest: int):
    def spans(tokens):
        often = holds(frequent.value, tokens) & (tokens != 0)
        starts = np.flatnonzero(often[:-1] & often[1:])
        starts = starts[holds(firsts.value, tokens[starts])]
        for size in range(2, longest):
            if size > 2:
                starts = starts[starts + size <= len(tokens) - 1]
                starts = starts[often[starts + size - 1]]
            hashes = phrase_numbers(tokens, starts, size)
            chosen = holds(asked.value, hashes)
            yield size, starts[chosen], hashes[chosen], True

    return spans


def _hashes_of_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key").to_pylist()
        tokens = [np.frombuffer(k, ">u8").astype(np.uint64) for k in keys]
        hashes = np.array([phrase_numbers(t, np.zeros(1, np.int64), len(t))[0] for t in tokens], np.uint64)
        first = np.array([t[0] for t in tokens], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(first.view(np.int64), pa.int64()), pa.array(hashes.view(np.int64), pa.int64())], ["key", "first", "hash"])


def _key(number: str) -> Column:
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def _score(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)), exact."""
    whole = lambda c: f"cast({c} as decimal(38,0))"
    return F.expr(f"(1000 * {whole(a)} * {whole(n)}) div ({whole(l)} * {whole(r)})")


class Search:
    """The tables of one search: encoded texts, frequent words, what the rounds have found."""

    def __init__(self, docs: DataFrame, least: int, longest: int, first: int):
        self.spark, self.least, self.longest, self.first = docs.sparkSession, least, longest, first
        texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), as_bytes("text").alias("text"))
        encoded = materialise(texts.mapInArrow(_encode, ENCODED), "encoded")
        self.tokens = encoded.where("tokens is not null").select("tokens")
        each = encoded.where("tokens is null").select("lang", F.explode(F.arrays_zip("numbers", "counts", "names")).alias("w"))
        word = each.groupBy(F.col("w.numbers").alias("number")).agg(F.sum("w.counts").alias("f"), F.min("w.names").alias("word"), F.max("w.names").alias("other"), F.min("lang").alias("lang"), F.max("lang").alias("lang2"))
        counted = materialise(word.select("number", "f", "word", "lang", ((F.col("word") != F.col("other")) | (F.col("lang") != F.col("lang2"))).alias("clash")), "word-counts")
        if counted.where("clash").limit(1).count():
            raise ValueError("two words have one number")
        self.totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
        self.words = materialise(counted.where(F.col("f") >= least).join(self.totals, "lang").select("number", "f", "word", "lang", "n", _key("number").alias("key")), "frequent-words")
        self.frequent = _bitmap(self.words, "number")
        self.known = [self.words.select("key", F.col("f").alias("count"))]
        self.scored: list[DataFrame] = []

    def counts(self, spans, expected: int, label: str, least: int) -> DataFrame:
        fragments = max(partitions(self.spark), -(-expected // PER_FRAGMENT))
        sent = self.tokens.mapInArrow(_tally(spans, fragments), SENT)
        summed = sent.groupBy("fragment", "size").applyInArrow(_summed(least), "key binary, size int, a bigint, left bigint, right bigint, hash bigint")
        return materialise(summed, label)

    def shares(self, share: float) -> DataFrame:
        """(lang, cap): the largest count of the words that make up this share of a language, rarest first."""
        each = self.words.groupBy("lang", "f").agg(F.sum("f").alias("there"), F.first("n").alias("n"))
        so_far = F.sum("there").over(Window.partitionBy("lang").orderBy("f"))
        within = each.withColumn("so_far", so_far).where((F.col("so_far") <= share * F.col("n")) | (F.col("so_far") == F.col("there")) | F.lit(share >= 1))
        return within.groupBy("lang").agg(F.max("f").alias("cap"))

    def last_scores(self) -> DataFrame | None:
        """(lang, last): the score of the last phrase asked for, of languages that have as many."""
        if not self.scored:
            return None
        best = best_of(self._all(self.scored), self.first)
        return materialise(best.groupBy("lang").agg(F.count(F.lit(1)).alias("many"), F.min("score").alias("last")).where(F.col("many") >= self.first).select("lang", "last"), "last-scores")

    @staticmethod
    def _all(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def run(self) -> DataFrame | None:
        opened = self.totals.select("lang", F.lit(0).cast("bigint").alias("cap"))
        share = SHARE
        while True:
            last = self.last_scores()
            caps = self.shares(share).join(opened.withColumnRenamed("cap", "old"), "lang")
            if last is not None:
                caps = caps.join(last, "lang", "left").join(self.totals, "lang")
                proven = F.expr("(1000 * cast(n as decimal(38,0))) div last")
                caps = caps.withColumn("cap", F.when(F.col("last").isNotNull(), proven).otherwise(F.col("cap")))
            caps = materialise(caps.select("lang", "old", F.greatest("old", "cap").alias("cap")), "caps")
            fresh = materialise(self.words.join(caps, "lang").where("f > old and f <= cap").select("number", "f", "lang", "n", "key"), "frontier")
            expected = fresh.agg(F.sum("f")).first()[0]
            if expected:
                self.expand(fresh, expected, last)
                opened = caps.select("lang", "cap")
            elif share >= 1:
                return best_of(self._all(self.scored), self.first) if self.scored else None
            share = min(1.0, share * 8)

    def expand(self, fresh: DataFrame, expected: int, last: DataFrame | None) -> None:
        opened = _bitmap(fresh, "number")
        likely = self.counts(_pairs(self.frequent, opened), expected, "pairs", self.least)
        found = self.counts(_phrases(self.frequent, opened, _bitmap(likely, "hash"), self.longest), expected, "phrases", self.least)
        head = fresh.select(F.col("key").alias("head"), "lang", "n")
        phrases = materialise(found.withColumn("head", F.substring("key", 1, 8)).join(head, "head").drop("head", "hash"), "candidates")
        self.known.append(phrases.select("key", F.col("a").alias("count")))
        longer = (F.col("size") < self.longest) & ((F.col("left") != 0) | (F.col("right") != 0))
        cuts = phrases.where(~longer).select("lang", "key", "size", "a", "n", F.explode(F.expr("sequence(1, size - 1)")).alias("cut"))
        parts = cuts.select("*", F.expr("substring(key, 1, 8 * cut)").alias("lkey"), F.expr("substring(key, 8 * cut + 1)").alias("rkey"))
        known = self._all(self.known)
        side = lambda k, c: known.select(F.col("key").alias(k), F.col("count").alias(c))
        parts = materialise(parts.join(side("lkey", "l"), "lkey").join(side("rkey", "r"), "rkey", "left"), "cuts")
        parts = parts.withColumn("at_most", F.expr("coalesce(r, a)")).withColumn("bound", _score("a", "n", "l", "at_most"))
        reach = parts.groupBy("key").agg(F.min("bound").alias("bound"), F.min("lang").alias("lang"))
        if last is not None:
            reach = reach.join(last, "lang", "left").where("last is null or bound >= last")
        parts = materialise(parts.join(reach.select("key"), "key").drop("at_most", "bound"), "open-cuts")
        missing = materialise(parts.where("r is null").select(F.col("rkey").alias("key")).distinct().mapInArrow(_hashes_of_keys, "key binary, first bigint, hash bigint"), "asked")
        if missing.limit(1).count():
            spans = _asked(self.frequent, _bitmap(missing.select("first").distinct(), "first"), _bitmap(missing, "hash"), self.longest)
            answers = self.counts(spans, expected, "answers", self.least).join(missing.select("key"), "key")
            parts = parts.join(answers.select(F.col("key").alias("rkey"), F.col("a").alias("answer")), "rkey", "left").withColumn("r", F.expr("coalesce(r, answer)")).drop("answer")
        least = F.min(F.struct(_score("a", "n", "l", "r").alias("score"), "cut", "l", "r")).alias("cut")
        scores = parts.groupBy("lang", "key", "size", "a", "n").agg(least)
        self.scored.append(materialise(scores.select("lang", "key", "a", "n", "cut.score", "cut.l", "cut.r"), "scores"))


def best_of(scored: DataFrame, first: int) -> DataFrame:
    """Each language's first phrases by score and count, and all ties of the last; languages are split before they are ranked."""
    order = lambda *by: Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
    some = scored.withColumn("split", F.pmod(F.xxhash64("key"), F.lit(64))).withColumn("place", F.rank().over(order("lang", "split"))).where(F.col("place") <= first)
    return some.withColumn("place", F.rank().over(order("lang"))).where(F.col("place") <= first).drop("split", "place")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score, then count, then bytes of the phrase."""
    search = Search(docs, least, longest, first)
    best = search.run()
    if best is None:
        return search.spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    each = best.select("*", F.posexplode(F.expr("transform(sequence(1, length(key) div 8), i -> substring(key, 8 * i - 7, 8))")).alias("at", "part"))
    named = each.join(search.words.select(F.col("key").alias("part"), F.col("word").cast("string").alias("word")), "part")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    whole = named.groupBy("lang", "key", "a", "l", "r", "n", "score").agg(phrase.alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("bigint")
    return whole.withColumn("rank", rank).where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS t(i)
), counted AS MATERIALIZED (
  SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), often AS MATERIALIZED (
  SELECT lang, k, g, f AS a, n, ' ' || array_to_string(g, ' ') || ' ' AS s FROM counted JOIN totals USING (lang) WHERE k > 1 AND f >= 100
), kept AS (
  SELECT * FROM often AS p
  WHERE NOT EXISTS (SELECT 1 FROM often AS q WHERE q.lang = p.lang AND q.k > p.k AND q.a >= p.a AND contains(q.s, p.s))
), cuts AS (
  SELECT p.lang, p.g, p.a, p.n, c AS cut, x.f AS l, y.f AS r,
    (1000::HUGEINT * p.a * p.n::HUGEINT) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM kept) AS p
  JOIN counted AS x ON x.lang = p.lang AND x.k = c AND x.g = p.g[1:c]
  JOIN counted AS y ON y.lang = p.lang AND y.k = p.k - c AND y.g = p.g[c + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
