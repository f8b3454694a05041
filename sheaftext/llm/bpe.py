"""BPE encoding and decoding with the vocabulary file of a public tokenizer, in numpy.

A text is cut at white space into chunks; each different chunk is normalised (NFC, lower case per character),
cut into words by the tokenizer's pattern and encoded once per task, until the table of known chunks is full
and begins anew. The words of many chunks are encoded together: their symbols lie in one flat array, the rank of each
neighbouring pair is found by binary search over the sorted pair keys, and a round merges the lowest-ranked
pair of every word, until no word has a pair left. Where a merge could make a pair of still lower rank, only
the leftmost one of a word is merged in a round, as a queue of merges would do.

Strings of special tokens in a text become their ids; the pieces around them are encoded apart. The file has no
decoder, so decoding joins the strings of the tokens with spaces, special ones included.

Defined results: a null, empty or blank text has no ids and decodes to the empty text. Texts are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaftext.llm.common import chunks, table, values

KNOWN_CHUNKS = 200_000
BATCH_BYTES = 1 << 19
_NEVER = np.int64(2**62)
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: str.split() also cuts at these, the pattern of the tokenizer doesn't.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself when printable, else the next unused one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + end] for c in letters], np.int64)
        self.size = np.int64(max(self.names) + 1)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        first_use = np.full(self.size, _NEVER)
        for side in (left, right):
            np.minimum.at(first_use, side, np.arange(len(made)))
        self.safe = np.append(first_use[made] > np.arange(len(made)), True)
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys, self.ranks, self.made = (left * self.size + right)[order], order.astype(np.int64), made
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.starts, self.decoded = np.zeros(0, np.int64), np.zeros(1, np.int64), []

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words in one array, and each word's offsets."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.final[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], _NEVER)
            rank = np.append(rank, _NEVER)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(word)))
            least_each = np.repeat(least, length)
            open_ = least_each < _NEVER
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                symbols, word, rank, least_each = symbols[open_], word[open_], rank[open_], least_each[open_]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == least_each)
            if len(hit) > 1:
                fresh = np.ones(len(hit), bool)
                fresh[1:] = word[hit[1:]] != word[hit[:-1]]
                # runs of overlapping pairs (aaaa): every second one, from the left
                run = np.ones(len(hit), bool)
                run[1:] = hit[1:] != hit[:-1] + 1
                begin = np.maximum.accumulate(np.where(run | fresh, np.arange(len(hit)), 0))
                hit = hit[fresh | (self.safe[rank[hit]] & ((np.arange(len(hit)) - begin) % 2 == 0))]
            symbols[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        owner, ids = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(len(words) + 1))

    def words_of(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # no final form: each character alone
        chunk = chunk.lower()
        return [chunk] if chunk.isascii() and chunk.isalpha() else self.pattern.findall(chunk)

    def learn(self, new: list[str]) -> None:
        """Encode chunks that are not known yet."""
        parts = [self.words_of(c) for c in new]
        unique = list(dict.fromkeys(w for p in parts for w in p))
        ids, at = self.merge([w.encode() for w in unique])
        place = {w: k for k, w in enumerate(unique)}
        which = np.array([place[w] for p in parts for w in p], np.int64)
        count = (at[1:] - at[:-1])[which]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        flat = ids[at[which].repeat(count) + inside]
        per_word = np.concatenate([[0], np.cumsum(count)])
        ends = per_word[np.cumsum([len(p) for p in parts])]
        names = [self.names[i] for i in flat.tolist()]
        base = len(self.flat)
        begin = 0
        for c, end in zip(new, ends.tolist()):
            self.slot[c] = len(self.slot)
            self.decoded.append(" ".join(names[begin:end]))
            begin = end
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, base + ends])

    def chunks_of(self, text: str) -> list[str]:
        if self.cut_special and "<|" in text and len(pieces := self.cut_special.split(text)) > 1:
            return [c for k, p in enumerate(pieces) for c in ([p] if k % 2 else self.chunks_of(p))]
        if _NOT_SPACE.search(text):
            return [c for c in _SPACE.split(text) if c]
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of many texts in one array, each text's offsets, and the decoded texts."""
        lists = [self.chunks_of(t) for t in texts]
        wanted = set().union(*lists)
        if len(self.slot) + len(wanted) > KNOWN_CHUNKS:
            self.forget()
        new = [c for c in wanted if c not in self.slot]
        specials = [c for c in new if c in self.special]
        for c in specials:  # only whole special strings come as chunks of their own
            self.slot[c] = len(self.slot)
            self.decoded.append(c)
            self.flat = np.append(self.flat, self.special[c])
            self.starts = np.append(self.starts, len(self.flat))
        if len(new) > len(specials):
            self.learn([c for c in new if c not in self.special])
        n = np.array([len(cs) for cs in lists], np.int64)
        slots = [self.slot[c] for cs in lists for c in cs]
        at = np.array(slots, np.int64)
        count = self.starts[at + 1] - self.starts[at]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = self.flat[np.repeat(self.starts[at] - total[:-1], count) + np.arange(total[-1])]
        ends = np.concatenate([[0], np.cumsum(n)])
        cuts = ends.tolist()
        decoded = [" ".join(map(self.decoded.__getitem__, slots[a:b])) for a, b in zip(cuts, cuts[1:])]
        return flat, total[ends], decoded

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_KIND = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encoded(text: str, path: str | None = None) -> Column:
    """struct<ids, decoded> of a text column. ``path``: the vocabulary file, at the same place on every machine."""
    path = path or default_vocabulary()

    def run(column: pa.Array) -> pa.Array:
        coder, out = encoder(path), []
        raw = pa.RecordBatch.from_arrays([column], ["text"])
        for _, data, offsets in chunks([raw], BATCH_BYTES):
            ids, at, decoded = coder.encode([t.decode() for t in values(data, offsets)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            out.append(pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], fields=list(_KIND)))
        return pa.concat_arrays(out) if out else pa.array([], _KIND)

    return F.arrow_udf(run, "ids array<int>, decoded string")(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def decoded(ids: str, path: str | None = None) -> Column:
    """The text of a column of id lists; null for null."""
    path = path or default_vocabulary()

    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else encoder(path).decode(x) for x in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(F.col(ids))


def token_digests(df, path: str | None = None):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of documents."""
    done = df.select("doc_id", encoded("text", path).alias("e"))
    ids = F.sha2(F.concat_ws(" ", F.col("e.ids").cast("array<string>")), 256)
    return done.select("doc_id", F.size("e.ids").cast("bigint").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("e.decoded", 256).alias("decoded_sha256"))


def op5_bpe(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"))


