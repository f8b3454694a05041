"""Exact n-gram Jaccard self join by vertical partitioning.

A document's set holds its distinct shingles as 64-bit hashes. The work goes in five steps, none of which
lists the pairs of a group:

1. Documents with equal sets become one class; from here on there are only classes.
2. Shingles are sent to fragments of the hash space, by groups of texts, without repeats and cut to 32 bits, with 16 bits for the text. Each
   text gets back at least how many of its shingles another class has too. A link needs ``threshold`` of them, so the rest can't link.
   Groups don't know of copies in each other: a shingle with no more holders than the class has copies counts for nothing.
3. For the classes left, shingles are put in the global order (number of classes, hash). The first few of a
   class (the prefix) must hold a shingle of any partner. Each class takes as its home the most typical
   class that shares a prefix shingle, and is put into a block of classes of its home (small homes share blocks).
4. The global order is cut into fragments. Two blocks that share a prefix shingle form a cell of the classes that hold such
   a shingle, and so does a whole block with itself, so every pair that can link is in one cell.
5. Cells are dealt out; each arrives fragment by fragment. Partial overlaps of the pairs of a cell are counted in each fragment separately and
   summed per pair. Shingles with the same holders are counted once, with their number as weight. The cell gives a
   spanning forest of its links, and for each class the documents it is linked with; pairs are never listed.

Memory: a cell has at most two blocks of ``BLOCK`` classes (a shared block: as many small homes as hash to it), one fragment of their
shingles is held at a time besides one number per pair. Hot groups: exact copies vanish in step 1, before texts are
joined; a shingle held by a third of all documents is sent once per group in step 2 and is last in the order in step 3. Near copies of one
document fill blocks of one home, whose cells are spread over all tasks; their number of pairs of blocks grows with the square of the group,
as every link between different texts is counted.

Defined results: a text of fewer words than a shingle has one shingle of all its words; a null, empty or blank
text has none, links with nothing and is a component of its own; components are named by their smallest id,
null ids count as smaller than all and give a null name; rows with equal ids stay separate rows. Rows with equal sets are linked.
Texts of any length are compared whole, each in one chunk. Other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, chunks, flat, materialise, packed, partitions, release, table
from sheaftext.llm.components import components
from sheaftext.llm.words import distinct_per_text, mix, shingles, words

TOKENS_PER_FRAGMENT = 500_000
GROUP_TOKENS = 1_000_000  # shingles that a task collects before it deals them out to fragments
GROUP_TEXTS = 1 << 16
MANY = (1 << 16) - 1  # holders of a token, if so many or known to be of several classes
BLOCK = 512
FEW = 8  # holders of a shingle up to which its pairs are listed inside a task
FRAGMENTS = 4
CELLS = 64  # of a task
NO_ID = -(2**63)
_U = np.uint64


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, offsets, and a 128-bit digest of each set (two numbers a text)."""
    h, at = distinct_per_text(*shingles(words(data, offsets), size))
    sums = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.concatenate([[_U(0)], np.cumsum(mix(h ^ _U(salt)), dtype=np.uint64)])
        sums.append(mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)))
    return h, at, np.stack(sums, axis=1)


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            _, at, d = sets_of(data, offsets, size)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(at), pa.int64()), _digest_array(d)], ["doc_id", "h", "n", "digest"])
        release()

    return run


def short_tokens(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """31 bits of each shingle beside those that name its fragment, and whether the chunk knows it to be shared.

    Two shingles of a fragment that are alike in these only let a class pass that the next steps, which compare whole hashes, drop.
    """
    return ((mix(h) >> _U(33)) << _U(1)).astype(np.uint32) | known.astype(np.uint32)


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in groups of about ``GROUP_TOKENS`` shingles: hashes, the number in the group of each one's text, digests of the texts."""
    held, tokens, texts = [], 0, 0
    for _, data, offsets in chunks(batches):
        for a in range(0, len(offsets) - 1, GROUP_TEXTS):
            cut = offsets[a : a + GROUP_TEXTS + 1]
            h, at, d = sets_of(data[cut[0] : cut[-1]], cut - cut[0], size)
            if held and (tokens + len(h) > GROUP_TOKENS or texts + len(d) > GROUP_TEXTS):
                yield tuple(map(np.concatenate, zip(*held)))
                held, tokens, texts = [], 0, 0
            held.append((h, np.repeat(np.arange(texts, texts + len(d)).astype(np.uint16), np.diff(at)), d))
            tokens, texts = tokens + len(h), texts + len(d)
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _fragments(size: int, many: int):
    """Per group of texts and fragment: how many tokens, which text of the group each is of, short tokens. First, without tokens, the digests of
    the group, the counts that the group itself can tell, and the sizes; so a text costs the same bytes a shingle whatever the number of fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, owner, d in _groups(batches, size):
            name = int(np.sum(mix(d[:, 0] ^ mix(np.arange(1, len(d) + 1, dtype=np.uint64))), dtype=np.uint64) >> _U(16))
            _, first = np.unique(d, axis=0, return_index=True)
            keep = np.zeros(len(d), bool)
            keep[first] = True
            sizes = np.bincount(owner, minlength=len(d))
            keep &= sizes > 0
            h, owner = h[keep[owner]], owner[keep[owner]]
            order = np.argsort(h, kind="stable")
            h, owner = h[order], owner[order]
            same = np.zeros(len(h) + 1, bool)
            same[1:-1] = h[1:] == h[:-1]
            shared, repeat = same[:-1] | same[1:], same[:-1]
            counts = np.bincount(owner[shared], minlength=len(d))
            own = np.flatnonzero(keep)
            rows = [(int(h[0] % _U(many)) if len(h) else 0, name, packed(d[own]), packed(np.stack([counts[own], sizes[own]], axis=1).astype(np.uint32)), packed(own.astype(np.uint16)), b"")]
            h, owner, shared = h[~repeat], owner[~repeat], shared[~repeat]
            fragment = ((h >> _U(40)) * _U(many) >> _U(24)).astype(np.int64)
            order = np.lexsort((owner, fragment))
            owner, tokens = owner[order], short_tokens(h, shared)[order]
            cuts = np.searchsorted(fragment, np.arange(many + 1))  # sorted, as h is
            for f in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[f], cuts[f + 1]
                rows.append((f, name, b"", packed(np.array([b - a], np.uint32)), packed(owner[a:b]), packed(tokens[a:b])))
            kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["fragment", "name", "digests", "counts", "owners", "tokens"])
        release()

    return run


def _shared_places(rows: pa.Table) -> pa.Table:
    """For one fragment: how many tokens of each text are in more than one; a text goes by its place, the name of its group and its number there."""
    buckets = rows.column("buckets")[0].as_py()
    out = []
    for name, d, n, o in zip(*(rows.column(c) for c in ("name", "digests", "counts", "owners"))):
        if len(d.as_buffer()):
            places = _U(name.as_py()) << _U(16) | np.frombuffer(o.as_buffer(), np.uint16).astype(np.uint64)
            out.append((name.as_py() % buckets, d.as_py(), packed(places), n.as_py(), b""))
    tokens, at = flat(rows.column("tokens"))
    if len(tokens):
        sent = pc.greater(pc.binary_length(rows.column("tokens")), 0)
        owner = flat(rows.column("owners").filter(sent))[0].view(np.uint16)
        name = np.repeat(rows.column("name").to_numpy().astype(np.uint64), np.diff(at) // 4)
        start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])))
        digests, counts = np.stack([name[start], owner[start].astype(np.uint64)], axis=1), np.diff(np.append(start, len(owner))).astype(np.uint32)
        del owner, name
        found = _shared_counts(pa.table({"digests": [packed(digests)], "counts": [packed(counts)], "tokens": [tokens.tobytes()], "buckets": [buckets]}))
        for bucket, d, n, k in zip(*(found.column(c) for c in ("bucket", "digests", "counts", "holders"))):
            d = np.frombuffer(d.as_buffer(), np.uint64).reshape(-1, 2)
            out.append((bucket.as_py(), b"", packed(d[:, 0] << _U(16) | d[:, 1]), packed(np.frombuffer(n.as_buffer(), np.int64).astype(np.uint32)), k.as_py()))
    kinds = (pa.int64(), *[pa.binary()] * 4)
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["bucket", "digests", "places", "counts", "holders"])


def _shared_counts(rows: pa.Table) -> pa.Table:
    """For one fragment: how many tokens of each class are in more than one class, by the number of classes that hold them."""
    digests, counts, tokens, local_d, local_n = [], [], [], [], []
    for d, n, t in zip(*(rows.column(c) for c in ("digests", "counts", "tokens"))):
        d, n = np.frombuffer(d.as_buffer(), np.uint64).reshape(-1, 2), np.frombuffer(n.as_buffer(), np.uint32)
        if len(t.as_buffer()):
            digests.append(d)
            counts.append(n)
            tokens.append(np.frombuffer(t.as_buffer(), np.uint32))
        else:
            local_d.append(d)
            local_n.append(n.astype(np.int64))
    out_d, out_n, out_h = local_d, local_n, [np.full(len(n), MANY) for n in local_n]
    if tokens:
        classes, number = np.unique(np.concatenate(digests), axis=0, return_inverse=True)
        c = np.repeat(number.reshape(-1).astype(np.int32), np.concatenate(counts))
        t = np.concatenate(tokens)
        t, k = t >> np.uint32(1), (t & np.uint32(1)).astype(bool)
        del tokens, digests
        order = np.lexsort((c, t))
        c, t, k = c[order], t[order], k[order]
        del order
        start = np.ones(len(t), bool)
        start[1:] = t[1:] != t[:-1]
        del t
        group = np.cumsum(start, dtype=np.int32) - 1
        other = start.copy()
        other[1:] |= c[1:] != c[:-1]
        holders = np.minimum(np.bincount(group, other), MANY).astype(np.int64)
        holders[group[k]] = MANY
        # a token that a block knew to be shared was counted there for the classes of that block
        asked = (holders[group] > 1) & ~k
        kinds, n = np.unique(c[asked].astype(np.int64) << 16 | holders[group[asked]], return_counts=True)
        out_d, out_n, out_h = [*local_d, classes[kinds >> 16]], [*local_n, n], [*out_h, kinds & MANY]
    release()
    d = np.concatenate(out_d) if out_d else np.zeros((0, 2), np.uint64)
    n, holders = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_n, out_h))
    bucket = (d[:, 0] % _U(rows.column("buckets")[0].as_py())).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, at = np.unique(bucket[order], return_index=True)
    parts = [order[a:b] for a, b in zip(at, [*at[1:], len(order)])]
    column = lambda values: pa.array([packed(values[x]) for x in parts], pa.binary())
    return pa.table({"bucket": pa.array(names, pa.int64()), "digests": column(d), "counts": column(n), "holders": column(holders.astype(np.uint16))})


def _digest_array(d: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(d), [None, pa.py_buffer(packed(d))]).cast(pa.binary())


def _summed_counts(rows: pa.Table) -> pa.Table:
    """Tokens of each text of a bucket's groups that are in more than one text, over all fragments, by digest and number of holders.

    A text with a token that no other holds is the only one of its class: all its shared tokens are shared with other classes.
    """
    own = pc.greater(pc.binary_length(rows.column("digests")), 0)
    read = lambda part, name, kind: flat(part.column(name))[0].view(kind)
    named, told = rows.filter(own), rows.filter(pc.invert(own))
    places, first = np.unique(read(named, "places", np.uint64), return_index=True)
    digests = read(named, "digests", np.uint64).reshape(-1, 2)[first]
    local, sizes = read(named, "counts", np.uint32).reshape(-1, 2)[first].astype(np.int64).T
    at = np.append(np.searchsorted(places, read(told, "places", np.uint64)), np.arange(len(places)))
    n = np.append(read(told, "counts", np.uint32), local)
    holders = np.append(read(told, "holders", np.uint16), np.full(len(places), MANY)).astype(np.int64)
    alone = np.bincount(at, n, minlength=len(places)).astype(np.int64) < sizes
    holders[alone[at]] = MANY
    kinds, which = np.unique(at << 16 | holders, return_inverse=True)
    shared, at, holders = np.bincount(which.reshape(-1), n, minlength=len(kinds)).astype(np.int64), kinds >> 16, kinds & MANY
    last = holders == MANY  # each place has this row; it stands for the place
    columns = (_digest_array(digests[at]), pa.array(holders), pa.array(shared), pa.array(last.astype(np.int64)))
    return pa.table(columns, ["digest", "holders", "shared", "copies"]).filter(pa.array((shared > 0) | last & ~alone[at]))


def _token_lists(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in chunks(batches):
            h, at, d = sets_of(data, offsets, size)
            raw = _digest_array(d)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([raw, lists], ["digest", "tokens"])

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def partial_overlaps(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For some sets (tokens of set i from at[i] to at[i + 1]): how many tokens each pair has in common."""
    n = len(at) - 1
    total = np.zeros((n, n), np.int64)
    owner = np.repeat(np.arange(n), np.diff(at))
    order = np.argsort(tokens, kind="stable")  # owners stay in order within a token
    tokens, owner = tokens[order], owner[order]
    start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
    holders = np.diff(np.append(start, len(tokens)))
    sign = mix(np.arange(1, n + 1, dtype=np.uint64))
    sums = np.append(_U(0), np.cumsum(sign[owner], dtype=np.uint64))
    mark = sums[start + holders] - sums[start]
    _, first, weight = np.unique(mark[holders > 1], return_index=True, return_counts=True)  # tokens with the same holders
    start, holders = start[holders > 1][first], holders[holders > 1][first]
    few = holders <= FEW
    for gap in range(1, FEW):
        a, w, size = start[few], weight[few], holders[few]
        for place in range(FEW - gap):
            here = size > place + gap
            i, j = owner[a[here] + place], owner[a[here] + place + gap]
            total += np.bincount(i * n + j, w[here], n * n).reshape(n, n).astype(np.int64) if here.any() else 0
    start, holders, weight = start[~few], holders[~few], weight[~few]
    width = max(1, (1 << 21) // max(n, 1))
    for a in range(0, len(start), width):
        many = holders[a : a + width]
        place = np.repeat(start[a : a + width] - np.cumsum(many) + many, many) + np.arange(many.sum())
        dense = np.zeros((n, len(many)), np.float32)
        dense[owner[place], np.repeat(np.arange(len(many)), many)] = 1
        w = weight[a : a + width]
        for power in range(int(w.max()).bit_length()):  # exact: products of zeros and ones
            bit = (w >> power & 1).astype(bool)
            if bit.any():
                total += np.triu(dense[:, bit] @ dense[:, bit].T, 1).astype(np.int64) << power
    return total  # above the diagonal


def _cells(percent: int):
    """Rows arrive by cell, fragment and class. Out come edges (kind 0) and the documents that a class is linked with (kind 1)."""

    def judged(total: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, weights: np.ndarray, blocks: np.ndarray):
        n = len(nodes)
        total = total + total.T
        link = 100 * total >= percent * (sizes[:, None] + sizes[None, :] - total)
        if blocks.min() != blocks.max():
            link &= blocks[:, None] != blocks[None, :]  # pairs of one block have a cell of their own
        np.fill_diagonal(link, False)
        label = np.arange(n)
        while True:  # the least label among neighbours, and its label
            near = np.where(link, label[None, :], n).min(axis=1)
            new = np.minimum(label, near)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        other, linked = label != np.arange(n), link.any(axis=1)
        kind = np.repeat([0, 1], [other.sum(), linked.sum()])
        a = np.concatenate([nodes[label[other]], nodes[linked]])
        b = np.concatenate([nodes[other], (link[linked] * weights[None, :]).sum(axis=1)])
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, total, about = None, None, None
        for (name, _), rows in _runs(batches):
            nodes, sizes, weights, blocks = (np.concatenate([r.column(c).to_numpy(zero_copy_only=False) for r in rows]) for c in ("node", "n", "rows", "block"))
            lists = [_lists(r.column("tokens")) for r in rows]
            at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(a) for _, a in lists]))])
            part = partial_overlaps(np.concatenate([t for t, _ in lists]), at)
            if name != cell:
                if cell is not None:
                    yield judged(total, *about)
                cell, total, about = name, part, (nodes, sizes, weights, blocks)
            else:
                total += part
        if cell is not None:
            yield judged(total, *about)
        release()

    return run


def _runs(batches: Iterator[pa.RecordBatch]):
    """Slices of sorted batches with the same cell and fragment, collected."""
    key, held = None, []
    for batch in batches:
        cell, fragment = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fragment"))
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (fragment[1:] != fragment[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(cell)]):
            if a == b:
                continue
            if key != (cell[a], fragment[a]):
                if held:
                    yield key, held
                key, held = (cell[a], fragment[a]), []
            held.append(batch.slice(a, b - a))
    if held:
        yield key, held


def _survivors(texts: DataFrame, sizes: DataFrame, size: int, percent: int) -> DataFrame:
    """(digest, n) of the classes that have enough shingles in common with other classes."""
    many = max(partitions(texts.sparkSession), (sizes.agg(F.sum("n")).first()[0] or 0) // TOKENS_PER_FRAGMENT + 1)
    sent = texts.mapInArrow(_fragments(size, many), "fragment bigint, name bigint, digests binary, counts binary, owners binary, tokens binary")
    packed_counts = sent.withColumn("buckets", F.lit(many // 4 + 1)).groupBy("fragment").applyInArrow(_shared_places, "bucket bigint, digests binary, places binary, counts binary, holders binary")
    told = packed_counts.groupBy("bucket").applyInArrow(_summed_counts, "digest binary, holders bigint, shared bigint, copies bigint")
    told = told.groupBy("digest", "holders").agg(F.sum("shared").alias("shared"), F.sum("copies").alias("copies"))
    # every copy of a class counts; a token with more holders than the class has copies is in another class
    told = told.groupBy("digest").agg(F.sum("copies").alias("copies"), F.collect_list(F.struct("holders", "shared")).alias("told"))
    shared = told.select("digest", "copies", F.expr(f"aggregate(filter(told, t -> t.holders = {MANY} or t.holders > copies), 0L, (sum, t) -> sum + t.shared)").alias("shared"))
    return sizes.join(shared, "digest").where(F.col("shared") * 100 >= F.col("n") * percent * F.col("copies")).select("digest", "n", "rows")


def _ordered(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, rows, ranked): each class's shared shingles in the global order, if they are enough for a link."""
    each = sets.select("node", F.explode("tokens").alias("token"))
    common = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = each.join(common, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    return sets.select("node", "n", "rows").join(ranked, "node").where(F.size("ranked") * 100 >= F.col("n") * percent)


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(kind, a, b): edges between nodes that connect all linked classes, and sums of the rows that a node is linked with."""
    ordered = materialise(_ordered(sets, percent), "ordered")
    rare = F.col("n") - F.size("ranked")  # shingles of no other class; they come first
    prefix = ordered.select("node", "n", rare.alias("rare"), F.expr("slice(ranked.token, 1, cast(greatest(n - floor((n * %d + 99) / 100) + 1 - (n - size(ranked)), 0) as int))" % percent).alias("prefix"))
    postings = materialise(prefix.select("node", "n", "rare", F.explode("prefix").alias("token")), "postings")
    typical = F.struct((F.col("rare") / F.col("n")).alias("odd"), F.col("node").alias("home"))
    centres = postings.groupBy("token").agg(F.min(typical).alias("centre"))
    homes = materialise(postings.join(centres, "token").groupBy("node").agg(F.min("centre").alias("centre")).select("node", F.col("centre.home").alias("home")), "homes")

    # large homes are cut into blocks; small homes share blocks
    counts = homes.groupBy("home").agg(F.count(F.lit(1)).alias("members"))
    pools = F.greatest(F.lit(1), F.lit(2 * homes.count() // BLOCK))
    spread = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK))
    block = F.when(F.col("members") > BLOCK, F.xxhash64("home", spread)).otherwise(F.xxhash64(F.pmod(F.xxhash64("home"), pools)))
    blocks = materialise(homes.join(counts, "home").select("node", block.alias("block")), "blocks")
    meets = materialise(postings.select("node", "token").join(blocks, "node").select("token", "block").distinct(), "meets")
    several = meets.groupBy("token").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select("token")
    across = meets.join(several, "token")
    # of two blocks, a cell takes the classes that hold a prefix shingle of both; equal lists of blocks are paired once for a class
    lists = across.groupBy("token").agg(F.sort_array(F.collect_list("block")).alias("blocks")).withColumn("list", F.xxhash64("blocks"))
    member = postings.select("node", "token").join(lists.select("token", "list"), "token").select("node", "list").distinct().join(blocks, "node")
    met = member.join(lists.select("list", "blocks").dropDuplicates(["list"]), "list").select("node", "block", F.explode("blocks").alias("with"))
    own = blocks.select("node", "block", F.col("block").alias("with"))
    pair = (F.least("block", "with"), F.greatest("block", "with"))
    sides = materialise(met.where("block <> with").union(own).distinct().select("node", "block", F.xxhash64(*pair).alias("cell")), "cells")

    order = F.col("r.df") + (F.col("r.token") / F.lit(2.0**64) + 0.5)
    pivots = ordered.select(F.explode("ranked").alias("r")).agg(F.percentile_approx(order, [i / FRAGMENTS for i in range(1, FRAGMENTS)], 1000)).first()[0] or [0.0] * (FRAGMENTS - 1)
    place = lambda r: r["df"] + (r["token"] / F.lit(2.0**64) + 0.5)
    ends = [float("-inf"), *pivots, float("inf")]
    cut = lambda lo, hi: F.transform(F.filter("ranked", lambda r: (place(r) >= lo) & (place(r) < hi)), lambda r: r["token"])
    parts = F.array(*[F.struct(F.lit(f).alias("fragment"), cut(lo, hi).alias("tokens")) for f, (lo, hi) in enumerate(zip(ends, ends[1:]))])
    segments = materialise(ordered.select("node", "n", "rows", F.inline(parts)), "segments")
    placed = sides.join(segments, "node").select("cell", "fragment", "node", "n", "rows", "block", "tokens")
    many = max(partitions(sets.sparkSession), sides.select("cell").distinct().count() // CELLS)
    dealt = placed.repartition(many, "cell").sortWithinPartitions("cell", "fragment", "node")
    return materialise(dealt.mapInArrow(_cells(percent), "kind int, a bigint, b bigint"), "links")


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, class, component_id, n_links): class is a digest of the set, equal for equal sets; n_links is the number
    of other rows that a row is linked with, those of its own class included.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles.
    """
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), as_bytes("text").alias("text")).select("doc_id", F.xxhash64("text").alias("h"), "text")
    meta = materialise(texts.mapInArrow(_digests(size), "doc_id bigint, h bigint, n bigint, digest binary"), "set-digests")
    classes = meta.where("n > 0").groupBy("digest", "n").agg(F.min(F.struct("doc_id", "h")).alias("least"), F.count(F.lit(1)).alias("rows"))
    alive = materialise(_survivors(texts.select("text"), classes.select("digest", "n", "rows"), size, percent), "survivors")
    chosen = classes.join(alive.select("digest"), "digest").select("least.doc_id", "least.h").distinct()
    # rows that repeat id and text are one before they meet the chosen ones
    single = texts.groupBy("doc_id", "h").agg(F.min("text").alias("text"))
    lists = single.join(chosen, ["doc_id", "h"]).select("text").mapInArrow(_token_lists(size), "digest binary, tokens array<bigint>")
    sets = lists.join(alive, "digest").dropDuplicates(["digest"]).withColumn("node", F.monotonically_increasing_id())
    sets = materialise(sets.select("node", "digest", "n", "rows", "tokens"), "sets")
    found = _links(sets.select("node", "n", "rows", "tokens"), percent)
    roots = components(found.where("kind = 0").select("a", "b"))
    linked = found.where("kind = 1").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    known = classes.join(sets.select("digest", "node"), "digest", "left").join(roots, "node", "left").join(linked, "node", "left")
    known = known.withColumn("family", F.coalesce(F.col("root"), F.col("node"))).withColumn("n_links", F.col("rows") - 1 + F.coalesce("linked", F.lit(0)))
    named = materialise(known.select("digest", F.col("least.doc_id").alias("least"), "family", "n_links"), "families")
    names = named.where("family is not null").groupBy("family").agg(F.min("least").alias("name"))
    final = named.join(names, "family", "left").select("digest", F.coalesce("name", "least").alias("component"), "n_links")
    out = meta.join(final, "digest", "left")
    plain = lambda c: F.nullif(c, F.lit(NO_ID))
    name = F.coalesce("component", "doc_id")
    return out.select(plain(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("digest").alias("class"), plain(name).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def op7_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("class")
