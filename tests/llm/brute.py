"""Plain Python versions of the operators, over whole lists."""

import collections
import fractions
import hashlib
import math
import re
import zlib

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, size):
    w = blank_words(text)
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def line_dedup(docs):
    """(doc_id, text) -> (doc_id, lines, dropped, kept text); ids as given, null smallest."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(SMALL)
    order = lambda i: -math.inf if i is None else i
    holders = collections.defaultdict(list)
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(order(i))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def components(docs, size, percent):
    """(doc_id, text) with different ids -> {doc_id: smallest id of its component}."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def link_counts(docs, size, percent):
    """(doc_id, text) -> {doc_id: number of other documents it is linked with}."""
    sets = {i: shingles(t, size) for i, t in docs}
    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    return {i: sum(bool(i != j and near(a, b)) for j, b in sets.items()) for i, a in sets.items()}


def contamination(docs, items, size=10):
    """(doc_id, words, hit words, items) per document."""
    windows = collections.defaultdict(set)
    for i, t in items:
        w = letter_words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    lengths = {len(k) for k in windows}
    out = []
    for i, t in docs:
        w = letter_words(t)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    found |= got
                    hit[k : k + n] = [True] * n
        out.append((i, len(w), sum(hit), sorted(found)))
    return out


def held(doc_id, m, rest):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m == rest


def base_scores(docs):
    """(doc_id, tokens, known, training tokens, base) per document."""
    texts = [(i, [*blank_words(t), None]) for i, t in docs]
    counts = collections.Counter(w for i, ws in texts if not held(i, 7, 2) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in texts]


def integers(vector, scale=64, shift=0):
    """floor(scale * c) + shift of every component; None when the vector takes no part."""
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(scale * c) + shift for c in vector]


def top_k(rows, k=20, every=20):
    """(vec_id, vector) -> (query_id, rank, vec_id, score) of every row that is a query."""
    known = [(i, x) for i, v in rows if (x := integers(v)) is not None]
    out = []
    for at, (query, x) in enumerate(known):
        if query is None or query % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), math.inf if i is None else i) for n, (i, y) in enumerate(known) if n != at)
        out += [(query, rank, None if i == math.inf else i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def whitening_parts(rows):
    """Exact n, sums and deviations of the distinct x: (n, S, {x: deviation})."""
    distinct = sorted({tuple(x) for _, v in rows if (x := integers(v, shift=1_000_000)) is not None})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    return n, sums, {x: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in distinct}


def collocations(docs, least, longest=5, first=2000):
    """(lang, text) -> (lang, rank, phrase, a, l, r, n, score), by counting every phrase."""
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = {p[i : i + k] for p in often for k in range(2, len(p)) for i in range(len(p) - k + 1) if f[p] >= f[p[i : i + k]]}
        found = []
        for p in set(often) - inside:
            score, cut = min((fractions.Fraction(1000 * f[p] * totals[lang], f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, rank, p.decode(), -a, l, r, totals[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1)]
    return out
