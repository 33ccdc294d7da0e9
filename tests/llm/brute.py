"""Plain versions of the operators, row by row, to test against."""

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash

from siltline.llm import substrings


def roots(nodes, links):
    """Smallest node reachable from each."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    grams = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def simhash_groups(rows):
    """Smallest id of each row's group; rows are (id, text)."""
    codes = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(codes))
    low = roots(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 3])
    least = {}
    for (doc, _), code in zip(rows, codes, strict=True):
        known = least.get(low[code])
        least[low[code]] = doc if known is None else known if doc is None else min(known, doc)
    return [least[low[c]] for c in codes]


def chunk_borders(raw):
    """Chunk starts by a walk over the bytes, and the end."""
    starts, last, code = [0], 0, 0
    for at in range(len(raw)):
        if at:
            word = raw[at - 1] in b"\t\n\x0b\x0c\r " and raw[at] not in b"\t\n\x0b\x0c\r "
            char = raw[at] & 0xC0 != 0x80
            marked = word and code & 0b1100_0000 == 0 or char and code & 0b1111_1110 == 0
            if marked and at - last >= substrings.LEAST:
                starts.append(at)
                last = at
            elif char and at - last >= substrings.MOST:
                starts.append(at)
                last = at
        code = (2 * code + int(substrings.GEAR[raw[at]])) % 256
    return [*starts, len(raw)]


def substring_dedup(rows, min_words, min_bytes=400):
    """The text left of each row; rows are (id, text)."""
    first, found = {}, []
    key = lambda r: (r[0] is not None, r[0] or 0, xxhash_of(r[1]))
    for at in sorted(range(len(rows)), key=lambda i: key(rows[i]) if rows[i][1] is not None else (False, 0, 0)):
        doc, text = rows[at]
        if text is None:
            continue
        raw = text.encode()
        borders = chunk_borders(raw) if raw else []
        heads = [m.start() for m in re.finditer(rb"(?<![^\t-\r ])[^\t-\r ]", raw)]
        words = lambda a, b: bisect_left(heads, b) - bisect_left(heads, a)  # noqa: E731, B023
        enough = lambda a, b: words(a, b) >= min_words or b - a >= min_bytes  # noqa: E731, B023
        spans = {}
        for i, begin in enumerate(borders[:-1]):
            for end in borders[i + 1 :]:
                if enough(begin, end):
                    spans[begin, end] = True
                    break
        to_end = [begin for begin in borders[:-1] if enough(begin, len(raw))]
        if to_end:
            spans[to_end[-1], len(raw)] = True
        for begin, end in spans:
            place = (doc, text, begin << 32 | end)
            if first.setdefault(raw[begin:end].strip(), place) != place:
                found.append((doc, text, begin, end))
    out = []
    for doc, text in rows:
        cut = {i for d, t, b, e in found if (d, t) == (doc, text) for i in range(b, e)}
        out.append(text and bytes(c for i, c in enumerate(text.encode()) if i not in cut).decode())
    return out


def xxhash_of(text):
    return xxhash.xxh64_intdigest(text.encode(), seed=42) & 0x7FFFFFFF


def shingles(text, width):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def contained(docs, items, threshold=0.8, words=5):
    out = set()
    for item, text in items:
        if text is None or not (count := len([w for w in re.split(r"[\W_]+", text.lower()) if w])):
            continue
        width = min(count, words)
        wanted = shingles(text, width)
        for doc, body in docs:
            if body is not None and len(wanted & shingles(body, width)) / len(wanted) >= threshold:
                out.add((doc, item))
    return out


def bigram_scores(rows, *, min_share, min_pair_share, k=1.0, m=20.0):
    """(tokens, target loss, background loss) per row; rows are (text, is target)."""
    split = [((t or "").lower().encode().split(), bool(mark)) for t, mark in rows]
    n = sum(len(w) for w, _ in split)
    total = Counter(w for words, _ in split for w in words)
    known = {w for w, c in total.items() if c >= min_share * n}
    texts = [([w if w in known else "?" for w in words], mark) for words, mark in split]
    word, pair, context = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for words, mark in texts:
        side = 0 if mark else 1
        for before, w in zip(["^", *words], words, strict=False):
            word[side][w] += 1
            pair[side][before, w] += 1
        context[side]["^"] += bool(words)
    listed = {p for p in pair[0] + pair[1] if pair[0][p] + pair[1][p] >= min_pair_share * n}
    sizes = [sum(c.values()) for c in word]
    if not all(sizes):
        word, pair, context = ([c[0] + c[1]] * 2 for c in (word, pair, context))
        sizes = [sum(c.values()) for c in word]
    scale = [1.0, sizes[0] / sizes[1] if sizes[1] else 1.0]
    pooled = {w: (word[0][w] + word[1][w] * scale[1]) / (2 * sizes[0]) for w in word[0] + word[1]}
    start = [sum(c for p, c in pair[s].items() if p[0] == "^" and p in listed) for s in (0, 1)]
    out = []
    for words, _ in texts:
        losses = []
        for s in (0, 1):
            loss = 0.0
            for before, w in zip(["^", *words], words, strict=False):
                p = (word[s][w] * scale[s] + k * sizes[0] * pooled[w]) / (sizes[0] * (1 + k))
                c = (start[s] if before == "^" else word[s][before]) * scale[s]
                seen = pair[s][before, w] * scale[s] if (before, w) in listed else 0.0
                loss -= math.log((seen + m * p) / (c + m))
            losses.append(loss / max(len(words), 1))
        out.append((len(words), *losses))
    return out


def embeddings(rows, threshold=0.98):
    def sound(r):
        v = r.embedding
        return r.label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, r in enumerate(rows) if sound(r)]
    n, links = [0] * len(rows), []
    for i, j in combinations(good, 2):
        a, b = rows[i], rows[j]
        if a.label == b.label and len(a.embedding) == len(b.embedding):
            x, y = np.array(a.embedding, float), np.array(b.embedding, float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                links.append((i, j))
    low = roots(range(len(rows)), links)
    ids = {}
    for i, r in enumerate(rows):
        ids[low[i]] = min(ids.get(low[i], r.vec_id), r.vec_id)
    return sorted((r.vec_id, n[i], ids[low[i]], r.vec_id == ids[low[i]]) for i, r in enumerate(rows))
