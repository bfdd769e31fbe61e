"""Small tables and plain Python versions that the operators are held to."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]), with columns whose names operators also use."""
    full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
    clash = ", size long, id long, copy string, spans string, kept string, langs string, taken long, line long, n_words long"
    return spark.createDataFrame([(*r, *[None] * 9) for r in full], DOCS + clash)


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    rng = random.Random(seed)
    return " ".join(f"{'abcdefghij'[rng.randrange(10)]}w{rng.randrange(vocabulary)}" for _ in range(words))


def bag(text, width=5):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else Counter()


def near_classes(rows, threshold=0.8):
    """Smallest id of the class of every id, by comparing all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in rows}
    holders = defaultdict(list)
    for i, b in bags.items():
        for s in b:
            holders[s].append(i)
    parent = {i: i for i in bags}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        if sum((bags[x] & bags[y]).values()) >= threshold * sum((bags[x] | bags[y]).values()):
            a, b = sorted((find(x), find(y)))
            parent[b] = a
    return {i: find(i) for i in bags}


def repeated_bytes(texts, length):
    """Removed spans of every text: bytes in a window that starts at two places or more."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        edges = [i for i in range(len(b) + 1) if (gone[i] if i < len(b) else False) != (gone[i - 1] if i else False)]
        out.append((b, list(zip(edges[0::2], edges[1::2])), bytes(x for x, g in zip(b, gone) if not g)))
    return out
