import hashlib
import random
from collections import Counter

import pytest

from contractlens.llm import parse_dedup as pd_
from tests.llm.helpers import WORD, documents, prose, repeated_bytes


def texts_of(seed):
    rng = random.Random(seed)
    parts = [prose(seed * 100 + k, 40) for k in range(6)] + ["ä€😀" * 40, "a" * 700, "ab" * 300, "é" * 500]
    made = []
    for _ in range(40):
        pieces = [rng.choice(parts) if rng.random() < 0.4 else prose(rng.randrange(10**6), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 5))]
        text = " ".join(pieces)
        cut = rng.randrange(len(text))
        made.append(text[cut:] if rng.random() < 0.3 else text)
    return made + [None, "", "x", made[0], made[1][: len(made[1]) // 2]]


@pytest.mark.parametrize("length", [400, 150, 40])
def test_spans_match_all_windows(spark, length):
    texts = texts_of(length)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (5, "another text under one id " * 9), (None, texts[4])]
    wanted = repeated_bytes([t for _, t in rows], length)
    out = pd_.repeated_spans(documents(spark, rows), length=length).collect()
    key = lambda i, whole: (-1 if i is None else i, whole)
    expected = sorted((key(i, hashlib.sha256(b).hexdigest()), spans, kept) for (i, _), (b, spans, kept) in zip(rows, wanted))
    got = sorted(
        (key(r.doc_id, r.whole_sha256), [(s.start, s.end) for s in r.spans or []], bytes(r.kept) if r.spans else None) for r in out
    )
    assert [(k, s) for k, s, _ in got] == [(k, s) for k, s, _ in expected]
    assert all(g[2] is None or g[2] == e[2] for g, e in zip(got, expected))


def test_cut_text_and_empty_table(spark):
    passage = prose(7, 90)
    rows = [(1, f"one ä{passage}ß two"), (2, f"three {passage} four"), (3, "five"), (4, None)]
    left = {r.doc_id: r.text for r in pd_.without_repeats(documents(spark, rows)).collect()}
    assert left == {1: "one äß two", 2: "three  four", 3: "five", 4: None}
    assert pd_.repeated_spans(documents(spark, [])).count() == 0


def repeated_words(texts, words, across):
    """Mask of the words of every text in a window of ``words`` words that is held twice (by two texts)."""
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter()
    for w in split:
        grams = [tuple(w[p : p + words]) for p in range(len(w) - words + 1)]
        seen.update(set(grams) if across else grams)
    out = []
    for w in split:
        gone = [False] * len(w)
        for p in range(len(w) - words + 1):
            if seen[tuple(w[p : p + words])] > 1:
                gone[p : p + words] = [True] * words
        out.append(gone)
    return out


def worded(seed):
    rng = random.Random(seed)
    parts = [prose(seed * 50 + k, 70, 400) for k in range(5)] + ["a " * 130, "one two " * 60, "é ß " * 70]
    made = []
    for _ in range(50):
        pieces = [rng.choice(parts) if rng.random() < 0.4 else prose(rng.randrange(10**6), rng.randrange(1, 50), 400) for _ in range(rng.randrange(1, 5))]
        words = " ".join(pieces).split()
        words = words[rng.randrange(len(words)) :] if rng.random() < 0.5 else words
        made.append("".join(w + rng.choice([" ", "\n", "  "]) for w in words))
    # passages that only one text repeats, also beside a kind that others hold
    alone = prose(seed + 77, 60, 400)
    return made + [None, "", "x", f"{alone} y {alone} z {alone}", f"{parts[0]} {alone[::-1]} {parts[0]} {alone[::-1]}", made[0]]


@pytest.mark.parametrize("words", [51, 12])
def test_word_windows(spark, words):
    texts = worded(words)
    docs = documents(spark, list(enumerate(texts)))
    keyed = pd_.identity(docs, "doc_id", "text")
    for across in (True, False):
        wanted = repeated_words(texts, words, across)
        got = {r.id: r for r in pd_.repeated(keyed, words, pd_.WORDS, across=across).collect()}
        for i, gone in enumerate(wanted):
            mask = [False] * len(gone)
            for s in got[i].spans if i in got else []:
                mask[s.start : s.end] = [True] * (s.end - s.start)
            assert mask == gone, (across, i)
    cut = {r.doc_id: r.text for r in pd_.without_repeats(docs, length=words, unit=pd_.WORDS).collect()}
    for i, gone in enumerate(repeated_words(texts, words, False)):
        assert WORD.findall(cut[i] or "") == [w for w, g in zip(WORD.findall(texts[i] or ""), gone) if not g]
        assert cut[i] == texts[i] or any(gone)


def test_passages_beside_spans(spark):
    short = prose(3, 55, 9)  # 55 short words: fewer than 400 bytes
    own = prose(4, 60)
    rows = [(1, f"{prose(5, 30)} {short}"), (2, f"{short} {prose(6, 30)}"), (3, f"{own} and {own}"), (4, prose(7, 100)), (None, short), (None, "another")]
    out = {(r.doc_id, r.n_bytes): r for r in pd_.with_passages(documents(spark, rows)).collect()}
    assert len(out) == 6
    held = {k: sum(s.end - s.start for s in r.passages or []) for k, r in out.items()}
    assert sorted(held.values()) == [0, 0, 0, 55, 55, 55]
    assert pd_.with_passages(documents(spark, [])).count() == 0
