import random
from collections import Counter

from contractlens.llm import adaptive_quality as aq
from tests.llm.helpers import WORD, documents, prose


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts_match_plain_python(spark):
    rng = random.Random(4)
    odd = ["a", "b", " ", "\n", "\t", "\x0b", "#", "|", "é", "😀", "c d e f g ", "\n\n", " "]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(0, 80))) for _ in range(400)]
    texts += [None, "", " \n ", "one two three four five", "w " * 30_000, prose(1, 20_000) + "\n" + prose(2, 50), "a b c d e a b c d e"]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    out = aq.with_counts(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(texts[r.doc_id]), repr(texts[r.doc_id])[:200]
        assert r.base_failed == (got[0] < 10 or 100 * got[4] > 20 * got[0])


def test_limits_follow_the_group(spark):
    plain = [(i, prose(i, 60), "xx", "s") for i in range(300)]
    signs = [(1000 + i, prose(i, 60).replace(" ", " # "), "yy", "s") for i in range(300)]  # this language writes so
    odd = [(5000, prose(1, 60).replace(" ", " # "), "xx", "s"), (5001, prose(1, 60), "xx", None), (5002, prose(2, 60), None, None),
           (5003, prose(3, 60).replace(" ", " # "), "xx", "small"), (5004, None, "xx", "s")]
    kept = {r.doc_id: r.kept for r in aq.judge(documents(spark, plain + signs + odd)).collect()}
    assert all(kept[i] for i, *_ in plain + signs) and kept[5001] and kept[5002]
    assert not kept[5000] and not kept[5003] and not kept[5004]
    assert aq.judge(documents(spark, [])).count() == 0


def test_sketch_edges(spark):
    values = [0, 1, 127, 128, 129, 255, 256, 1000, 10**6, 2**40 + 12345]
    out = spark.createDataFrame([(v,) for v in values], "v long").select("v", aq.edge(aq.F.col("v")).alias("e")).collect()
    assert all(r.e <= r.v <= r.e * (1 + 1 / 64) and (r.v >= 128 or r.e == r.v) for r in out)
