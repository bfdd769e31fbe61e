import numpy as np

from contractlens.llm import dart_minhash as dm
from tests.llm.helpers import bag, documents, near_classes, prose


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = f"changed{p}"
    return " ".join(words)


def test_agreement_estimates_weighted_similarity():
    base = prose(1, 400)
    for text in (edited(base, [50]), edited(base, range(0, 400, 40)), base + " " + base, base[: len(base) // 2]):
        a, b = bag(base), bag(text)
        wanted = sum((a & b).values()) / sum((a | b).values())
        sign, _ = dm.signatures([base, text])
        assert abs((sign[0] == sign[1]).mean() - wanted) < 4 * np.sqrt(wanted * (1 - wanted) / dm.COORDINATES) + 0.01


def test_classes_match_all_pairs(spark):
    rows, i = [], 0
    for seed in range(25):
        base = prose(seed, 60 + 20 * seed)
        rows += [(i, base), (i + 1, edited(base, [10])), (i + 2, edited(base, [10, 30])), (i + 3, edited(base, range(0, 60, 8)))]
        i += 4
    base = prose(99, 300)
    rows += [(1000 + k, edited(base, [k])) for k in range(120)]  # one large group of near copies
    rows += [(2000 + k, "one two three") for k in range(3)] + [(3000, "one two"), (3001, "a b c d e f"), (3002, "a b c d e")]
    out = dm.near_duplicates(documents(spark, rows)).toPandas()
    assert dict(zip(out.doc_id, out.class_id)) == near_classes(rows)


def test_edges(spark):
    long = prose(5, 30_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, long.replace(" ", "\n")), (6, long + " more"), (None, long), (7, "x"), (7, "x")]
    out = sorted(dm.near_duplicates(documents(spark, rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.class_id) for r in out[:-1]] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 4), (7, 7), (7, 7)]
    assert dm.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.class_id for r in dm.components(edges).filter("id < 100").collect()} == {0}
