import random

import corpus_pipeline as cp
from contractlens.llm.common import DOCUMENT_COLUMNS, table
from tests.llm.helpers import WORD, documents, near_classes, prose
from tests.llm.test_parse_dedup import repeated_words

SF = "/root/testdata/sf0.001"


def without(text, gone):
    """The text without its marked words; runs go with the white space inside."""
    places = [m.span() for m in WORD.finditer(text)]
    keep = [True] * len(text)
    for n, (start, end) in enumerate(places):
        if gone[n]:
            start = places[n - 1][1] if n and gone[n - 1] else start
            keep[start:end] = [False] * (end - start)
    return "".join(c for c, k in zip(text, keep) if k)


def test_no_text_is_lost_among_near_copies(spark):
    a, b, c = (prose(k, 60) for k in (1, 2, 3))
    rows = [(5, a), (5, b), (3, a), (None, c), (None, c), (None, prose(4, 60)), (7, None), (7, ""), (9, a + " end")]
    got = dict(cp.STAGES)["near_copies"](spark, documents(spark, rows), SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, a), (5, b), (None, c), (None, prose(4, 60)), (7, None), (7, "")], key=str)


def test_stages_match_plain_versions(spark):
    docs = table(spark, SF, "documents")
    stages = dict(cp.STAGES)
    good = stages["quality_rules"](spark, docs, SF).cache()
    assert 0 < good.count() < docs.count()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    unique = stages["near_copies"](spark, good, SF).cache()
    classes = near_classes(rows)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, c in classes.items() if i == c)
    cut = stages["repeated_passages"](spark, unique, SF).cache()
    left = [(r.doc_id, r.text) for r in unique.collect()]
    gone = repeated_words([t for _, t in left], 51, False)
    wanted = {i: without(t, g) for (i, t), g in zip(left, gone)}
    assert {r.doc_id: r.text for r in cut.collect()} == wanted
    mixed = stages["mix_sources"](spark, cut, SF).cache()
    assert {r.doc_id for r in mixed.collect()} <= set(wanted)
    coded = stages["encode_pieces"](spark, mixed, SF)
    assert coded.count() == mixed.count() and {"doc_id", "ids", "decoded"} <= set(coded.columns)
    for stage in (good, unique, cut, mixed):
        assert stage.columns == DOCUMENT_COLUMNS


def test_empty_and_odd_rows_pass_every_stage(spark):
    text = prose(1, 60)
    for rows in (
        [],
        [(1, None), (2, ""), (None, text), (3, text, None, "s"), (3, text, None, "s"), (4, text + " x", "en", None), (5, prose(2, 40))],
    ):
        docs = documents(spark, rows)
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, SF).cache()
        assert docs.count() >= (1 if rows else 0)


def test_passages_of_51_short_words_are_cut(spark):
    rng = random.Random(5)
    words = lambda n, sizes: " ".join("".join(rng.choices("abcdefghij", k=rng.choice(sizes))) for _ in range(n))
    passages = [words(51, s) for s in ([1], [1, 2], [1, 2, 3], [2, 3, 4], [5, 6])] + [words(50, [1])]
    assert len(passages[0]) == 101 and len(passages[3]) < 300 < len(passages[4])
    held = lambda k, i, p: f"{prose(100 + 2 * k + i, 30)} {'xy'[i]} {p} {'xy'[i]} {prose(300 + 2 * k + i, 30)}"
    rows = [(2 * k + i, held(k, i, p)) for k, p in enumerate(passages) for i in range(2)]
    cut = dict(cp.STAGES)["repeated_passages"](spark, documents(spark, rows), SF)
    assert {r.doc_id: r.text for r in cut.collect()} == {2 * k + i: held(k, i, p if k == 5 else "") for k, p in enumerate(passages) for i in range(2)}
