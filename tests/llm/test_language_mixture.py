import random

from pyspark.sql import functions as F

from contractlens.llm import language_mixture as lm
from contractlens.llm.common import table
from tests.llm.helpers import documents

SYLLABLES = {"aa": ["ka", "ro", "mi"], "bb": ["sch", "ung", "ter"]}


def speech(lang, words, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(words))


def test_mixtures_and_edges(spark):
    train = documents(spark, [(i, speech(g, 80, i), g) for i in range(20) for g in SYLLABLES] + [(99, None, "aa"), (98, "ka", None)])
    model = lm.learn(train)
    assert model.languages == ["aa", "bb"]
    both = speech("aa", 60, "x") + " " + speech("bb", 30, "x")
    rows = [(1, speech("aa", 50, "t")), (2, speech("bb", 50, "t")), (3, both), (4, None), (5, ""), (6, "12 34 !!"), (None, speech("bb", 9, "n")),
            (7, speech("aa", 40_000, "long")), (1, speech("aa", 50, "t"))]
    out = lm.predict(documents(spark, rows), model).collect()
    got = {(r.doc_id, r.lang_pred): r for r in out}
    assert len(out) == len(rows)
    assert got[(1, "aa")].score == 1.0 and got[(2, "bb")].langs == ["bb"] and (7, "aa") in got and (None, "bb") in got
    assert got[(3, "aa")].langs == ["aa", "bb"] and abs(got[(3, "aa")].score - 2 / 3) < 0.05
    assert [got[(i, "und")].score for i in (4, 5, 6)] == [0.0] * 3


def test_without_rows_or_labels(spark):
    empty = lm.learn(documents(spark, []))
    assert empty.languages == []
    assert lm.predict(documents(spark, [(1, "word")]), empty).collect()[0].lang_pred == "und"
    assert lm.predict(documents(spark, []), empty).count() == 0


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = lm.is_held_out(F.col("doc_id"))
    found = lm.predict(docs.filter(held_out & F.col("lang").isNotNull()), lm.learn(docs.filter(~held_out)), keep=("doc_id", "lang")).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
