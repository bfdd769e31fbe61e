import duckdb
import pytest
from pyspark.sql import functions as F

from contractlens.llm import fair_queue as fq
from contractlens.llm.common import word_count
from contractlens.llm.queries import DUCK_WORDS
from tests.llm.helpers import documents, prose


def water_fill(sizes, weights):
    """Targets by resharing the excess until none is above three times its source."""
    left, open_, target = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if 3 * sizes[i] <= level * weights[i]}
        for i in full or open_:
            target[i] = 3.0 * sizes[i] if full else level * weights[i]
            left -= target[i]
        open_ -= full or open_
    return target


def test_mix_matches_sql_and_targets(spark):
    rows = [(i, prose(i, 1 + i % 37), None, s) for i, s in enumerate((["hot"] * 20 + ["b", "c", None, "d", "é"]) * 24)]
    rows += [(9000, None, None, "empty"), (9001, "", None, None), (1, prose(1, 2), None, "hot"), (None, "a b c", None, "b"), (9002, "w " * 5000, None, "c")]
    mixed = fq.fair_mix(documents(spark, rows), word_count(F.col("text")))
    got = mixed.select("doc_id", "source", "size", "source_size", "target", "taken").toPandas()
    sources = sorted(got.source.dropna().unique(), key=lambda s: s.encode()) + [None]
    sizes = [int(got[got.source.isna() if s is None else got.source == s]["size"].sum()) for s in sources]
    wanted = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))])
    for s, target in zip(sources, wanted):
        own = got[got.source.isna() if s is None else got.source == s]
        assert own.target.tolist() == pytest.approx([target] * len(own))
        assert abs(own.taken.sum() - target) <= got["size"].max()
    assert (got.taken <= 3 * got["size"]).all() and got.taken.sum() <= got["size"].sum()
    con = duckdb.connect()
    documents_table = documents(spark, rows).select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.execute("create view documents as select cast(doc_id as bigint) as doc_id, text, source from documents_table")
    sql = con.execute(fq.oracle(DUCK_WORDS)).fetchdf()
    order = ["doc_id", "size", "source_size", "target", "taken"]
    plain = lambda f: sorted(tuple(round(float(x), 6) for x in r) for r in f[order].fillna(-1).itertuples(index=False))
    assert plain(got) == plain(sql)
    again = fq.repeat_taken(fq.fair_mix(documents(spark, rows), word_count(F.col("text"))), ["doc_id", "text"])
    assert again.select(F.sum(word_count(F.col("text")))).first()[0] == got.taken.sum()


def test_empty_and_wordless(spark):
    assert fq.fair_mix(documents(spark, []), word_count(F.col("text"))).count() == 0
    one = fq.fair_mix(documents(spark, [(1, None, None, "a"), (2, " ", None, None)]), word_count(F.col("text")))
    assert [(r["size"], r.target, r.taken) for r in one.collect()] == [(0, 0.0, 0)] * 2
