import base64
import hashlib

from hypothesis import given
from hypothesis import strategies as st

from contractlens.llm import warc_index as wi

ROWS = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("12"), st.one_of(st.none(), st.integers(0, 9))), max_size=8)


@given(st.lists(ROWS, max_size=9))
def test_loser_tree_merges(runs):
    full = [sorted([(u, t, i, None, "", None, 0, "", "f", n) for n, (u, t, i) in enumerate(r)], key=wi.order) for r in runs]
    merged = [wi.order(x) for x in wi.LoserTree(full)]
    assert merged == sorted(wi.order(x) for r in full for x in r)


def test_round_trip(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nend\r\n\r\n"
    pages = [(5, "http://www.B.example/x?q=1#f", tricky), (3, "http://b.example/x?q=1", tricky), (4, None, None), (9, "not a url\r\nx", ""), (8, "http://[bad", "é" * 300_000),
             (2, "http://a.example:80/", "same"), (7, "http://a.example/", "same"), (2, "http://a.example:80/", "same"), (None, "http://c.example/", "own")]
    data = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, payload string, file int")
    out = wi.archive(data).collect()
    assert [(r.url_key, r.captured) for r in out] == sorted((r.url_key, r.captured) for r in out)
    assert len(out) == len(pages)
    smallest = {}
    for i, _, html in pages:
        if i is not None:
            smallest[html or ""] = min(i, smallest.get(html or "", i))
    by_id = {r.page_id: r for r in out}
    for i, url, html in pages:
        body = (html or "").encode()
        r = by_id[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        first = smallest.get(html or "", i)
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert wi.archive(empty).count() == 0


def test_payloads_are_hashed_once(spark):
    """Once for the pages and once for the first page of each payload; filters that test the key do not hash it again."""
    data = spark.createDataFrame([(1, "u", "x"), (2, "u", "x"), (3, "u", None)], "page_id long, url string, html string")
    found = wi.with_revisits(data)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha1(") == 2
    assert {r.page_id: (r.payload_digest, r.refers_to) for r in found.collect()} == {
        i: (base64.b32encode(hashlib.sha1(body).digest()).decode(), first) for i, body, first in [(1, b"x", None), (2, b"x", 1), (3, b"", None)]
    }
