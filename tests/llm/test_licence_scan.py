import re
from collections import Counter

from contractlens.llm import licence_scan as ls
from tests.llm.helpers import documents, prose


def bag(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return Counter(zip(words, words[1:]))


def brute(text):
    """line -> (licence, dice) by comparing every unit with every template."""
    if text is None:
        return {}
    lines = text.split("\n")
    units = ([(0, text)] if len(lines) > 1 else []) + list(enumerate(lines, 1))
    out = {}
    for at, unit in units:
        a = bag(unit)
        best = max(((2 * sum((a & bag(t)).values()) / (sum(a.values()) + sum(bag(t).values())), n) for n, t in ls.TEMPLATES), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
        if a and best[0] >= 0.8:
            out[at] = (best[1], round(best[0], 9))
    return out


def test_matches_every_template(spark):
    notices = [t for _, t in ls.TEMPLATES]
    texts = [*notices, *[t.upper().replace(" ", "  -- ") for t in notices], *[prose(i, 20) + "\n" + t + "\n" + prose(i + 1, 9) for i, t in enumerate(notices)]]
    texts += [n.replace("License", "Licence", 1) for n in notices] + ["Released under the\nMIT License.", "MIT", "the the the", prose(1, 30_000), "", None, " \n "]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    got = {}
    for r in ls.scan(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.line] = (r.licence, round(r.dice, 9))
    assert got == {i: b for i, t in enumerate(texts) if (b := brute(t))}


def test_one_row_per_document(spark):
    rows = [(1, "Released under the MIT License.\nLicensed under CC BY 4.0."), (2, None), (None, "Released under the MIT License.")]
    out = {r.doc_id: (r.licences, r.n_matches) for r in ls.by_document(documents(spark, rows)).collect()}
    assert out == {1: ("CC-BY-4.0,MIT", 2), 2: ("", 0), None: ("MIT", 1)}
    assert ls.by_document(documents(spark, [])).count() == 0
