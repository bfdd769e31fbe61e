import math
import random
import re
from collections import Counter, defaultdict

import pytest

from contractlens.llm import disclosure as dc
from tests.llm.helpers import documents, prose

TOKEN = re.compile(dc.PLAIN["email"] + r"|[^\W_]+")


def words_of(text):
    return [m[0] for m in TOKEN.finditer(text.lower()) if "@" not in m[0]]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + n % 2), 10)) for n, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    good = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, p in dc.PLAIN.items() for m in re.finditer(p, text) if good[k](m[0])]


def mentions_of(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    for kind, pattern in dc.PLAIN.items():
        kept = {(s, e) for k, s, e in base_spans(text) if k == kind}
        every = [(m.start(), m.end()) for m in re.finditer(pattern, text)]
        for n, (s, e) in enumerate(every):
            if (s, e) not in kept:
                continue
            before = text[every[n - 1][1] if n else 0 : s]
            after = text[e : every[n + 1][0] if n + 1 < len(every) else len(text)]
            left = words_of(before[-dc.REACH :])
            right = words_of(after[: dc.REACH])
            left = left[1:] if len(before) > dc.REACH else left
            right = right[:-1] if len(after) > dc.REACH else right
            name = {"email": text[s:e].lower(), "ip": text[s:e]}.get(kind, digits(text[s:e]))
            yield f"{kind}:{name}", left[-dc.WORDS :] + right[: dc.WORDS]


def brute(texts):
    """(spans of every text, cleaned words of every text) by plain loops."""
    pair, around, surroundings, here = Counter(), Counter(), defaultdict(set), []
    for t in texts:
        here.append(list(mentions_of(t)))
        for entity, words in here[-1]:
            for w in words:
                pair[entity, w] += 1
                around[entity] += 1
                surroundings[entity, w].add(tuple(words))
    count = Counter(w for t in texts for w in words_of(t))
    n = sum(count.values())

    def tells(both, entity, single):
        information = math.log2(n / around[entity])
        return information > 0 and math.log2(min(both, single) * n / (around[entity] * single)) >= dc.ALPHA * information - dc.ROUNDING

    mask = {}
    for (entity, w), both in pair.items():
        if len(surroundings[entity, w]) >= dc.CONTEXTS and tells(both, entity, count[w]):
            start = w[: dc.PREFIX]
            wide = sum(k for (e, v), k in pair.items() if e == entity and v[: dc.PREFIX] == start)
            single = sum(k for v, k in count.items() if v[: dc.PREFIX] == start)
            mask[entity, w] = start + "*" if len(w) > dc.PREFIX and not tells(wide, entity, single) else ""
    out = []
    for t, found in zip(texts, here):
        own = defaultdict(list)
        for entity, words in found:
            for w in words:
                if (entity, w) in mask:
                    own[w].append(mask[entity, w])
        spans = base_spans(t) + [("term", m.start(), m.end()) for m in TOKEN.finditer(t) if m[0].lower() in own]
        out.append((spans, {w: min(m) for w, m in own.items()}))
    return out


def check(spark, rows):
    got = {r.doc_id: r for r in dc.sanitise(documents(spark, rows)).collect()}
    wanted = brute([t or "" for _, t in rows])
    for (i, t), (spans, masks) in zip(rows, wanted):
        text = lambda s: ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        base = [s for s in spans if s[0] != "term"]
        assert got[i].spans == text(spans), (i, t[:200])
        assert got[i].base == text(base)
        assert [got[i][f"n_{k}"] for k in dc.PLAIN] == [sum(s[0] == k for s in base) for k in dc.PLAIN]
    return got, {i: m for (i, _), (_, m) in zip(rows, wanted)}


EDGES = [
    "a@b.c", "x a@b.com_x@d.com y", "a@b a@b.c.d. mail:+tag%x_1@h-o.st.org@z.de", "bücher.x@y.de 12.34.56.78.9.10.11.12", "256.1.1.1 1.2.3.4",
    "0255.000.1.00 1.2.3 999999999999999999.1.1.1", "4111 1111-1111 1111", "4111111111111112 4111 1111 1111 1111 1", "4111  1111 1111 1111", "5", "55",
    "+1 (743) 555-3824 +4912 ++49 30 1234567+1 2", "+1", "+12345678901234567890", "+1 (((((( 2345678", "é+49 30 123456 😀 a@b.de 😀 1.1.1.1", "", None, "\n\n", "@@@ ... +++",
    "6011000990139424 6011-0009-9013-9424\n6011 0009\n9013 9424", "x@y.z" * 40, "1.1.1.1." * 30,
]


def test_patterns_match_the_plain_ones(spark):
    rng = random.Random(7)
    alphabet = ["a", "Z", "7", "12", "0", "255", "256", ".", "@", "-", "+", " ", "(", ")", "_", "%", "é", "😀", "\n", "4111111111111111", "x@y.de", "+49 30 1234567"]
    noise = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(500)]
    check(spark, list(enumerate(EDGES + noise)))


def planted():
    rng = random.Random(11)
    rows = [(i, prose(i, 60)) for i in range(60)]
    mails = ["h.zwicker@uni.example", "info@firm.example"]
    for n in range(6):  # the surname and the street stand beside the address only; other words vary
        far = "" if n else "later ZWICKER went"
        rows.append((100 + n, f"{prose(500 + n, 20)} Zwicker of Kirchgasse, {mails[0]} {prose(600 + n, 20)} {far} {prose(700 + n, 12)}"))
    for n in range(6):  # a word that is common elsewhere tells nothing
        rows.append((200 + n, f"{prose(800 + n, 20)} office {mails[1]} {prose(900 + n, 20)}"))
    rows += [(300 + n, f"{prose(1000 + n, 10)} office {prose(1100 + n, 10)} kirchner kirsch kirche") for n in range(40)]
    rows += [(400 + n, "only one surrounding marmalade +49 30 1234567 here") for n in range(20)]  # copies prove nothing
    rng.shuffle(rows)
    return rows


def test_revealing_words_are_masked(spark):
    got, masks = check(spark, planted())
    assert all({"zwicker", "kirchgasse"} <= set(masks[100 + n]) for n in range(6))
    assert masks[100]["kirchgasse"] == "kir*" and masks[100]["zwicker"] == ""
    assert not any(masks[200 + n] for n in range(6)) and not any(masks[400 + n] for n in range(20))
    clean = got[100].clean_text
    assert "<EMAIL>" in clean and "zwicker" not in clean.lower() and " kir*," in clean and clean.count(" later  went ") == 1
    assert got[400].clean_text == "only one surrounding marmalade <PHONE> here"
    assert got[0].clean_text == got[0].text


def test_copies_ties_and_odd_rows(spark):
    rows = planted()
    check(spark, rows + [(2000 + n, rows[0][1]) for n in range(80)] + [(3000, None), (3001, "")])
    got = dc.sanitise(documents(spark, [(None, "a@b.de"), (1, "a@b.de"), (1, "x"), (1, "a@b.de")])).select("doc_id", "spans").collect()
    assert sorted((r.doc_id or 0, r.spans) for r in got) == [(0, "email:0:6"), (1, ""), (1, "email:0:6"), (1, "email:0:6")]
    assert dc.sanitise(documents(spark, [])).count() == 0


LONG = {
    "a" * 1_000_000: [],
    "1" * 1_000_000: [],
    "1." * 200_000: [("ip", n, n + 7) for n in range(0, 400_000, 8)],
    "+1" + " " * 900_000: [],
    "a@" * 400_000: [],
    "a.b" * 300_000 + "@c" + ".d" * 200_000: [("email", 0, 1_300_002)],
    "a@b.de " * 20_000: [("email", n, n + 6) for n in range(0, 140_000, 7)],
}


@pytest.mark.parametrize("case", range(len(LONG)))
def test_very_long_texts(spark, case):
    text, spans = list(LONG.items())[case]
    got = dc.sanitise(documents(spark, [(1, text)])).first()
    assert got.base == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
