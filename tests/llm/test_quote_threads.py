import random

import pytest

from contractlens.llm import quote_threads as qt
from contractlens.llm import reply_threads as rt

SCHEMA = "conv_id long, turn long, role string, text string, body string, level int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)


def test_replies_follow_quotations(spark):
    rows = [
        (1, 0, "user", "How do joins spill?\nI saw it fail."),
        (1, 1, "assistant", "They sort first."),
        (1, 2, "user", "> They   SORT first.\n>> How do joins spill?\nAnd then?"),
        (1, 5, "assistant", " > > I saw it fail.\n> How do joins spill?\n> I saw it fail.\n\nBecause of skew.\n"),
        (1, 6, "user", "> nobody said this\nthanks"),
        (2, 0, "user", "> They sort first.\nis that so?"),
        (2, 1, None, None),
        (2, 1, None, None),
        (None, 3, "user", "alone"),
        (3, None, "user", ">"),
    ]
    out = {(r.conv_id, r.turn): r for r in qt.thread(frame(spark, rows)).collect()}
    reply = {k: (r.reply_conv, r.reply_turn, r.linked) for k, r in out.items()}
    assert reply == {
        (1, 0): (None, None, False), (1, 1): (1, 0, False), (1, 2): (1, 1, True), (1, 5): (1, 0, True), (1, 6): (1, 5, False),
        (2, 0): (1, 1, True), (2, 1): (2, 0, False), (None, 3): (None, None, False), (3, None): (None, None, False),
    }
    assert out[(1, 2)].body == "And then?" and out[(1, 2)].n_levels == 2 and out[(1, 2)].n_quoted == 2
    assert out[(1, 5)].body == "Because of skew." and out[(2, 1)].formatted == "<||>\n"
    assert qt.thread(frame(spark, rows)).count() == len(rows)
    assert qt.thread(frame(spark, [])).count() == 0


@pytest.mark.parametrize("part", [50_000, 7])
def test_turn_before_in_a_long_conversation(spark, monkeypatch, part):
    monkeypatch.setattr(qt, "RANGE_ROWS", part)
    rows = [(9, 2 * t, "user", f"line {t}") for t in range(60)] + [(c, 0, "user", "hello") for c in range(8)]
    out = qt.thread(frame(spark, rows)).collect()
    assert {(r.conv_id, r.turn): r.reply_turn for r in out} == {(c, t): (t - 2 if c == 9 and t else None) for c, t, *_ in rows}


def replies(spark, rows):
    return {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.linked, [tuple(x) for x in r.links or []]) for r in qt.thread(frame(spark, rows)).collect()}


def test_deeper_levels_and_wrapped_quotations(spark):
    long = "The shuffle writes one file per map task and the reducers\nfetch their blocks from all of them, which is slow on small disks."
    rows = [
        (1, 0, "user", long),
        (1, 1, "assistant", "Use fewer partitions."),
        (1, 2, "user", "Nothing new."),
        (1, 3, "user", ">> Use fewer partitions.\nWhy?"),
        (1, 4, "user", "> The shuffle writes one file per\n> map task and the reducers fetch\n> their blocks from all\n> of them, which is slow on small disks.\nYes."),
        (1, 5, "user", "> unknown words here\n>> Use fewer partitions.\n>>> The shuffle writes one file per map task\n>>> and the reducers fetch their blocks\nNo."),
        (1, 6, "user", "> Nobody ever wrote that the shuffle writes one file, and not here either.\nNo."),
    ]
    out = replies(spark, rows)
    assert out[(1, 3)] == (1, 1, True, [(2, 1, 1)])
    assert out[(1, 4)] == (1, 0, True, [(1, 1, 0)])
    assert out[(1, 5)] == (1, 1, True, [(2, 1, 1), (3, 1, 0)])
    assert out[(1, 6)] == (1, 5, False, [])


def test_original_elsewhere_when_the_first_owner_is_the_asker(spark):
    rows = [
        (1, 0, "user", "Hello."),
        (1, 1, "user", "> The key is hot.\nThe key is hot."),
        (2, 0, "user", "> Salt it.\nWhy?"),
        (2, 1, "user", "Salt it."),
        (3, 4, "user", "The key is hot.\nSalt it."),
        (4, 0, "user", "The key is hot."),
    ]
    out = replies(spark, rows)
    assert out[(1, 1)][:3] == (3, 4, True) and out[(2, 0)][:3] == (3, 4, True)


def test_only_known_quotations_leave_the_body(spark):
    rows = [
        (1, 0, "user", "How do joins spill?"),
        (1, 1, "user", "> not quoted anywhere else at all here\n>>> print(1)\nmine"),
        (1, 2, "user", "Hello.\nOn Monday X wrote:\n\n> How do joins spill?\n> and a tail\n\nThey sort.\n> a prompt\nOn Monday Y wrote:\nend"),
        (1, 3, "user", "> How do joins spill?"),
        (1, 4, "user", "   > kept\n"),
    ]
    out = {r.turn: r.body for r in qt.thread(frame(spark, rows)).collect()}
    assert out == {
        0: "How do joins spill?", 1: "> not quoted anywhere else at all here\n>>> print(1)\nmine",
        2: "Hello.\n\n\nThey sort.\n> a prompt\nOn Monday Y wrote:\nend", 3: "", 4: "> kept",
    }


def test_long_quoting_text(spark):
    """Very long texts: the work on lines grows with them, not with their square."""
    held = [f"line number {i} of the original text" for i in range(20_000)]
    mixed = "\n".join(f"> {x}\nanswer {i}\n>> lost {i}" for i, x in enumerate(held))
    rows = [(1, 0, "user", "\n".join(held)), (1, 1, "user", mixed)]
    out = {r.turn: r for r in qt.thread(frame(spark, rows)).collect()}
    assert out[1].linked and out[1].body == "\n".join(f"answer {i}\n>> lost {i}" for i in range(20_000))


def test_a_thread_across_conversations(spark):
    rows = [
        (1, 0, "user", "The key is hot."), (1, 1, "user", "Indeed."), (2, 0, "user", "Hi."), (2, 1, "user", "> The key is hot.\nSalt it."),
        (2, 2, "user", "Done."), (3, 0, "user", "> Done.\nThanks."), (3, 0, "user", "> Done.\nThanks."), (None, 1, "user", "x"),
    ]
    out = {(r.conv_id, r.turn): (r.root_conv, r.root_turn, r.depth, r.position) for r in qt.thread(frame(spark, rows)).collect()}
    assert out == {
        (1, 0): (1, 0, 0, 0), (1, 1): (1, 0, 1, 1), (2, 1): (1, 0, 1, 2), (2, 2): (1, 0, 2, 3), (3, 0): (1, 0, 3, 4),
        (2, 0): (2, 0, 0, 0), (None, 1): (None, None, None, None),
    }


def plain_threads(nodes):
    """Pointers followed one by one; the smallest message of a ring is its root."""
    up = {(c, t): (a, b) if b is not None else None for c, t, a, b, _ in nodes}
    for start in sorted(up):
        seen, at = [], start
        while at is not None and at not in seen:
            seen.append(at)
            at = up[at]
        if at is not None:
            up[min(seen[seen.index(at):])] = None
    found = {}
    for node in up:
        at, depth = node, 0
        while up[at] is not None:
            at, depth = up[at], depth + 1
        found[node] = (at, depth)
    place = {}
    for root in {r for r, _ in found.values()}:
        members = sorted((d, n) for n, (r, d) in found.items() if r == root)
        place.update({n: i for i, (_, n) in enumerate(members)})
    return {n: (*r, d, place[n]) for n, (r, d) in found.items()}


@pytest.mark.parametrize("block", [50_000, 5])
def test_threads_equal_plain_ones(spark, monkeypatch, block):
    monkeypatch.setattr(rt, "BLOCK", block)
    rng = random.Random(block)
    names = [(c, t) for c in range(12) for t in range(rng.randrange(1, 14))]
    nodes = []
    for c, t in names:
        a, b = rng.choice(names)
        linked = rng.random() < 0.3 and (a, b) != (c, t) and (a != c or b < t)
        nodes.append((c, t, a, b, True) if linked else (c, t, c if t else None, t - 1 if t else None, False))
    nodes += [(90, 0, 91, 0, True), (91, 0, 92, 0, True), (92, 0, 90, 0, True), (93, 0, 91, 0, True)]
    out = rt.assemble(spark.createDataFrame(nodes, "conv_id long, turn long, reply_conv long, reply_turn long, linked boolean"))
    assert {(r.conv_id, r.turn): (r.root_conv, r.root_turn, r.depth, r.position) for r in out.collect()} == plain_threads(nodes)
