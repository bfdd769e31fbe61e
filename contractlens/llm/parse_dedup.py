"""Exact removal of long repeated byte strings, or word strings, by prefix-free parsing.

A rolling hash over a few symbols (16 bytes, or 3 words) triggers phrase starts, so
the same content is cut into the same phrases wherever it stands.  A window of
``length`` symbols is then
a suffix of one phrase followed by the parse: windows are equal exactly if the
distance to the next phrase start, the phrases from there on, and the remaining
bytes agree.  The dictionary side (suffix of the first phrase) and the parse side
(what follows) are compared the way suffix arrays of dictionary and parse are
combined, with one difference: equality needs only the classes of that order,
not its ranks, so classes are formed by content hashes instead of a global sort.

Steps that narrow the work down:

1. Window starts with the same next phrase start form a segment.  Its key is the
   text from that start on, as far as all its windows hold it.  Segments with a
   key that occurs once are not repeated and go; this is nearly all of the corpus.
   Keys are counted alone first.  A bitmap of fixed size, set at the keys that occur
   twice or more, then keeps most of the others from being written with their
   places; the count per kind decides, so a full bitmap costs time only.
2. Segments that agree in all bytes of all their windows are repeated as a whole.
3. Where segments of one key differ, the same is asked of their pieces.
4. Only in pieces that differ at an edge are the windows compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import materialize, settled, small_batches, text_blocks
from contractlens.llm.hashing import BYTE_CODES, U, Powers, Prefix, mix, word_bounds, words_of

LENGTH = 400
PASSAGE_WORDS = 51  # passages of more than fifty words
ONE_IN = 64  # symbols per phrase start; fewer for short windows, see `one_in`
PIECE = 16  # windows of a piece of a segment, at most
WIDE, GAP = 1 << 27, 1 << 20  # a place is start * WIDE + further windows * GAP + distance to the phrase start
BLOCK_BYTES = 1 << 19
BITMAP_BITS = 1 << 27  # 16 MB, whatever the input
CHUNK_BITS = 1 << 15
SECOND = Powers(U(0xC2B2AE3D27D4EB4F))
SECOND_CODES = mix(BYTE_CODES)
KEYS = ["id", "h1", "h2"]


def identity(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, 128 bits of hash, and text: rows alike in them are the same text under the same name; NULL is a name of its own."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*text_keys(doc_id, body), body.alias("text"))


def text_keys(doc_id: str, body) -> list:
    nameless = F.col(doc_id).isNull()
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(nameless, body).alias("h1"), F.xxhash64(F.lit(1), body, nameless).alias("h2"),
    ]


@dataclass(frozen=True)
class Unit:
    """What a text is a string of: bytes, or words."""

    words: bool
    gram: int  # symbols that decide on a phrase start

    def blocks(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, symbols, offsets of its rows) for blocks of bounded size."""
        if not self.words:
            yield from byte_blocks(column)
            return
        for first, texts in text_blocks(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
            codes, counts = words_of(texts)
            yield first, codes, np.concatenate([[0], np.cumsum(counts)])

    def prefix(self, data: np.ndarray) -> Prefix:
        return Prefix(data, codes=None) if self.words else Prefix(data)

    def second(self, data: np.ndarray) -> Prefix:
        return Prefix(mix(data), SECOND, None) if self.words else Prefix(data, SECOND, SECOND_CODES)


BYTES, WORDS = Unit(False, 16), Unit(True, 3)


def byte_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of its rows) for blocks of about BLOCK_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def one_in(length: int) -> int:
    """Positions per phrase start: so few that windows of ``length`` symbols without a phrase start stay rare."""
    return max(1, min(ONE_IN, length // 6))


def phrase_starts(prefix: Prefix, n: int, length: int, gram: int) -> np.ndarray:
    """Positions whose next ``gram`` symbols have a rolling hash in the trigger set."""
    if n < gram:
        return np.empty(0, np.int64)
    rolling = (prefix.sums[gram:] - prefix.sums[: n - gram + 1]) * prefix.down[: n - gram + 1]
    return np.flatnonzero((rolling * U(0x9FB21C651E98DF25)) >> U(40) < U((1 << 24) // one_in(length)))


def segments(data: np.ndarray, offsets: np.ndarray, length: int, unit: Unit) -> tuple[np.ndarray, ...]:
    """(row, key, whole, low, high, gap, times) of all segments.

    Key hash, hash of all bytes, first and last window start in its row, distance
    from there to the next phrase start (0: none in reach), and how often the row
    holds a segment with the same bytes.
    """
    prefix = unit.prefix(data)
    starts = phrase_starts(prefix, len(data), length, unit.gram)
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + unit.gram <= offsets[row + 1]
    starts, row = starts[inside], row[inside]
    # One more, out of reach, at the end of every row: windows after its last phrase start.
    rows = np.arange(len(offsets) - 1)
    far = np.concatenate([starts, offsets[1:] + 2 * length])
    place = np.concatenate([starts, offsets[1:]])
    owner = np.concatenate([row, rows])
    order = np.lexsort((far, owner))
    far, place, owner = far[order], place[order], owner[order]
    previous = np.where(np.append(True, owner[1:] != owner[:-1]), offsets[owner], np.append(0, place[:-1]))
    last = offsets[owner + 1] - length
    reach = length - unit.gram
    step = 2 * one_in(length)  # segments hold windows whose next phrase start is at most so far apart
    out: list[tuple[np.ndarray, ...]] = []
    low_bound = 0
    for tier, bound in enumerate([*range(step, reach, step), reach]):
        low, high = np.maximum(previous, far - bound), np.minimum(far - 1 - low_bound, last)
        ok = low <= high
        at, low, high, own = far[ok], low[ok], high[ok], owner[ok]
        key = mix(prefix.ranges(at, at + (length - bound)) + U(tier))
        whole = mix(prefix.ranges(low, high + length) ^ mix((at - low).astype(np.uint64)))
        out.append((own, key, whole, low - offsets[own], high - offsets[own], at - high))
        low_bound = bound
    # Windows without a phrase start are segments of their own.
    low, high = previous, np.minimum(far - 1 - reach, last)
    ok = low <= high
    if ok.any():
        many = high[ok] - low[ok] + 1
        at = np.repeat(low[ok], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        own = np.repeat(owner[ok], many)
        whole = unit.second(data).ranges(at, at + length)
        out.append((own, mix(prefix.ranges(at, at + length) + U(255)), whole, at - offsets[own], at - offsets[own], np.zeros_like(at)))
    row, key, whole, low, high, gap = (np.concatenate(c) for c in zip(*out))
    _, kind, times = np.unique(mix(key ^ mix(whole + row.astype(np.uint64))), return_inverse=True, return_counts=True)
    return row, key, whole, low, high, gap, times[kind]


def kinds_of(row: np.ndarray, key: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return mix(key ^ mix(whole + row.astype(np.uint64)))


def key_rows(docs: DataFrame, length: int, unit: Unit, across: bool) -> DataFrame:
    """(key, n) of the segments: one row a text for equal segments, that counts two for several unless ``across``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in unit.blocks(batch.column("text")):
                row, key, whole, _, _, _, times = segments(data, offsets, length, unit)
                _, once = np.unique(kinds_of(row, key, U(0) * whole if across else whole), return_index=True)
                n = np.ones(len(once), np.int64) if across else np.minimum(times[once], 2)
                yield pa.RecordBatch.from_arrays([pa.array(key[once].view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    return docs.mapInArrow(run, "key long, n long")


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """A bit for every key modulo the bitmap's fixed size."""
    place = F.pmod("key", F.lit(BITMAP_BITS))
    parts = keys.groupBy(F.floor(place / CHUNK_BITS).cast("int").alias("chunk")).agg(F.bitmap_construct_agg(place % CHUNK_BITS).alias("bits"))
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for chunk, part in parts.toLocalIterator():  # BITMAP_BITS / CHUNK_BITS rows of 4 KB, at most
        at = chunk * CHUNK_BITS // 8
        bits[at : at + len(part)] = np.frombuffer(part, np.uint8)
    return bits


def place_rows(docs: DataFrame, length: int, unit: Unit, across: bool, bits: np.ndarray) -> DataFrame:
    """Segments with their place whose key may be a repeated one; as `key_rows`, but all places of a text if ``across``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_of = [batch.column(c).to_numpy() for c in KEYS]
            for first, data, offsets in unit.blocks(batch.column("text")):
                row, key, whole, low, high, gap, times = segments(data, offsets, length, unit)
                slot = (key.view(np.int64) % BITMAP_BITS).astype(np.int64)
                known = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                if not across:
                    once = np.zeros(len(key), bool)
                    once[np.unique(kinds_of(row, key, whole), return_index=True)[1]] = True
                    known &= once
                row, key, whole, low, high, gap, times = (x[known] for x in (row, key, whole, low, high, gap, times))
                n = np.ones(len(key), np.int64) if across else np.minimum(times, 2)
                columns = [key.view(np.int64), n, whole.view(np.int64), *(x[first + row] for x in names_of), low * WIDE + (high - low) * GAP + gap]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["key", "n", "whole", *KEYS, "at"]
    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def open_places(batch: pa.RecordBatch, unit: Unit) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row, symbols, offsets, place) of the open places of the rows, block by block."""
    open_ = batch.column("open").to_pylist()
    for first, data, offsets in unit.blocks(batch.column("text")):
        ats = [np.unique(np.array(open_[first + r] or [], np.int64)) for r in range(len(offsets) - 1)]
        at = np.concatenate(ats)
        if len(at):
            yield first, np.repeat(np.arange(len(ats)), [len(a) for a in ats]), data, offsets, at


def counted(many: np.ndarray) -> np.ndarray:
    """0 .. n-1 for every n."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def pieces(docs: DataFrame, length: int, unit: Unit) -> DataFrame:
    """Pieces of the open segments: `piece` windows by their distance to the next phrase start, keyed as segments are."""

    piece = max(1, min(PIECE, length // 3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_of = [batch.column(c).to_numpy() for c in KEYS]
            for first, row, data, offsets, at in open_places(batch, unit):
                low, gap = at // WIDE + offsets[row], at % GAP
                high = low + at % WIDE // GAP
                far = high + gap
                nearest, many = (gap - 1) // piece, (far - low - 1) // piece - (gap - 1) // piece + 1
                step = np.repeat(nearest, many) + counted(many)
                row, low, high, far = (np.repeat(x, many) for x in (row, low, high, far))
                low, high = np.maximum(low, far - piece * (step + 1)), np.minimum(high, far - piece * step - 1)
                prefix, alone = unit.prefix(data), np.repeat(gap == 0, many)
                start = np.where(alone, low, far - piece * step - 1)
                end = np.where(alone, low, far - piece * (step + 1)) + length
                key = mix(prefix.ranges(start, end) ^ mix(step.astype(np.uint64)))
                whole = mix(prefix.ranges(low, high + length) ^ mix((far - low).astype(np.uint64)))
                place = (low - offsets[row]) * WIDE + (high - low) * GAP
                columns = [key.view(np.int64), np.ones_like(place), whole.view(np.int64), *(x[first + row] for x in names_of), place]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["key", "n", "whole", *KEYS, "at"]
    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def windows(docs: DataFrame, length: int, unit: Unit) -> DataFrame:
    """Two hashes of every window of the open pieces, and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_of = [batch.column(c).to_numpy() for c in KEYS]
            for first, row, data, offsets, at in open_places(batch, unit):
                many = at % WIDE // GAP + 1
                start = np.repeat(at // WIDE, many) + counted(many)
                row = np.repeat(row, many)
                absolute = start + offsets[row]
                columns = [p.ranges(absolute, absolute + length).view(np.int64) for p in (unit.prefix(data), unit.second(data))]
                columns += [*(x[first + row] for x in names_of), start * WIDE]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["w1", "w2", *KEYS, "at"]
    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def narrow(found: DataFrame, across: bool) -> DataFrame:
    """(id, h1, h2, sure, open): places repeated as a whole, and places to look into, by text.

    Places to look into: where kinds of one key differ and one of them is not
    repeated, the places of that one, and of each other kind those of the texts
    with the lowest and the highest hash, so that every text meets one that is
    not itself.  ``across`` counts texts instead of places.
    """
    found = found.withColumn("d", F.xxhash64(*KEYS))
    kinds = found.groupBy("key", "whole").agg(F.sum("n").alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    repeated_ = (F.col("low") != F.col("high")) if across else (F.col("n") > 1)
    kinds = materialize(kinds.withColumn("twice", repeated_), "kinds")
    differ = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.count_if("twice").alias("several")).filter("kinds > 1 and several < kinds")
    status = kinds.join(differ.select("key", F.lit(True).alias("differ")), "key", "left").filter("twice or differ")
    shown = F.coalesce("differ", F.lit(False)) & (~F.col("twice") | F.col("d").isin(F.col("low"), F.col("high")))
    placed = found.join(status, ["key", "whole"]).select(*KEYS, "at", "twice", shown.alias("open")).filter("twice or open")
    of = lambda c: F.collect_set(F.when(F.col(c), F.col("at")))
    return placed.groupBy(*KEYS).agg(of("twice").alias("sure"), of("open").alias("open"))


def gone_symbols(batch: pa.RecordBatch, length: int, unit: Unit, across: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, mask of its repeated symbols), from the places of repeated segments, pieces and windows."""
    sure, more = (batch.column(c).to_pylist() for c in ("sure", "more"))
    for first, data, offsets in unit.blocks(batch.column("text")):
        local: list[list[np.ndarray]] = [[] for _ in offsets[1:]]
        if not across:  # what the text repeats itself
            row, _, _, low, high, _, times = segments(data, offsets, length, unit)
            twice = times > 1
            row, low, high = row[twice], low[twice], high[twice]
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(len(offsets)))
            local = [[low[order[a:b]], high[order[a:b]]] for a, b in zip(bounds[:-1], bounds[1:])]
        for r in range(len(offsets) - 1):
            at = np.array([*(sure[first + r] or []), *(more[first + r] or [])], np.int64)
            own_low, own_high = local[r] or [np.empty(0, np.int64)] * 2
            low = np.concatenate([at // WIDE, own_low])
            high = np.concatenate([at // WIDE + at % WIDE // GAP, own_high]) + length
            change = np.zeros(offsets[r + 1] - offsets[r] + 1, np.int64)
            np.add.at(change, low, 1)
            np.add.at(change, high, -1)
            yield first + r, np.cumsum(change[:-1]) > 0


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[0::2], edges[1::2]


def cutter(length: int, unit: Unit, as_text: bool, across: bool):
    """Rows with places -> spans of removed symbols, and the bytes that are left.

    A run of words goes from its first to its last byte, with the white space
    between.  As text, characters that a cut went through go as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, kept = batch.column("text"), [], []
            for row, gone in gone_symbols(batch, length, unit, across):
                start, end = runs_of(gone)
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end)])
                body = np.frombuffer(texts[row].as_py().encode(), np.uint8)
                if unit.words:
                    first, last = word_bounds(body)
                    change = np.zeros(len(body) + 1, np.int64)
                    change[first[start]] += 1
                    change[last[end - 1]] -= 1
                    gone = np.cumsum(change[:-1]) > 0
                left = body[~gone].tobytes()
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEYS), pa.array(spans, kind), pa.array(kept, pa.string() if as_text else pa.binary())], [*KEYS, "spans", "kept"]
            )

    return run


def repeated(docs: DataFrame, length: int, unit: Unit = BYTES, as_text: bool = False, across: bool = False) -> DataFrame:
    """(id, h1, h2, spans, kept) of the texts that hold a repeated window; others have no row.  Written, its cut points deleted."""
    spark = docs.sparkSession
    small_batches(spark)

    def run() -> DataFrame:
        often = key_rows(docs, length, unit, across).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
        found = materialize(place_rows(docs, length, unit, across, bitmap_of(often)), "segments")
        lists = materialize(narrow(found, across), "lists")
        texts = materialize(docs.join(lists, KEYS).dropDuplicates(KEYS), "touched")

        inner = materialize(pieces(texts.filter(F.size("open") > 0), length, unit), "pieces")
        inner = materialize(narrow(inner, across), "inner")
        asked = texts.select(*KEYS, "text").join(inner.filter(F.size("open") > 0).select(*KEYS, "open"), KEYS)
        single = materialize(windows(asked, length, unit).withColumn("d", F.xxhash64(*KEYS)), "windows")
        several = (F.min("d") != F.max("d")) if across else (F.count("*") > 1)
        twice = single.groupBy("w1", "w2").agg(several.alias("several")).filter("several").drop("several")
        last = single.join(twice, ["w1", "w2"]).groupBy(*KEYS).agg(F.collect_set("at").alias("last"))
        more = inner.select(*KEYS, "sure").withColumnRenamed("sure", "more").join(last, KEYS, "left")
        more = more.select(*KEYS, F.concat("more", F.coalesce("last", F.array().cast("array<bigint>"))).alias("more"))
        schema = f"id long, h1 long, h2 long, spans array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}"
        return texts.drop("open").join(more, KEYS, "left").mapInArrow(cutter(length, unit, as_text, across), schema)

    return settled(spark, run, "repeated")


def repeated_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, `spans` removed, and `kept` bytes where any were removed (else NULL).

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else in the table, the same text included; matches never cross
    texts and are judged on the input.  NULL is an empty text; texts of any
    length are taken whole.  Rows repeated with id and text repeat each other and
    vanish as a whole; rows with one id and different texts, or a NULL id, are
    texts like any others.  An empty table gives no rows; other columns play no
    part.
    """
    gone = repeated(identity(docs, doc_id, text), length)
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(
        doc_id, *text_keys(doc_id, body), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole_sha256")
    )
    return named.join(gone, KEYS, "left").drop(*KEYS)


def with_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = PASSAGE_WORDS) -> DataFrame:
    """`repeated_spans`, and `passages`: runs of words (first, after the last) inside strings of ``words`` words
    that another row holds too.

    What only one row repeats is no passage here, and white space between the
    words may differ; a row equal in id and text is the same row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = identity(docs, doc_id, text)
    gone = repeated(keyed, LENGTH)
    shared = repeated(keyed, words, WORDS, across=True).select(*KEYS, F.col("spans").alias("passages"))
    named = docs.select(
        doc_id, *text_keys(doc_id, body), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole_sha256")
    )
    return named.join(gone, KEYS, "left").join(shared, KEYS, "left").drop(*KEYS)


def without_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, unit: Unit = BYTES
) -> DataFrame:
    """The documents, all of them, with repeated bytes (or words) cut out of their text (see `repeated_spans`)."""
    gone = repeated(identity(docs, doc_id, text), length, unit, as_text=True)
    names = [f"_{c}" for c in KEYS]
    gone = gone.select(*[F.col(c).alias(n) for c, n in zip(KEYS, names)], F.col("kept").alias("_kept"))
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns(dict(zip(names, text_keys(doc_id, body))))
    joined = keyed.join(gone, names, "left").withColumn(text, F.coalesce("_kept", text))
    return joined.select(*docs.columns)
