"""Language identification as inference of a multilingual mixture.

A language is a distribution over letter trigrams, learned from all labelled
texts.  A document is a mixture: each of its words comes from one language, and
expectation maximisation estimates the proportions from the words' trigram
likelihoods.  The set of languages is chosen by penalised likelihood: languages
enter in the order of their proportion, and a further one stays only if it gains
more likelihood than its parameter costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import small_batches, text_blocks

BUCKETS = 1 << 15  # trigrams are hashed into so many
SMOOTHING = 0.5
ROUNDS = 15  # of expectation maximisation
PENALTY = 0.5  # per language and logarithm of the word count
MAX_LANGUAGES = 1000  # the model has BUCKETS numbers each; more are an error, never dropped
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts in turn: bucket of the trigram around every letter, first letter of every word, text of every word.

    Words are runs of letters in lower case; a trigram ends at the word's edge.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters()[codes], codes, 0)
    at = np.flatnonzero(codes)
    mixed = codes[at - 1] * np.uint32(0x9E3779B1) + codes[at] * np.uint32(0x85EBCA77) + codes[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    starts = np.flatnonzero(codes[at - 1] == 0)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return mixed >> np.uint32(32 - 15), starts, np.searchsorted(ends, at[starts], side="left")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram counts of every language over all rows with a language and a text.

    Tasks add counts up before the shuffle; only languages x buckets numbers
    come to the driver.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column("_lang").to_pylist()
            for first, texts in text_blocks(batch, "_text"):
                own = names[first : first + len(texts)]
                for name in sorted(set(own)):
                    found = trigrams([t for t, n in zip(texts, own) if n == name])[0]
                    total = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(found, minlength=BUCKETS)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            columns = [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_text")).mapInArrow(run, "lang string, bucket int, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(summed.column("lang").to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the model holds {MAX_LANGUAGES}")
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((BUCKETS, len(languages)))
    columns = np.array([place[x] for x in summed.column("lang").to_pylist()], np.int64)
    counts[summed.column("bucket").to_numpy(), columns] = summed.column("n").to_numpy()
    log_p = np.log(counts + SMOOTHING) - np.log(counts.sum(0) + SMOOTHING * BUCKETS)
    return Model(languages, log_p.astype(np.float32))


def fit(likelihood: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of every document over its ``allowed`` languages."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        part = likelihood * np.repeat(share, sizes, 0)
        part /= part.sum(1, keepdims=True) + 1e-300
        share = np.add.reduceat(part, starts, 0) / sizes[:, None]
    words = np.log((likelihood * np.repeat(share, sizes, 0)).sum(1) + 1e-300)
    return share, np.add.reduceat(words, starts)


def mixtures(texts: list[str], model: Model) -> list[tuple[list[str], list[float]]]:
    """Languages and proportions of every text, largest first; nothing for a text without letters."""
    found: list[tuple[list[str], list[float]]] = [([], [])] * len(texts)
    bucket, starts, owner = trigrams(texts)
    if not len(starts) or not model.languages:
        return found
    logs = np.add.reduceat(model.log_p[bucket], starts, 0).astype(np.float64)
    top = logs.max(1, keepdims=True)
    likelihood = np.exp(logs - top)
    docs, first, sizes = np.unique(owner, return_index=True, return_counts=True)
    k = len(model.languages)
    alone = np.add.reduceat(logs - top, first, 0)
    single = alone.argmax(1)
    share = np.zeros((len(docs), k))
    share[np.arange(len(docs)), single] = 1.0
    best = alone.max(1)
    if k > 1:
        whole, _ = fit(likelihood, first, sizes, np.ones((len(docs), k)))
        rank = np.argsort(np.argsort(-whole, 1, kind="stable"), 1)
        going, cost = np.arange(len(docs)), PENALTY * np.log(sizes + 1.0)
        for many in range(2, k + 1):
            inside = np.isin(np.repeat(np.arange(len(docs)), sizes), going)
            own = sizes[going]
            mixed, gained = fit(likelihood[inside], np.cumsum(own) - own, own, (rank[going] < many).astype(float))
            better = gained - cost[going] * (many - 1) > best[going]
            share[going[better]], best[going[better]] = mixed[better], (gained - cost[going] * (many - 1))[better]
            going = going[better]
            if not len(going):
                break
    for i, d in enumerate(docs):
        order = np.argsort(-share[i], kind="stable")
        order = order[share[i][order] > 0]
        found[d] = ([model.languages[j] for j in order], [float(share[i][j]) for j in order])
    return found


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `langs` and `shares` (largest first), `lang_pred` and `score` of every whole text.

    `lang_pred` is the language with the largest share, which is the score; ties
    go to the name that sorts first.  A NULL text, one without letters, and any
    text under a model without languages are `und` with score 0.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_blocks(batch, "_text"):
                mixed = mixtures(texts, shared.value)
                own = [batch.column(n).slice(first, len(texts)) for n in names]
                made = [pa.array([m[0] for m in mixed], pa.list_(pa.string())), pa.array([m[1] for m in mixed], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*own, *made], [*names, "langs", "shares"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    mixed = docs.select(*names, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, langs array<string>, shares array<double>")
    first = lambda c, otherwise: F.coalesce(F.get(c, F.lit(0)), F.lit(otherwise))
    return mixed.withColumns({"lang_pred": first("langs", UNKNOWN), "score": F.least(first("shares", 0.0), F.lit(1.0))})


def is_held_out(doc_id: Column) -> Column:
    """A quarter of the ids, by checksum."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
