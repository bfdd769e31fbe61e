"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model whose pieces never hold a white-space marker after another character,
no merge crosses the start of a marker run.  A text therefore falls into chunks,
each a run of markers with the word that follows, which encode independently.
Every task keeps a table of the distinct chunks it has met: a chunk is segmented
once, and the ids of a text are its chunks' ids joined back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens.llm.common import small_batches, text_blocks

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
TABLE_CHUNKS = 200_000  # distinct chunks a task keeps; then it starts the table anew
LONG_CHUNK = 64  # longer chunks are rarely met twice and are not kept


class ChunkTable(dict):
    """Chunk without its first marker -> ids; that marker is the one the model adds."""

    def __init__(self, model):
        super().__init__()
        self.model, self.lone = model, [model.piece_to_id(MARK)]

    def __missing__(self, chunk: str) -> list[int]:
        ids = self.model.encode(chunk, num_threads=1) if chunk else self.lone
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= TABLE_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Codec:
    """A model's exact encode/decode for whole texts, chunk by chunk.

    Works for models with the identity normalizer that keep white space as it
    is and add one marker in front; others are refused.
    """

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        proto = spec.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        rules = proto.normalizer_spec
        crossing = any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        if crossing or not plain or not rules.escape_whitespaces or any(p.type == 4 for p in proto.pieces):
            raise ValueError("chunks of this model do not encode independently")
        self.table = ChunkTable(self.model)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            chunks = [c[1:].replace(MARK, " ") for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
        else:
            chunks = text.split(" ")
        return list(chain.from_iterable(map(self.table.__getitem__, chunks)))

    def decode(self, ids: Sequence[int]) -> str:
        return self.model.decode(list(ids))


def encode(docs: DataFrame, model: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `ids` (array of int) and `decoded` of every whole text.

    NULL and empty texts have no ids and decode to ''.  Nothing is shuffled:
    rows stay where they are read, and repeated rows are encoded like others.
    ``model`` is the path of the vocabulary file, present on every executor.
    """
    small_batches(docs.sparkSession)
    names = list(keep)
    schema = T.StructType([docs.schema[n] for n in names]).add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            for first, texts in text_blocks(batch, "_text"):
                ids = [codec.encode(t) for t in texts]
                # One call for the whole block; the library decodes each list by itself.
                decoded = codec.model.decode(ids, num_threads=1) if ids else []
                own = [batch.column(n).slice(first, len(texts)) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], [*names, "ids", "decoded"]
                )

    return docs.select(*names, F.col(text).alias("_text")).mapInArrow(run, schema)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
