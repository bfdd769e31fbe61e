import random

import sentencepiece

from contractlens.llm import piece_codec as pc
from contractlens.llm.queries import piece_model
from tests.llm.helpers import documents, prose


def test_same_ids_and_text_as_the_library(spark):
    rng = random.Random(3)
    odd = [" ", "  ", "▁", "▁▁", "a", "the", "é", "\n", "\t", "\r", "😀", "世界", "　", "<s>", "<unk>", "<0x41>", "0", "12", ".", "​", "ﬁ"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(1, 14))) for _ in range(600)]
    texts += [prose(1, 20_000), "x" * 5000, " lead", "trail ", "", None, texts[0]]
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    out = pc.encode(documents(spark, list(enumerate(texts))), piece_model()).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = model.encode(texts[r.doc_id] or "")
        assert (r.ids, r.decoded) == (ids, model.decode(ids)), repr(texts[r.doc_id])
    assert pc.encode(documents(spark, []), piece_model()).count() == 0


def test_table_is_bounded(monkeypatch):
    monkeypatch.setattr(pc, "TABLE_CHUNKS", 10)
    codec = pc.Codec(piece_model())
    text = prose(2, 500)
    assert codec.encode(text) == codec.model.encode(text) and len(codec.table) <= 10
