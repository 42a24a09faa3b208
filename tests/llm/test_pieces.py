import random

import pytest
import sentencepiece

from korrel.llm import pieces
from korrel.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes(tokenizer_path())


def test_same_as_library(model):
    codec, sp = pieces.PieceCodec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rnd = random.Random(1)
    letters = "▁  aabe\r\n\tthen();0123456789éß日本🙂ａ\x00</>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += [" " * k + "x" * j for k in range(36) for j in (0, 1, 3, 17)]
    words = [p.replace("▁", " ") for p in codec.ids]
    texts += ["".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(1500)]
    texts += ["", "the " * 5000, "ab" * 20000, "日本語🙂" * 3000]
    for t in texts:
        ids = sp.encode(t)
        assert codec.encode(t) == ids
        assert codec.decode(ids) == sp.decode(ids)


def test_frame_keeps_rows_and_columns(spark, model):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "Hello  world\n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encode_decode(df, model).collect()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got) == [(1, [], ""), (2, [], ""), (2, [], ""), (3, sp.encode(rows[3][1]), rows[3][1])]
    assert pieces.digests(pieces.encode_decode(df.limit(0), model)).count() == 0
