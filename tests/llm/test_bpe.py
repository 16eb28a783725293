from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quoteloom.llm import bpe

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts():
    rng = random.Random(1)
    fixed = ["", " ", "<|endoftext|>", "a<|endoftext|>b <|endoftext", "\n\n  \t x", "'s 'S it's 're've'll"]
    fixed += ["²½Ⅷ x² ١٢", "\x1c\x1d\x85\xa0 x", "é 😀😀 漢字", "_x_ a_b 1a", "\x00a", "İı ß", "\ufeffx\u200b", "y\u180ez"]
    ranges = [(0, 0x300), (0x2000, 0x2100), (0x3000, 0x3100), (0x1F600, 0x1F650), (32, 33), (39, 40)]
    for _ in range(1500):
        fixed.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 30))))
    return fixed + ["a" * 20_000, "ab" * 5_000, "\n" * 3_000, "Ünïcödé" * 500]


def test_codec_equals_the_library(tokenizer):
    codec = bpe.Codec(VOCABULARY, remembered=100)
    for text in odd_texts():
        ids = codec.encode(text)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
        assert codec.decode(ids) == tokenizer.decode(ids.tolist(), skip_special_tokens=False) == text


def test_any_ids_decode_like_the_library(tokenizer):
    rng = random.Random(2)
    codec = bpe.Codec(VOCABULARY)
    import numpy as np

    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(20))]
        assert codec.decode(np.array(ids, np.int32)) == tokenizer.decode(ids, skip_special_tokens=False)


def test_tables_round_trip(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts()[:200])] + [(None, None, "y"), (3, "twice", "z"), (3, "twice", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, young string")
    encoded = bpe.encode(frame, VOCABULARY)
    found = bpe.decode(encoded, VOCABULARY).collect()
    assert sorted((str(r.doc_id), r.text or "", r.young) for r in found) == sorted((str(i), t or "", y) for i, t, y in rows)
    assert all(r.decoded == (r.text or "") for r in found)
    assert bpe.encode(frame.limit(0), VOCABULARY).count() == 0
    nothing = encoded.select(F.lit(None).cast("array<int>").alias("ids")).limit(1)
    assert bpe.decode(nothing, VOCABULARY).first()["decoded"] == ""
    with pytest.raises(ValueError, match="already"):
        bpe.encode(encoded, VOCABULARY)
