from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no public vocabulary here")


def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_equals_the_public_library():
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(0x250)] + list("日本語 ​\x85\x1c　Ⅻ²½€🎉﻿")
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    cases += ["=" * n for n in range(1, 130)] + [" " * n for n in range(1, 80)] + ["ab" * n for n in range(1, 80)]
    cases += ["a<|endoftext|>b", "it's we'll\r\n\r\n  x", "ﬃ", "x" * 5000, " \n \n"]
    want, mine = reference(), bpe.encoder()
    assert [c for c in cases if mine.encode(c).tolist() != want(c)] == []


def test_null_and_empty_texts_give_empty_lists(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Hello world")], "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {r.doc_id: r.ids for r in bpe.encode_column(df, "doc_id", "text", "ids").collect()}
    assert got[1] == [] and got[2] == [] and got[3] == reference()("Hello world")
    counts = {r.doc_id: r.n for r in bpe.count_column(df, "doc_id", "text", "n").collect()}
    assert counts == {1: 0, 2: 0, 3: len(got[3])}
    assert bpe.encode_column(df.limit(0), "doc_id", "text", "ids").count() == 0


def test_memo_bound_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
    e = bpe.Encoder(bpe.VOCABULARY)
    text = "one two three four five one two three " * 5
    assert e.encode(text).tolist() == reference()(text)
