import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from motionframe.llm import prefix_bpe as B
from motionframe.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUTH = Tokenizer.from_file(PATH)
BPE = B.loaded(PATH)


def same(text):
    ids = TRUTH.encode(text, add_special_tokens=False).ids
    mine = BPE.encode(text)
    assert np.frombuffer(mine, "<u4").tolist() == ids, text
    assert BPE.decode(mine).decode() == TRUTH.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinortTS 's'll\n\t .,<|>0123é\x85\xa0\x1c"), st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFFF)), max_size=60))
def test_random_texts(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "it's we'll", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|", "aaaaaaaaaaaaaaaaa" * 30, " " * 5000 + "x", "the" * 3000, "日本語テキスト🙂🙂", "﻿x​", "ſ K"])
def test_cases(text):
    same(text)


def test_random_letters():
    rng = random.Random(1)
    for _ in range(300):
        same("".join(rng.choice("etaoinshrdlu ETA\n") for _ in range(200)))


def test_rows(spark):
    docs = [(None, None, 1), (1, "", 1), (1, "same", 1), (1, "same", 1), (2, "x " * 200_000, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_tokens int")
    rows = B.round_trip(d, PATH).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(TRUTH.encode(t or "", add_special_tokens=False).ids) for _, t, _ in docs)
    back = B.decode(B.encode(d, PATH), PATH)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(a), b or "") for a, b, _ in docs)
    assert B.round_trip(d.limit(0), PATH).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries()["op6_prefix_bpe"](spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = TRUTH.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
