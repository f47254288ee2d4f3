import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from motionframe.llm import repair_files as R
from motionframe.llm.queries import queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TRUTH = Tokenizer.from_file(PATH)


def truth(text):
    return TRUTH.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeiTTS 's'll\n\t.,<|>#12é\x85\xa0\x1cÀİ́"), st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFFF)), max_size=40))
def test_encoder(text):
    assert encoded([text]) == [truth(text)[:-1]]


def encoded(texts):
    flat, n = R.encoder(PATH)(pa.array(["cut off", *texts], pa.string()).slice(1))
    assert len(n) == len(texts) and int(n.sum()) == len(flat)
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def test_encoder_batches(monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcsdrevlÉß''-.!#1\xa0İé") for _ in range(rng.randrange(1, 9)))
    monkeypatch.setattr(R, "CACHE", 300)  # what is remembered is given up now and then
    for _ in range(20):
        texts = [rng.choice([None, "", "  ", "<|endoftext|>a", " ".join(word() for _ in range(rng.randrange(60)))]) for _ in range(30)]
        assert encoded(texts) == [truth(t)[:-1] for t in texts]
    assert encoded([None]) == [[]]


def test_encoder_special():
    for text in ("a<|endoftext|>b", "<|startoftext|> <|endoftext", "#", "A" * 30000):
        assert encoded([text]) == [truth(text)[:-1]]


def shard(docs, rarest=0):
    return R.shard_row(0, 0, list(range(len(docs))), np.array(sum(docs, []), "<u4"), np.array(list(map(len, docs))), 50_000, rarest)


def occurrences(symbols, n_symbols):
    """How often each pair occurs without overlaps."""
    counts, at = Counter(), 0
    for n in n_symbols:
        d, taken = symbols[at : at + n].tolist(), {}
        at += n
        for i, pair in enumerate(zip(d, d[1:])):
            if taken.get(pair, -2) != i - 1:
                taken[pair] = i
                counts[pair] += 1
    return counts


def test_grammar_is_complete():
    rng = random.Random(5)
    docs = [[rng.choice([1, 2, 3, 9, 9, 9]) for _ in range(rng.randrange(400))] for _ in range(40)] + [[5, 6, 7, 8] * 200, [4] * 301, [1, 2] * 99, list(range(10, 600)) * 3]
    for rarest, least in ((0, 2), (500, sum(map(len, docs)) // 500)):
        row = shard(docs, rarest)
        symbols, flat, starts, sizes = R.unpacked(row)
        assert max(occurrences(symbols, row["n_symbols"]).values()) < least
        assert R.expand(symbols, flat, starts, sizes).tolist() == sum(docs, [])


def test_frequent():
    rng = np.random.default_rng(2)
    for size in (100, 50_000):
        pairs = rng.integers(0, 2000, size) << 32 | rng.integers(0, 20, size)
        found, i, j = R.frequent(pairs, 3)
        want = Counter(pairs.tolist())
        assert found.tolist() == sorted(p for p, n in want.items() if n >= 3)
        assert i.tolist() == [k for k, p in enumerate(pairs.tolist()) if want[p] >= 3] and (found[j] == pairs[i]).all()


def test_grammar_round_trip_and_random_access():
    rng = random.Random(3)
    docs = [[rng.choice([1, 2, 3, 3, 3, 49_999]) for _ in range(rng.choice([0, 1, 2, 500]))] for _ in range(60)] + [[7] * 999, [], [2]]
    row = shard(docs)
    assert len(row["symbols"]) // row["width"] < sum(map(len, docs)) / 2 and sum(row["n_symbols"]) * row["width"] == len(row["symbols"])
    for k, d in enumerate(docs):
        assert R.document_ids(row, k).tolist() == d
        a = rng.randrange(len(d) + 1)
        b = rng.randrange(a, len(d) + 1)
        assert R.document_ids(row, k, a, b).tolist() == d[a:b]
    assert R.document_ids(shard([[]]), 0).tolist() == []


def expected(docs):
    out, at = [], 0
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = truth(t)
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files(spark):
    rng = random.Random(1)
    docs = [(None, "null id"), (7, None), (8, ""), (8, ""), (8, "tie"), (9, "été ñ 日本 <|endoftext|>"), (10, "long " * 40_000)]
    docs += [(i, " ".join(rng.choice(["the", "of", "cat", "Sat", "on."]) for _ in range(rng.randrange(300)))) for i in range(-50, 400)]
    rng.shuffle(docs)
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, part int")
    folder = tempfile.mkdtemp()
    path = R.write_files(d, PATH, folder, shard_ids=2000)
    rows = [tuple(r) for r in R.read_documents(spark, path).collect()]
    assert sorted(rows, key=lambda r: r[1]) == expected(docs)
    assert R.read_documents(spark, R.write_files(d.limit(0), PATH, folder)).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = [tuple(r) for r in queries()["op2_repair_ids"](spark, d).collect()]
    assert sorted(rows, key=lambda r: r[1]) == expected(docs)
