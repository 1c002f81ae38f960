import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendscore.llm import queries, wavelet as W
from tests.conftest import SF_SMALL
from tests.llm.helpers import no_docs, odd_docs

VOCABULARY = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def library_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_remembered_pieces_equal_whole_texts(tokenizer):
    enc = W.IdEncoder(open(VOCABULARY, encoding="utf-8").read(), limit=50)
    rng = random.Random(3)
    plain = "ab'sStTmL 1²½  \n\t\x0b\x0c~×÷ÿÀéÉßµªº.,!<|>"
    odd = plain + "\xa0\xadİſK̇́ œΣσ\x1c中　 "
    for n in range(3000):
        t = "".join(rng.choice(odd if n % 2 else plain) for _ in range(rng.randint(0, 50)))
        assert enc.encode([t])[0].tolist() == library_ids(tokenizer, t), t
    for t in ("<|endoftext|>", "a<|startoftext|> b"):
        assert enc.encode([t])[0].tolist() == library_ids(tokenizer, t)


def test_plain_pieces_need_the_model_only(tokenizer, monkeypatch):
    enc = W.IdEncoder(open(VOCABULARY, encoding="utf-8").read(), limit=50, added=True)
    texts = ["It's a naïve Façade, 42 ½ «ÀÉ» don't; we'll " * 3, "", "\t\n", "x" * 5000, "'S 'LL're'", "ª÷×ÿß µº"]
    expected = [library_ids(tokenizer, t) for t in texts]
    monkeypatch.setattr(enc, "library", lambda pieces: pytest.fail(f"normalised and split again: {pieces[:3]}"))
    assert [i.tolist() for i in enc.encode(texts)] == expected


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 3000])
def test_matrix_queries(n):
    rng = np.random.default_rng(n)
    a = rng.integers(0, 500, n)
    m = W.WaveletMatrix.build(a, 9)
    assert (m.decode() == a).all() and m.count(100_000) == 0
    for _ in range(20 if n else 0):
        i = int(rng.integers(n))
        token = int(a[i])
        lo = int(rng.integers(n + 1))
        hi = int(rng.integers(lo, n + 1))
        places = np.flatnonzero(a == token)
        k = int(rng.integers(len(places)))
        assert m.access(i) == token and m.count(token, lo, hi) == (a[lo:hi] == token).sum()
        assert (m.occurrences(token) == places).all() and m.select(token, k) == places[k]
    with pytest.raises(IndexError):
        m.select(1, n + 1)


def test_query_equals_library(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op10_wavelet_ids(spark, SF_SMALL).orderBy("doc_id").collect()
    start = 0
    for r, d in zip(got, docs, strict=True):
        ids = np.array(library_ids(tokenizer, d["text"]) + [1], dtype="<u4")
        assert tuple(r) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_rows_counts_and_positions(spark, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    W.write(odd_docs(spark), path, VOCABULARY, shard_tokens=40)
    got = W.documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 7, 7, 9, 10]
    assert [r["n_tokens"] for r in got][2:5] == [1, 1, 1]
    every = []
    for r in odd_docs(spark).orderBy(F.asc_nulls_first("doc_id")).collect():
        every += library_ids(tokenizer, r["text"]) + [1]
    token = library_ids(tokenizer, "cat")[0]
    want = [i for i, t in enumerate(every) if t == token]
    assert sorted(r["position"] for r in W.token_positions(spark, path, token).collect()) == want
    assert W.token_counts(spark, path, token).agg(F.sum("n")).first()[0] == len(want)
    assert W.read_shards(spark, path).count() > 3


def test_empty_table(spark, tmp_path):
    W.write(no_docs(spark), str(tmp_path / "none"), VOCABULARY)
    assert W.documents(spark, str(tmp_path / "none")).count() == 0


def test_added_tokens_as_in_the_unmodified_tokenizer(spark, tmp_path):
    plain = Tokenizer.from_file(VOCABULARY)
    texts = ["a<|endoftext|> b", "<|startoftext|>", "é x<|endoftext|>\n<|startoftext|>y  中", "A<|ENDOFTEXT|>b", "<| endoftext|>",
             "<|endoftext", "a b c", "<|endoftext|><|endoftext|>"] + ["w" + " <|endoftext|> v" * n for n in range(4)]
    rng = random.Random(8)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "End", "é", " ", "\n", "ab", "'s", "1", "中"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(1000)]
    enc = W.id_encoder(open(VOCABULARY, encoding="utf-8").read())
    want = [library_ids(plain, t) for t in texts]
    assert [ids.tolist() for ids in enc.encode(texts)] == want
    path = str(tmp_path / "added")
    W.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, VOCABULARY)
    rows = W.documents(spark, path).orderBy("doc_id").collect()
    assert [r["ids_crc32"] for r in rows] == [zlib.crc32(np.array(w + [1], dtype="<u4").tobytes()) for w in want]
