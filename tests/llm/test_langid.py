import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from lendscore.llm import langid, queries
from tests.conftest import SF_ORACLE
from tests.llm.helpers import no_docs, odd_docs

PIECES = P.path("piece_bpe_32k.model")


def brute(word, pieces, probs, k):
    t = "▁" + word

    def rest(i):
        if i == len(t):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(t) + 1):
            if t[i:j] in pieces:
                total += probs[pieces.index(t[i:j]), k] * rest(j)
            elif j == i + 1:
                total += probs[-1, k] * rest(j)
        return total
    return rest(0)


def test_forward_pass_sums_all_segmentations():
    pieces = sorted(["▁", "a", "b", "ab", "ba", "▁a", "▁ab"])
    probs = np.random.default_rng(1).random((len(pieces) + 1, 2))
    words = ["a", "ab", "abba", "xab", "bbxaab", "a" * 40]
    got = np.exp(langid.word_scores(words, pieces, langid.scale_up(probs, pieces)))
    for w, row in zip(words[:-1], got):
        assert np.allclose(row, [brute(w, pieces, probs, k) for k in (0, 1)])


def test_expected_counts_add_up_to_letters():
    pieces = sorted(["▁", "a", "b", "ab", "▁a"])
    probs = np.random.default_rng(2).random((len(pieces) + 1, 2))
    words, weights = ["abab", "xa"], np.array([[2.0, 0.0], [1.0, 3.0]])
    counts = langid.expected_counts(words, weights, pieces, langid.scale_up(probs, pieces))
    size = np.array([len(p) for p in pieces] + [1])
    assert np.allclose((counts * size[:, None]).sum(axis=0), [2 * 5 + 3, 3 * 3])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = queries.op2_language_id(spark, SF_ORACLE).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.count() == docs.count()
    share = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share >= 0.97


def test_odd_rows(spark):
    model = langid.fit(odd_docs(spark), PIECES)
    rows = langid.predict(odd_docs(spark), model).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == 10
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != letters
        assert 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 7} == {"en"}
    assert langid.predict(no_docs(spark), model).count() == 0
    nothing = langid.predict(odd_docs(spark), langid.fit(no_docs(spark), PIECES))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 1.0)}
