import base64
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken

from lendscore.llm import bpe
from tests.llm.helpers import no_docs, odd_docs

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(bpe.read_ranks(RANKS), P.PATTERN)


def test_encoder_is_the_rank_file(enc):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in ("", "it's 12 o'clock\n\n ¿qué?", "<|endoftext|>"):
        assert bpe.encode_text(enc, t) == own.encode_ordinary(t)


def test_cuts_do_not_change_ids(enc, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(bpe, "BLANK_RUN", 3)
    monkeypatch.setattr(bpe, "_BLANKS", regex.compile(r"\s{3,}"))
    for _ in range(800):
        t = "".join(rng.choice("ab'sreT 1²  \n\té.,!　") for _ in range(rng.randint(0, 150)))
        want = enc.encode_ordinary(t)
        assert [i for p in bpe.cut_safely(t, 8) for i in enc.encode_ordinary(p)] == want
        assert bpe.encode_text(enc, t) == want


def test_long_blank_runs_and_words(enc):
    for t in (" " * 2_000_000 + "x", "ab" * 200_000, "\n" * 50_000):
        assert enc.decode_bytes(bpe.encode_text(enc, t)) == t.encode()


def test_odd_rows_round_trip(spark):
    df = bpe.decode(bpe.encode(odd_docs(spark), RANKS, P.PATTERN), RANKS, P.PATTERN)
    for r in df.select("text", "token_ids", "decoded").collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert (len(r["token_ids"]) == 0) == (not r["text"])
    assert bpe.encode(no_docs(spark), RANKS, P.PATTERN).count() == 0


def test_checked_round_trip_raises(spark):
    df = spark.createDataFrame([("ab", [1])], "text string, token_ids array<int>")
    with pytest.raises(Exception, match="do not decode"):
        bpe.checked_round_trip(df, RANKS, P.PATTERN).collect()
