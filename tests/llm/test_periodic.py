"""Periodic runs against brute force, exact transforms, and the query on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscore.llm import periodic, queries

from .helpers import no_docs, odd_docs


def brute_runs(words):
    """Every maximal stretch of every distance, kept if that distance is its smallest period."""
    n, out = len(words), []
    for q in range(1, n // periodic.MIN_PERIODS + 1):
        s = 0
        while s + q < n:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e + q - s
            part = words[s:s + length]
            least = next(p for p in range(1, q + 1) if part[p:] == part[:-p])
            if least == q and length >= max(periodic.MIN_LENGTH, periodic.MIN_PERIODS * q):
                out.append((s, length, q))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def samples():
    rng = random.Random(5)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 100, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"],
           (["a", "a", "b"] * 5 + ["a", "b"]) * 6, ["a"] * 9 + ["b"] + ["a"] * 9,
           (["a"] * 7 + ["b"]) * 5, list("abaababaabaab" * 3), ["x"] + list("abc") * 4 + ["a", "y"]]
    for k in range(120):
        vocabulary = "ab" if k % 3 == 0 else "abc" if k % 3 == 1 else "abcdefgh"
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            q = rng.randrange(1, 12)
            root = [rng.choice(vocabulary) for _ in range(q)]
            many = rng.randrange(3 * q, 7 * q)
            at = rng.randrange(len(words) + 1)
            words[at:at] = (root * 8)[:many]
        out.append(words)
    return out


def test_runs_equal_brute_force_in_one_batch_and_alone():
    texts = samples()
    together, collapsed = periodic.runs_of([" ".join(w) for w in texts])
    for words, found, rest in zip(texts, together, collapsed):
        want = brute_runs(words)
        assert found == want, words
        assert rest == brute_collapsed(words, want)
        assert periodic.runs_of([" ".join(words)])[0] == [want]


def test_transform_is_exact_for_large_numbers():
    rng = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        x = rng.integers(0, 1 << 20, (3, size)).astype(np.uint64)
        y = rng.integers(0, 1 << 20, (3, 2 * size)).astype(np.uint64)
        got = periodic.mismatches(x, y)
        for r in range(3):
            for d in range(size):
                want = sum((int(a) - int(b)) ** 2 for a, b in zip(x[r], y[r, d:d + size])) % periodic.PRIME
                assert int(got[r, d]) == want


def test_a_false_zero_of_the_modulus_is_no_run():
    """Word numbers whose squared differences add up to the prime itself."""
    a = 44_869  # 44869^2 + 108^2 and a rest that make up the prime
    left = periodic.PRIME - a * a
    parts = []
    while left:
        parts.append(int(left ** 0.5))
        left -= parts[-1] ** 2
    block = np.zeros((1, 8), np.uint64)
    there = np.array([[a, *parts] + [0] * 15], dtype=np.uint64)[:, :16]
    assert periodic.mismatches(block, there)[0, 0] == 0 and there[0, 0] > 0
    words = np.r_[block[0], there[0]].astype(np.int64)
    ids = np.r_[words, words.max() + 1]
    want = [(s, s + n, q) for s, n, q in brute_runs(words.tolist())]
    assert periodic.find_runs(ids, np.array([0]), np.array([len(words)])) == want


def test_long_periods_and_very_long_texts():
    rng = random.Random(9)
    root = [f"w{rng.randrange(50)}" for _ in range(5000)] + ["unique"]
    words = ["p"] * 3 + root * 4 + root[:77] + ["q"] * 7
    found = periodic.runs_of([" ".join(words)])[0][0]
    assert (3, 5001 * 4 + 77, 5001) in found and (3 + 5001 * 4 + 77, 7, 1) in found
    one = ["a"] * 300_000
    assert periodic.runs_of([" ".join(one)]) == ([[(0, 300_000, 1)]], ["a"])


def expected(doc_id, text):
    words = text.encode().split() if text else []
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab c d e f".split()) for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a\x0bb a\x0cb\ta b\ra b é"), (7, "a " * 30), (7, "a " * 30),
             (None, "x y " * 9), (1004, "A a " * 8), (1005, "           ")]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, path).select(*COLUMNS).collect()
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_odd_rows_pass_through_and_empty_tables(spark):
    docs = odd_docs(spark).withColumn("periodic", F.lit("old"))
    got = periodic.detect(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    by_text = {r["text"]: r["periodic"] for r in got.collect()}
    assert by_text[None]["runs"] == [] and by_text[None]["collapsed"] == ""
    long = next(v for k, v in by_text.items() if k and k.startswith("ein Hund"))
    assert [tuple(r) for r in long["runs"]] == [(0, 24000, 8)] and long["collapsed"].startswith("ein Hund")
    assert periodic.detect(no_docs(spark)).collect() == []


@pytest.mark.parametrize("text", ["", "a", "a b " * 4])
def test_collapsed_text_has_no_run(text):
    runs, collapsed = periodic.runs_of([text])
    assert periodic.runs_of(collapsed)[0] == [[]] and (not runs[0]) == (text != "a b " * 4)
