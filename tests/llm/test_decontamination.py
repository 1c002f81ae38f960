import itertools

import pytest

from lendscore.llm import decontamination as D, queries
from tests.conftest import SF_ORACLE
from tests.llm.helpers import no_docs, odd_docs
from tests.oracle import compare, duck

ITEM = " ".join(f"word{i}" for i in range(24))


def test_masks_survive_any_three_substitutions():
    changes = D.WINDOW - D.MATCHES
    for bad in itertools.combinations(range(D.WINDOW), changes):
        assert any(not {off + i for i in m} & set(bad) for m in D.MASKS for off in range(D.WINDOW - m[-1]))


def test_query_matches_oracle(spark):
    ok, msg = compare(queries.op6_decontamination(spark, SF_ORACLE), duck(SF_ORACLE), queries.ORACLE["op6_decontamination"])
    assert ok, msg


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "five tokens make an item"), (3, "too short"), (4, None), (None, ITEM)],
                                 "item_id long, text string")


def found(spark, benchmark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r["doc_id"], r["item_id"], r["offset"]) for r in D.overlaps(docs, benchmark).collect())


def test_substitutions_case_and_marks(spark, benchmark):
    words = ITEM.split()
    three = [w if i not in (2, 8, 14) else "other" for i, w in enumerate(words[:16])]
    four = [w if i not in (2, 6, 10, 14) else "other" for i, w in enumerate(words[:16])]
    got = found(spark, benchmark, "a b " + ITEM.upper() + ", c", " ".join(three), " ".join(four), " ".join(words[:12]),
                "x FIVE tokens make, an item y", "five tokens make one item", "too short", ITEM + " " + ITEM)
    assert got == [(0, 1, 2), (1, 1, 0), (4, 2, 1), (7, 1, 0), (7, 1, 24)]


def test_odd_rows_and_joined_hashes(spark, benchmark, monkeypatch):
    assert D.overlaps(odd_docs(spark), benchmark).count() == 0
    assert D.clean(odd_docs(spark), benchmark).count() == 10
    assert D.overlaps(no_docs(spark), benchmark).count() == 0
    assert D.overlaps(odd_docs(spark), benchmark.limit(0)).count() == 0
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    assert found(spark, benchmark, ITEM) == [(0, 1, 0)]


def test_short_masks_survive_their_substitutions():
    assert [D.allowed(n) for n in (1, 5, 6, 10, 11, 15, 16, 99)] == [0, 0, 1, 1, 2, 2, 3, 3]
    for n in range(1, D.WINDOW):
        for bad in itertools.combinations(range(n), D.allowed(n)):
            assert any(not {off + i for i in m} & set(bad) for m in D.masks_of(n) for off in range(n - m[-1])), (n, bad)


def test_short_items_may_be_substituted(spark):
    """Every choice of allowed substitutions is found, one more is not."""
    items = spark.createDataFrame([(n, " ".join(f"i{n}w{i}" for i in range(n))) for n in range(5, 16)],
                                  "item_id long, text string")
    docs, want = [], set()
    for n in range(5, 16):
        for more in (0, 1):
            for bad in itertools.combinations(range(n), D.allowed(n) + more):
                if not more:
                    want.add((len(docs), n, 2, n - D.allowed(n)))
                own = " ".join("other" if i in bad else f"i{n}w{i}" for i in range(n))
                docs.append((len(docs), f"a b {own} c"))
    got = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {tuple(r) for r in got} == want


def test_scripts_without_spaces(spark):
    items = spark.createDataFrame([(1, "今天天气很好，我们去公园。"), (2, "猫がソファーで寝ている"), (3, "yes no")],
                                  "item_id long, text string")
    docs = [(0, "他说：今天天气很好，我们去公园。然后走了"), (1, "昨日、猫がソファーで寝ていると聞いた"), (2, "今天去公园"), (3, "yes no")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.overlaps(docs, items).collect()} == {(0, 1), (1, 2)}
    assert {(r["doc_id"], r["item_id"]) for r in D.overlaps(docs, items, shortest=1).collect()} == {(0, 1), (1, 2), (3, 3)}
