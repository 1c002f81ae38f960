import random
import time
from collections import Counter

import numpy as np
import pytest

from lendscore.llm import components, jaccard_join as J, parity, queries
from tests.conftest import SF_ORACLE
from tests.llm.helpers import no_docs, odd_docs


def shingles(text, size=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, size=4, percent=85):
    sets = {i: shingles(t, size) for i, t in docs}
    holders, parent = {}, {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in sorted(sets):
        common = Counter(j for g in sets[i] for j in holders.get(g, ()))
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders.setdefault(g, []).append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def result(df, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.components(df, **kw).collect()}


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op7_jaccard_join(spark, SF_ORACLE).collect()}
    assert got == brute(docs)


@pytest.mark.parametrize("size, percent, parts", [(4, 85, 4096), (5, 80, 4096), (4, 85, 3)])
def test_families_of_near_copies(spark, monkeypatch, size, percent, parts):
    """Chains of edits around common passages, and groups cut into parts."""
    monkeypatch.setattr(J, "GROUP_ROWS", parts)
    monkeypatch.setattr(J, "COMMON_TEXTS", 8)
    rng = random.Random(percent + parts)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(45)]
    docs = []
    for family in range(12):
        text = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 30, 90, 200]))]
        if family % 2:
            text += passage
        for _ in range(14):
            docs.append((len(docs), " ".join(text)))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    got = result(spark.createDataFrame(docs, "doc_id long, text string"), shingle=size, percent=percent)
    assert got == brute(docs, size, percent)


def test_linked_sets_share_keys():
    rng = np.random.default_rng(1)
    for n in (1, 4, 6, 7, 13, 40, 200, 1500):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            k = int(rng.integers(0, max(1, n // 6) + 1))
            b = np.unique(np.concatenate([a[k // 2:], rng.integers(0, 1 << 63, k - k // 2).astype(np.uint64)]))
            if not len(b) or not parity.linked(a, b):
                continue
            common = a[rng.random(len(a)) < rng.choice([0, 0.3, 0.7, 1.0])]
            keys = [set(parity.join_keys(s, np.setdiff1d(s, common)).tolist()) for s in (a, b)]
            assert len(keys[0] & keys[1]) >= parity.shared_keys(min(len(a), len(b)))


def test_sketch_distance_bounds_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 300, 100).astype(np.uint64)) for _ in range(2))
        apart = int(np.bitwise_count(parity.sketch(a, 8) ^ parity.sketch(b, 8)).sum())
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
@pytest.mark.parametrize("size", [40, 700, 1010, 1150, 1200, 2400, 4700, 4800, 9500])
def test_sets_with_nothing_in_common_are_not_near(size, percent):
    """The bound tells them apart at every size and threshold; else groups give all their pairs."""
    rng = np.random.default_rng(size + percent)
    sizes = [size, size * 100 // percent] * 6
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    # The last differs from the one before in no more elements than sets that link may.
    sets.append(sets[-1][int(parity.most_different(size, percent)):])
    a, b = np.triu_indices(len(sets), 1)
    words = np.array([parity.bound_words(len(s), percent) for s in sets])
    values = np.concatenate([parity.sketch(s, w) for s, w in zip(sets, words)])
    starts = np.cumsum(words) - words
    n = np.array([len(s) for s in sets])
    near, _ = parity.near_pairs(a, b, n, parity.short_sketches(starts, words, values), starts, words, values, percent)
    assert [(a[i], b[i]) for i in near] == [(len(sets) - 2, len(sets) - 1)]


def test_long_texts_that_share_a_passage_make_no_pairs(spark, monkeypatch):
    """Pairs to compare follow the links, not the square of a group's texts."""
    made, real = [], J.compared

    def counted(*args):
        out = real(*args)
        made.append(out.select("a", "b").distinct().count())
        return out

    monkeypatch.setattr(J, "compared", counted)
    monkeypatch.setattr(J, "COMMON_TEXTS", 1000)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    docs = [(i, " ".join(passage + [f"w{rng.randrange(10 ** 9)}" for _ in range(1090)])) for i in range(40)]
    docs += [(i + 100, docs[i][1] + " more") for i in range(3)]
    got = result(spark.createDataFrame(docs, "doc_id long, text string"), shingle=5, percent=80)
    assert got == brute(docs, 5, 80)
    assert sum(made) <= 2 * 3


def test_odd_rows(spark):
    rows = J.components(odd_docs(spark)).collect()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == 10
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4), (1, 7, 1), (7, 7, 1), (None, 7, 1)} <= got
    assert J.components(no_docs(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.component_labels(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}


def test_many_copies_of_one_row(spark):
    text, other = "a b c d e f g h", "a b c d e f g h i"
    docs = [(5, text)] * 5000 + [(3, other), (9, "x y z"), (9, "x y z")]
    rows = J.components(spark.createDataFrame(docs, "doc_id long, text string"), shingle=2, percent=85).collect()
    assert len(rows) == 5003
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == {(5, 7, 3), (3, 8, 3), (9, 2, 9)}


def test_texts_of_one_id_are_one_document(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    docs = [(3, b), (5, a), (5, b), (8, a), (9, ""), (9, a), (7, None), (11, "q r s t u v")]
    rows = J.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [
        (3, 3), (5, 3), (5, 3), (7, 7), (8, 3), (9, 3), (9, 3), (11, 11)]


def test_shuffled_sketches_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = result(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got == brute(docs)


def test_sketches_stay_while_narrow_classes_travel(spark, monkeypatch):
    """Whole sketches are shuffled only if the classes (16 bytes each) are too many to broadcast."""
    plans, real = {}, J.Intermediates.store

    def watched(self, df, name="stage"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(self, df, name)

    monkeypatch.setattr(J.Intermediates, "store", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        J.components(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "v w x y z")], "doc_id long, text string"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in ("jaccard-sets", "jaccard-groups"):
        assert "BroadcastHashJoin" in plans[name] and "SortMergeJoin" not in plans[name]


def test_narrow_copies_travel_if_the_classes_are_too_many(spark, monkeypatch):
    """Whole sketches are shuffled only if neither the classes nor the copies are few enough to broadcast."""
    plans, real = {}, J.Intermediates.store

    def watched(self, df, name="stage"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(self, df, name)

    monkeypatch.setattr(J.Intermediates, "store", watched)
    docs = [(i, f"a b c d e {i}") for i in range(6)] + [(9, "a b c d e 0"), (None, "v w x y z")]
    expected = {**brute(docs[:-1]), None: (2, None)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, joins in ((96, "BroadcastHashJoin"), (80, "BroadcastHashJoin"), (8, "SortMergeJoin")):
            monkeypatch.setattr(J, "BROADCAST_BYTES", limit)
            plans.clear()
            assert result(spark.createDataFrame(docs, "doc_id long, text string")) == expected
            for name in ("jaccard-sets", "jaccard-groups"):
                found = {kind for kind in ("BroadcastHashJoin", "SortMergeJoin") if kind in plans[name]}
                assert found == {joins}, (limit, name)
            assert ("jaccard-copies" in plans) == (limit < 96)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_odd_rows_by_every_way(spark, monkeypatch):
    found = []
    for limit in (0, 40, 1 << 20):
        monkeypatch.setattr(J, "BROADCAST_BYTES", limit)
        found.append(Counter(map(tuple, J.components(odd_docs(spark)).collect())))
    assert found[0] == found[1] == found[2]


def test_sets_with_nothing_in_common_share_no_keys():
    """Else groups are met by chance: the more sets there are, the larger all of them get."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in [60, 250, 900] * 100]
    keys = np.concatenate([np.unique(parity.join_keys(s, s, 80)) for s in sets])
    assert len(np.unique(keys)) == len(keys)


def test_shuffled_rows_go_with_their_query(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (blocks.apply(i).getName() for i in range(blocks.size())) if name.startswith("shuffle_")}

    docs = [(i, f"a b c d e f g h i j {i // 3}") for i in range(60)]
    before = files()
    J.components(spark.createDataFrame(docs, "doc_id long, text string"), percent=80)
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("size", [1, 4])
def test_sets_of_many_texts_are_those_of_each(monkeypatch, size):
    texts = ["A b c d e a b c d", None, "", " \t", "one", "One two", "x " * 40, "é ß\u0085x y\x0bz w v", "p q r s", "p q r s t"]
    sets = parity.shingle_sets(texts, size)
    assert [len(s) for s in sets] == [len(shingles(t, size)) for t in texts]
    for text, one in zip(texts, sets):
        assert one.dtype == np.uint64 and (np.diff(one.astype(object)) > 0).all()
        assert one.tolist() == parity.shingle_set(text, size).tolist()
    monkeypatch.setattr(parity, "AT_ONCE", 5)
    assert [s.tolist() for s in parity.shingle_sets(texts, size)] == [s.tolist() for s in sets]
