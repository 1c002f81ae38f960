import base64
import inspect

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from lendscore.llm import jaccard_join
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC_SCHEMA, no_docs, odd_docs
from tests.llm.test_jaccard_join import brute
from tests.llm.test_secret_scan import plain_spans

COLUMNS = [c.split()[0] for c in DOC_SCHEMA.split(", ")]


def test_stages():
    assert [n for n, _ in C.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scan", "byte_bpe"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in C.STAGES)


@pytest.fixture(scope="module")
def stored(spark):
    """What each stage returns at the smallest size."""
    out = [spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()]
    for _, stage in C.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).cache())
    return out


def test_each_stage_against_brute_force(spark, stored):
    first, known, single, clean, hidden, coded = stored
    assert known.columns == single.columns == clean.columns == hidden.columns == first.columns
    texts = {r["doc_id"]: r["text"] for r in first.collect()}
    assert {r["doc_id"] for r in known.collect()} == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    groups = brute([(r["doc_id"], r["text"]) for r in known.collect()], 5, 80)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in groups.items() if c == i}
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert not any(item in t for item in items for t in left.values())
    lost = {r["doc_id"] for r in single.collect()} - left.keys()
    assert all(any(item[20:-20] in texts[i] for item in items) for i in lost)
    for r in hidden.collect():
        assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not plain_spans(left[r["doc_id"]]):
            assert r["text"] == left[r["doc_id"]]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    masked = {r["doc_id"]: r["text"] for r in hidden.collect()}
    for r in coded.collect():
        assert list(r["token_ids"]) == enc.encode_ordinary(masked[r["doc_id"]])


@pytest.mark.parametrize("name, stage", C.STAGES)
def test_a_task_has_one_python_worker(spark, monkeypatch, name, stage):
    """Two would stay with each core, and keep their memory, in all that follows."""
    plans = []

    def planned(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        plans.append([line for line in text.split("\n") if "ArrowEvalPython" in line or "MapInArrow" in line])
        return df

    store = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, *args: store(planned(df), *args))
    rows = [(i, f"some words of text {i} and more", "en", "a", 30) for i in range(8)]
    planned(stage(spark, spark.createDataFrame(rows, DOC_SCHEMA), SF_SMALL))
    assert all(len(found) <= 1 for found in plans)
    if name in ("secret_scan", "byte_bpe"):
        assert sum(map(len, plans)) == 2  # both steps are there


def test_texts_reach_python_in_small_batches(spark):
    own = spark.newSession()
    docs = own.range(9000, numPartitions=1).selectExpr(
        "id AS doc_id", "repeat('some words ', 180) AS text", "'en' AS lang", "'a' AS source", "1980 AS n_chars")
    C.without_secrets(own, docs, SF_SMALL)

    def sizes(batches):
        for b in batches:
            yield b.from_pydict({"n": [b.nbytes]})

    found = [r["n"] for r in docs.select("doc_id", "text").mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 16 << 20 and max(found) < 3 << 20
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "5m")
    C.without_secrets(own, docs, SF_SMALL)
    assert own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "5m"


def test_texts_stay_while_ids_of_copies_travel(spark):
    rows = [(i, f"some words of text {i // 2 * 7} and more", "en", "a", 30) for i in range(8)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = C.one_of_each_group(spark, spark.createDataFrame(rows, DOC_SCHEMA), SF_SMALL)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 6]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        ids = [r["doc_id"] for r in rows]
        if name == "language_id":
            assert sorted(i for i in ids if i is not None) == [1, 7, 7, 9, 10] and None in ids
        if name == "near_duplicates":
            assert sorted(i for i in ids if i is not None) == [1, 9, 10]


def test_no_rows(spark):
    empty = no_docs(spark).select(COLUMNS)
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0, name
