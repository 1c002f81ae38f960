import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscore.llm import hashed_text, quality, queries, toxicity
from tests.conftest import SF_ORACLE
from tests.llm.helpers import no_docs, odd_docs

SF_LARGE = "/root/testdata/sf0.1"


def auc(rows):
    score = np.array([r[0] for r in rows])
    label = np.array([r[1] for r in rows])
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


def test_pair_sum_equals_all_pairs():
    rng = np.random.default_rng(3)
    slot = np.full(1 << hashed_text.BITS, -1, np.int32)
    slot[:6] = np.arange(6)
    m = toxicity.FactorMachine(slot, rng.normal(size=6).astype(np.float32), np.array([0.2]), rng.normal(size=6),
                               rng.normal(size=(6, 3)))
    found = [(np.array([0, 2, 5], np.int32), np.ones(3, np.float32)), (np.empty(0, np.int32), np.empty(0, np.float32))]
    at = [0, 2, 5]
    x = m.odds[at]
    xp = x / np.sqrt(1 + x @ x)
    pairs = sum(m.factors[a] @ m.factors[b] * xp[i] * xp[j]
                for i, a in enumerate(at) for j, b in enumerate(at) if i < j)
    assert np.allclose(m.logits(found), [0.2 + m.weights[at] @ x + pairs, 0.2], atol=1e-5)


def test_pairs_learn_what_single_terms_cannot():
    """An insult and a group are each harmless; together they are toxic."""
    slot = np.full(1 << hashed_text.BITS, -1, np.int32)
    slot[:2] = [0, 1]
    odds = np.ones(2, np.float32)
    one = np.ones(2, np.float32)
    rows = [(0, np.array([0]), one[:1]), (0, np.array([1]), one[:1]), (1, np.array([0, 1]), one),
            (0, np.array([], np.int64), one[:0])] * 300
    params = toxicity._epoch({0: 1.0, 1: 1.0}, slot, odds)(
        [np.zeros(1), np.zeros(2), np.random.default_rng(1).normal(0, 0.3, (2, 4))], rows)
    z = toxicity.FactorMachine(slot, odds, *params).logits([(r[1], r[2]) for r in rows[:4]])
    assert z[2] > 0 > max(z[0], z[1], z[3])


def test_fit_learns_pairs_of_neutral_terms(spark):
    """Two words with the same share of toxic rows as all rows: toxic only together."""
    rng = np.random.default_rng(6)
    filler = [f"{a}{b}lo" for a in "bdfgklmnpr" for b in "aeiou"]
    rows = []
    for _ in range(2400):
        both = rng.integers(0, 4)
        own = [["quark"], ["zebu"], ["quark", "zebu"], []][both]
        toxic = int(both in (2, 3))
        own = own + (["mild"] if both == 3 else []) + list(rng.choice(filler, 8, replace=False))
        rows.append((" ".join(rng.permutation(own)), toxic))
    df = spark.createDataFrame(rows, "text string, toxic int")
    model = toxicity.fit(df)
    quark, zebu = (model.slot[hashed_text.bucket("w:" + w)] for w in ("quark", "zebu"))
    assert quark >= 0 and zebu >= 0 and model.odds[quark] == model.odds[zebu] == 0
    held = [("quark " + " ".join(filler[:8]), 0), ("zebu " + " ".join(filler[:8]), 0),
            ("quark zebu " + " ".join(filler[:8]), 1)]
    got = toxicity.predict(spark.createDataFrame(held, "text string, toxic int"), model).collect()
    assert all((r["score"] >= 0.5) == bool(r["toxic"]) for r in got), got


def test_toxicity_held_out(spark):
    """At the size that holds out enough toxic rows (84) for an estimate."""
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet").select("doc_id", "toxic", "quality")
    got = queries.op1_toxicity(spark, SF_LARGE)
    assert got.count() == spark.read.parquet(f"{SF_LARGE}/documents.parquet").count()
    rows = got.join(labels, "doc_id").filter("held_out AND quality = 1").select("score", "toxic").collect()
    assert auc(rows) >= 0.99


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").select("doc_id", "quality")
    got = queries.op3_quality(spark, SF_ORACLE).cache()
    assert got.filter("p_good < p_best - 1e-12 OR expected_grade < 0 OR expected_grade > 2").isEmpty()
    rows = got.join(labels, "doc_id").filter("held_out").select("p_good", "quality").collect()
    assert auc(rows) >= 0.9


def test_thresholds_stay_ordered():
    grades = [(g, np.array([g, 5]), np.ones(2, np.float32)) for g in (0, 1, 2)] * 200
    w, cut = quality._epoch({0: 1.0, 1: 1.0, 2: 1.0}, 3)([np.zeros(8), np.array([0.0, 0.1])], grades)
    assert cut[1] - cut[0] >= quality.GAP - 1e-9
    tails = quality.OrdinalModel(w, cut).tails([(g[1], g[2]) for g in grades[:3]])
    expected = tails.sum(axis=1)
    assert expected[0] < expected[1] < expected[2]


def test_odd_rows(spark):
    rated = odd_docs(spark).withColumn("toxic", F.col("doc_id") % 2).withColumn("grade", F.col("doc_id") % 3)
    m, q = toxicity.fit(rated), quality.fit(rated, grade_col="grade")
    rows = quality.predict(toxicity.predict(odd_docs(spark), m), q).select("score", "expected_grade").collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)
    assert toxicity.predict(no_docs(spark), m).count() == quality.predict(no_docs(spark), q).count() == 0
    none = no_docs(spark).withColumn("toxic", F.lit(1)).withColumn("grade", F.lit(1))
    rows = quality.predict(toxicity.predict(odd_docs(spark), toxicity.fit(none)), quality.fit(none, grade_col="grade"))
    assert {(r["score"], r["expected_grade"]) for r in rows.collect()} == {(0.25, 0.5)}
    with pytest.raises(ValueError):
        toxicity.fit(odd_docs(spark).withColumn("toxic", F.lit(2)))
    with pytest.raises(ValueError):
        quality.fit(odd_docs(spark).withColumn("grade", F.lit(-1)), grade_col="grade")


def test_sample_does_not_empty_and_takes_copies_once(spark):
    from pyspark.sql import functions as F

    from lendscore.llm import common, hashed_text, toxicity
    assert common.sample_share(int(5e10), 12_000) > 0 and common.sample_share(0, 5) == 1.0
    # The chance that the smallest sample gives, as the filter computes it, takes about as many of the hashes.
    n, want = 200_000, 40
    share = common.sample_share(n, want)
    unit = F.xxhash64("id").cast("double") / 2.0 ** 64 + 0.5
    assert 10 < spark.range(n).filter(unit < share).count() < 120
    hot = spark.createDataFrame([("the same text", 1)] * 4000 + [(f"text number {i}", i % 2) for i in range(300)], "text string, toxic int")
    table = hashed_text.training_table(hot, toxicity.presence, 200, label_col="toxic")
    assert 120 < table.count() < 280
    few = hashed_text.training_table(hot, toxicity.presence, 5000, label_col="toxic")
    assert few.count() == 301 and few.groupBy("shard").count().agg(F.max("count")).first()[0] < 130


def test_an_empty_sample_of_labelled_rows_fails(spark, monkeypatch):
    from lendscore.llm import hashed_text, langid, toxicity
    labelled = spark.createDataFrame([("some text", 1, "en")], "text string, toxic int, lang string")
    for module in (hashed_text, langid):
        monkeypatch.setattr(module, "distinct_sample", lambda df, *rest: df.limit(0))
    with pytest.raises(ValueError, match="empty"):
        hashed_text.training_table(labelled, toxicity.presence, 10, label_col="toxic")
    import public_tokenizers as P
    with pytest.raises(ValueError, match="empty"):
        langid.fit(labelled, P.path("piece_bpe_32k.model"))
