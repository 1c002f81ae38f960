"""Histogram boosting: growth against brute force, scans against one task, and studies that go on."""

import itertools
import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lendscore.config import credit_settings
from lendscore.operators import boosting, metrics, models, split, study
from lendscore.operators import trees as T
from lendscore.plans import catalog
from tests.conftest import SF_SMALL


def brute_best(bins, g, h, nominal, l2, min_rows):
    """The largest gain over all cuts of numbers, and all two-set partitions of nominal features."""
    def term(mask):
        return g[mask].sum() ** 2 / (h[mask].sum() + l2)

    best = -np.inf
    for f in range(bins.shape[1]):
        values = np.unique(bins[:, f])
        sets = ([set(c) for r in range(1, len(values)) for c in itertools.combinations(values.tolist(), r)] if nominal[f]
                else [set(values[:k].tolist()) for k in range(1, len(values))])
        for left in sets:
            mask = np.isin(bins[:, f], list(left))
            if min(mask.sum(), (~mask).sum()) >= min_rows:
                best = max(best, term(mask) + term(~mask) - term(mask | True))
    return best


@pytest.mark.parametrize("l2", [0.0, 1.5])
def test_best_split_equals_all_partitions(monkeypatch, l2):
    """The order by gradient over hessian holds the best of all two-set partitions (without smoothing)."""
    monkeypatch.setattr(T, "SMOOTH", l2)
    rng = np.random.default_rng(1)
    for nominal in ([False, False], [True, True], [False, True]):
        bins = rng.integers(0, 6, (300, 2)).astype(np.uint8)
        y = (rng.random(300) < 0.2 + 0.1 * (bins[:, 1] % 3)).astype(float)
        g, h = 0.4 - y, np.full(300, 0.24)
        layout = T.Layout([6, 6], nominal)
        rows = T.LocalRows(bins, layout, np.zeros(300, int))
        rows.start(g, h, np.arange(300))
        gain, _, _ = T.best_splits(rows(T.Growth(layout.bins), [0]), layout, l2, 20)
        assert gain[0] == pytest.approx(brute_best(bins, g, h, nominal, l2, 20))


def test_growth_is_best_first_and_leaf_values_have_the_penalty():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 30, (2000, 3)).astype(np.uint8)
    y = (rng.random(2000) < 0.1 + 0.8 * bins[:, 0] * bins[:, 1] / 900).astype(float)
    layout = T.Layout([30] * 3, [False] * 3)
    trees, _ = T.boost([(bins, y)], layout, [{"n_estimators": 1, "learning_rate": 0.3, "num_leaves": 7, "reg_lambda": 2.0}], 1)
    tree = trees[0][0]
    assert (tree.feature < 0).sum() == 7
    p, leaf = y.mean(), tree.leaves(bins)
    for k in np.unique(leaf):
        own = leaf == k
        assert own.sum() >= T.MIN_ROWS
        assert tree.value[k] == pytest.approx(-0.3 * (p - y[own]).sum() / (own.sum() * p * (1 - p) + 2.0))
    # One leaf fewer is the same tree without its last, least useful split.
    fewer, _ = T.boost([(bins, y)], layout, [{"n_estimators": 1, "learning_rate": 0.3, "num_leaves": 6, "reg_lambda": 2.0}], 1)
    merged = [len(np.unique(leaf[fewer[0][0].leaves(bins) == k])) for k in np.unique(fewer[0][0].leaves(bins))]
    assert sorted(merged) == [1, 1, 1, 1, 1, 2]


def test_a_set_of_categories_is_learned_in_one_split():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 12, (3000, 1)).astype(np.uint8)
    y = np.isin(bins[:, 0], [1, 4, 5, 8, 11]).astype(float)
    params = [{"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 2}]
    as_set, _ = T.boost([(bins, y)], T.Layout([12], [True]), params, 1)
    as_number, _ = T.boost([(bins, y)], T.Layout([12], [False]), params, 1)

    def impurity(tree):
        leaf = tree.leaves(bins)
        return sum(min(y[leaf == k].sum(), (1 - y[leaf == k]).sum()) for k in np.unique(leaf))

    assert impurity(as_set[0][0]) == 0 < impurity(as_number[0][0])


def test_models_in_step_equal_models_alone():
    rng = np.random.default_rng(4)
    data = [(rng.integers(0, 16, (n, 4)).astype(np.uint8), (rng.random(n) < 0.4).astype(np.uint8)) for n in (400, 700, 300)]
    layout = T.Layout([16] * 4, [False, True, False, True])
    params = [{"n_estimators": n, "learning_rate": 0.1, "num_leaves": k, "reg_lambda": l2} for n, k, l2 in ((5, 6, 0.0), (9, 12, 1.0), (3, 3, 0.5))]
    together, raw = T.boost(data, layout, params, 1, [b for b, _ in data])
    for own, p, score in zip(data, params, raw):
        alone, found = T.boost([own], layout, [p], 1, [own[0]])
        assert np.allclose(found[0], score)
    assert T.average_precision(np.array([1, 0, 1, 0]), np.array([0.9, 0.9, 0.5, 0.1])) == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


def vectors(spark, n=3000):
    df = spark.range(n).select(
        ((F.col("id") * 7919) % 1009).cast("double").alias("a"), ((F.col("id") * 31) % 97).cast("double").alias("b"),
        ((F.col("id") * 13) % 5 - 1).cast("double").alias("c"),
        ((F.xxhash64("id") % 100 < F.when((F.col("id") * 13) % 5 > 2, 40).otherwise(-20)).cast("int")).alias("label"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_scans_grow_the_same_trees_as_one_task(spark, monkeypatch):
    df = vectors(spark)
    params = json.dumps({"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 6, "reg_lambda": 0.5})
    fitted = boosting.BoostedTrees(params_json=params, nominal=[2]).fit(df)
    whole = fitted.trees
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    for limit in (boosting.DRIVER_BYTES, 0):
        monkeypatch.setattr(boosting, "DRIVER_BYTES", limit)
        scans = boosting.BoostedTrees(params_json=params, nominal=[2]).fit(df.repartition(3)).trees
        for a, b in zip(whole, scans, strict=True):
            assert a.feature.tolist() == b.feature.tolist() and a.left.tolist() == b.left.tolist()
            assert (a.goes_left == b.goes_left).all() and np.allclose(a.value, b.value)


def test_rows_of_some_nodes_are_those_that_end_there():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 20, (3000, 3)).astype(np.uint8)
    y = (rng.random(3000) < 0.1 + 0.04 * bins[:, 0]).astype(np.uint8)
    layout = T.Layout([20] * 3, [False, True, False])
    tree = T.boost([(bins, y)], layout, [{"n_estimators": 1, "learning_rate": 0.3, "num_leaves": 12}], 1)[0][0][0]
    leaf, used = tree.leaves(bins), np.flatnonzero(rng.random(3000) < 0.7)
    ends = np.flatnonzero(tree.feature < 0).tolist()
    for nodes in (ends, ends[2:5], [0], ends[:1]):
        found = dict(tree.parts(np.asfortranarray(bins), used, nodes))
        assert sorted(found) == sorted(nodes)
        for k, rows in found.items():
            assert rows.tolist() == (used if k == 0 else used[leaf[used] == k]).tolist()
    # Sums by feature are those by row, to the last bit.
    g, h, slot = rng.random(3000), rng.random(3000), rng.integers(0, 4, 3000)
    one, two = np.zeros((4, 3, layout.size)), np.zeros((4, 3, layout.size))
    T.add_sums(one, layout.flat(bins), slot, g, h)
    T.add_columns(two, layout, bins, np.arange(3000), slot, g, h)
    assert (one == two).all()


def test_scans_start_from_kept_scores(spark, monkeypatch):
    """Blocks of a growing forest hold the scores of all its trees, so no scan walks through earlier trees again."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400)
    monkeypatch.setattr(boosting, "REFRESH", 3)
    seen, real = [], boosting._Forest._sums

    def watched(self, growth, nodes):
        out = real(self, growth, nodes)
        if len(nodes) == 1 and nodes[0] == 0:
            seen.append([(b, n, np.frombuffer(bins, np.uint8).reshape(-1, n).T, np.frombuffer(raw))
                         for b, n, bins, _, raw in self.blocks.collect()])
            assert not self.stale and self.blocks.is_cached
        return out

    monkeypatch.setattr(boosting._Forest, "_sums", watched)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    params = json.dumps({"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 6})
    model = boosting.BoostedTrees(params_json=params, nominal=[2]).fit(vectors(spark).repartition(3))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    start = json.loads(model.getOrDefault(model.state))["start"]
    assert len(seen) == 5 and len(seen[0]) > 1
    for k, blocks in enumerate(seen):
        assert sum(n for _, n, _, _ in blocks) == 3000 and len({b for b, _, _, _ in blocks}) == len(blocks)
        for _, n, bins, raw in blocks:
            expected = np.full(n, start)
            for tree in model.trees[:k]:
                expected += tree.value[tree.leaves(bins)]
            assert (raw == expected).all()


def test_saved_model_scores_alike_and_takes_unseen_codes(spark, tmp_path):
    df = vectors(spark)
    params = json.dumps({"n_estimators": 4, "learning_rate": 0.3, "num_leaves": 5, "subsample": 0.6})
    fitted = boosting.BoostedTrees(params_json=params, nominal=[2]).fit(df)
    again = boosting.BoostedTrees(params_json=params, nominal=[2]).fit(df)
    assert fitted.getOrDefault(fitted.state) == again.getOrDefault(again.state)  # the row share has a seed
    fitted.save(f"{tmp_path}/model")
    loaded = boosting.BoostedTreesModel.load(f"{tmp_path}/model")
    odd = df.limit(5).union(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame([(1e9, -5.0, 77.0, 1)], "a double, b double, c double, label int")))
    one, two = (m.transform(odd).select("probability", "prediction").collect() for m in (fitted, loaded))
    assert one == two and all(0 < r["probability"][1] < 1 for r in one)
    with pytest.raises(ValueError, match="no labelled rows"):
        boosting.BoostedTrees().fit(df.limit(0))


def small_study(spark):
    rows = catalog.feature_rows(spark, SF_SMALL)
    p = F.when(F.col("Purpose").isin("car", "business"), 0.7).otherwise(0.2)
    rows = rows.withColumn("Risk", (F.pmod(F.xxhash64("CustomerId"), F.lit(1000)) / 1000 < p).cast("int"))
    train = split.stratified_split(rows, "CustomerId", "Risk", n_folds=3).filter(~F.col("is_test"))
    space = {**models.SEARCH_SPACE, "n_estimators": ("int", 3, 6), "learning_rate": ("log", 0.1, 0.3), "num_leaves": ("int", 3, 6)}
    return train, models.sample_trials(5, 1, space)


def test_killed_study_repeats_no_finished_trial(spark, tmp_path, monkeypatch):
    train, trials = small_study(spark)
    s = credit_settings()
    calls = []
    real = study._fit_wave

    def dying(spark, folds, wave, *rest):
        if len(calls) == 1:
            raise KeyboardInterrupt
        calls.append([t for t, _ in wave])
        return real(spark, folds, wave, *rest)

    monkeypatch.setattr(study, "_fit_wave", dying)
    path = f"{tmp_path}/study"
    with pytest.raises(KeyboardInterrupt):
        study.run(train, s, trials, 3, "fold", 1, parallelism=2, path=path)
    assert study.results(spark, path).count() == 2 * 3

    def counting(spark, folds, wave, *rest):
        calls.append([t for t, _ in wave])
        return real(spark, folds, wave, *rest)

    monkeypatch.setattr(study, "_fit_wave", counting)
    seen = {}
    # The lost driver's lease is taken over at once here.
    done = study.run(train, s, trials, 3, "fold", 1, parallelism=2, path=path, lease_seconds=0.0, on_wave=seen.update)
    assert sorted(t for wave in calls for t in wave) == list(range(5)) and len(seen) == 3
    whole = study.run(train, s, trials, 3, "fold", 1)
    key = lambda df: sorted((r["trial"], r["fold"], r["score"]) for r in df.collect())
    assert key(done) == key(whole) and len(key(done)) == 15
    base = train.agg(F.avg("Risk")).first()[0]
    assert min(s for _, _, s in key(done)) > base


def test_two_drivers_share_the_trials(spark, tmp_path):
    path = f"{tmp_path}/study"
    assert study.lease(spark, path, 3, 60.0) and not study.lease(spark, path, 3, 60.0)
    assert study.lease(spark, path, 4, 60.0)
    assert study.lease(spark, path, 3, -1.0)  # the first lease counts as expired


def test_optimality_certificate_tells_an_unfinished_fit(spark):
    s = credit_settings()
    train = split.stratified_split(catalog.feature_rows(spark, SF_SMALL), "CustomerId", "Risk").filter(~F.col("is_test"))
    fitted = models.fit(train, s, "baseline")
    good = models.optimality(fitted, train, s).first()
    assert good["max_gradient"] < 1e-4 and -1e-9 < good["relative_gap"] < 1e-4 and good["n_rows"] == train.count()
    early = models.build_pipeline(s, "baseline", train.count())
    early.getStages()[-1].setMaxIter(1)
    bad = models.optimality(early.fit(train), train, s).first()
    assert bad["relative_gap"] > 10 * max(good["relative_gap"], 1e-9)


def test_boosted_pipeline_beats_the_base_rate(spark):
    train, _ = small_study(spark)
    s = credit_settings(hyperparameters={"n_estimators": 10, "learning_rate": 0.3, "num_leaves": 4})
    scored = models.score(models.fit(train, s, "boosted"), train, ["CustomerId"], extra=["Risk"])
    assert metrics.roc_auc(scored, "Risk", models.P1).first()[0] > 0.7
