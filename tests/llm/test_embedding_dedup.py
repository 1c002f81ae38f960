"""Embedding near-duplicates against all pairs of a small table."""

import math

import numpy as np
import pytest

from lendscore.llm import embedding_dedup as op
from lendscore.llm import queries


def brute(rows, cosine=op.COSINE):
    """``(id, n_links, component, kept)`` by all pairs; ids are unique here."""
    def able(v):
        return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    least = {r[0]: r[0] for r in rows}
    links = dict.fromkeys(least, 0)

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, (i, v, label) in enumerate(rows):
        for j, w, other in rows[:k]:
            if label is None or label != other or not able(v) or not able(w) or len(v) != len(w):
                continue
            a, b = np.array(v, float), np.array(w, float)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return sorted((i, links[i], root(i), root(i) == i) for i in least)


def vectors(seed, n, dim, labels=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        near = rng.random()
        if rows and near < 0.4:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, 0.08 / math.sqrt(dim), dim) * (near > 0.1)
        else:
            v = rng.normal(0, 1, dim) / math.sqrt(dim)
        rows.append((i, [float(c) for c in v], int(rng.integers(labels))))
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def result(spark, rows, schema=SCHEMA):
    return sorted(tuple(r) for r in op.near_duplicates(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect())


@pytest.mark.parametrize("tile", [4096, 16])
def test_equals_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(op, "TILE", tile)
    rows = vectors(tile, 400, 24)
    want = brute(rows)
    assert sum(r[1] for r in want) > 100
    assert result(spark, rows) == want


def test_bounds_leave_out_no_pair_and_stop_early():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 32))
    y = np.concatenate([x[:100] + rng.normal(0, 0.03, (100, 32)), rng.normal(size=(200, 32))])
    frame = op.Frame(np.concatenate([x, y]), 3)
    cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    got = {(int(i), int(j)) for a, b in op.linked_rows(x, y, frame.axes, 0.98) for i, j in zip(a, b)}
    assert got == set(zip(*map(list, np.nonzero(cos >= 0.98)))) and len(got) >= 100
    assert len(np.unique(frame.cell(frame.rotated(x)))) == 8


def test_boxes_part_tiles_of_distant_clusters(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 32)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (8, 16))
    rows = [(i, [float(c) for c in centres[i % 8] + rng.normal(0, 0.02, 16)], 0) for i in range(480)]
    from lendscore.session import Intermediates
    with Intermediates(spark) as own:
        df = spark.createDataFrame(rows, SCHEMA).selectExpr(
            "vec_id key", "vec_id id", "1L n", "cast(label as string) label", "16 dim", "embedding vector")
        frames = op.fitted_frames(df)
        table = op.tiles(df, frames, own)
        m = table.count()
        pairs = op.near_tiles(table, 0.98).count()
    assert m >= 8 and pairs < m * (m + 1) // 3
    assert result(spark, rows) == brute(rows)


def test_many_copies_and_near_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 256)
    rng = np.random.default_rng(6)
    v = rng.normal(size=16)
    rows = [(i, [float(c) for c in v], 1) for i in range(3000)]
    rows += [(3000 + i, [float(c) for c in v + rng.normal(0, 0.005, 16)], 1) for i in range(900)]
    got = result(spark, rows)
    assert got == [(i, 3899, 0, i == 0) for i in range(3900)]


def test_odd_rows(spark):
    one, up = [0.6, 0.8], [6e-200, 8e-200]
    rows = [(5, one, 1), (3, up, 1), (9, [3e200, 4e200], 1), (4, one, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1),
            (10, [0.6, None], 1), (11, [float("nan"), 0.8], 1), (12, [float("inf"), 0.8], 1), (13, [0.6, 0.8, 0.0], 1),
            (14, [0.6, -0.0], 2), (15, [0.6, 0.0], 2), (16, one, 2)]
    assert result(spark, rows) == [
        (3, 2, 3, True), (4, 0, 4, True), (5, 2, 3, False), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
        (9, 2, 3, False), (10, 0, 10, True), (11, 0, 11, True), (12, 0, 12, True), (13, 0, 13, True), (14, 1, 14, True),
        (15, 1, 14, False), (16, 0, 16, True)]
    repeated = [(1, one, 1), (1, one, 1), (2, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 1), (None, one, 1)]
    got = op.near_duplicates(spark.createDataFrame(repeated, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(1, 0, 1, True)] * 2 + [(2, 1, 2, True)] * 2 + [(3, 1, 2, False), (None, 0, None, False)], key=str)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 1)], SCHEMA)
    extra = df.selectExpr("*", *[f"'x' AS {c}" for c in ("id", "n", "key", "dim", "n_links", "component_id", "kept", "cell")])
    assert sorted(map(tuple, op.near_duplicates(extra).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_query_equals_all_pairs(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in queries.op13_embedding_dedup(spark, path).select(*COLUMNS).collect())
    assert got == brute(rows)
