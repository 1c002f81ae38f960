import numpy as np
from pyspark.sql import functions as F

from lendscore.llm import neighbours as N, queries
from tests.conftest import SF_ORACLE

SCHEMA = "vec_id long, embedding array<float>, id string, rep string, vector string"


def brute(rows, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for i, q in enumerate(ids):
        if q % 20 == 0:
            s = x @ x[i]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), s[j]) for j in order]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()]
    want, got = brute(rows, 20), collect(queries.op5_nearest_neighbours(spark, SF_ORACLE))
    assert want.keys() == got.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9
    x = dict(rows)
    for q, found in got.items():
        for v, s in found:
            assert abs(np.dot(np.float64(x[q]), np.float64(x[v])) - s) < 1e-12


def test_common_vector_ties_and_invalid_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, 0.5, 0.25], "", "", "") for i in range(60)]
    rows += [(100 + i, [float(v) for v in rng.normal(size=3)], "", "", "") for i in range(60)]
    rows += [(0, [1.0, 0.5, 0.25], "", "", ""), (None, [1.0, 0.0, 0.0], "", "", "")]
    rows += [(200, None, "", "", ""), (220, [0.0, 0.0, 0.0], "", "", ""), (240, [1.0, None, 0.0], "", "", ""),
             (260, [float("nan"), 1.0, 0.0], "", "", ""), (280, [float("inf"), 1.0, 0.0], "", "", ""), (300, [1.0], "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect(N.search(df, F.pmod("id", F.lit(20)) == 0, k=20))
    valid = {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 200}
    want = brute([(i, np.float32(v)) for i, v in sorted(valid.items())], 20)
    assert want.keys() == got.keys()
    assert [a for a, _ in got[0]] == [a for a, _ in want[0]] and 0 not in [a for a, _ in got[0]]


def test_fewer_candidates_and_empty(spark):
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.6, 0.8]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = collect(N.search(three, F.pmod("id", F.lit(20)) == 0, k=20))
    assert [a for a, _ in got[0]][:1] == [1] and len(got[0]) <= 2
    assert N.search(three.limit(0), F.pmod("id", F.lit(20)) == 0).count() == 0


def test_probe_order_is_by_estimated_distance():
    h = N.Hashing(np.eye(4)[None, :, :3].repeat(N.TABLES, 0), np.zeros((N.TABLES, 3)), 1.0)
    x = np.array([[0.2, 0.9, 1.4, 0.0]])
    cells, within = h.cells(x, 0)
    codes = h.probe_codes(x, 0, 27)[0].tolist()
    assert codes[0] == h.code(cells, 0)[0] and len(set(codes)) == 27
    # The nearest border is the third number's upper one.
    assert codes[1] == h.code(cells + np.array([0, 0, 1]), 0)[0]


def test_repeated_rows_take_no_places(spark):
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(60)] * 2 + [(0, [1.0, 0.5, 0.25])] * 30
    rows += [(100 + i, [0.5, 0.5, i / 60]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collect(N.search(df, F.pmod("id", F.lit(20)) == 0, k=20))
    assert [a for a, _ in got[0]] == list(range(1, 21))
    assert [a for a, _ in got[40]] == list(range(20))
