"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 5).

Nearness is the largest inner product.  Vectors are scaled to length at most 1 and get
one more coordinate that makes it 1, after which the largest inner product is the
smallest distance, for which Gaussian (2-stable) projections ``floor((a.x + b) / w)`` hash
near vectors alike.  A table's bucket is ``M`` such numbers.  A query visits, per table, the
buckets that differ from its own by -1, 0 or 1 in each number, in the order of estimated
success: the sum of its squared distances to the cell borders it would cross.
The candidates of all tables are merged and ranked by exact inner products of the
original vectors in double precision.

How many buckets a query visits is *fitted* on a bounded sample (``SAMPLE`` vectors and
``SAMPLE_QUERIES`` queries, by hash): the smallest number that finds ``TARGET`` of the sample's own
nearest vectors.  A sample is sparser than the table, so its neighbours are farther and
harder to find.  Every row is indexed; nothing caps a bucket or a candidate list.

Scale: equal vectors become one *class* first (with its ``k + 1`` smallest ids: all have the same
product with any query, and no more can enter a result), so a vector with a third of
all rows is one index row.  Index rows are grouped by a hash of table and bucket into groups of about
``GROUP_ROWS``; buckets beyond that size are split by a salt that queries visit in full.  Queries
meet a group in chunks of about ``CHUNK_QUERIES``.  A task so holds one group and one
chunk, and returns at most ``k + 1`` rows per query.

Defined results: null ids, and vectors that are null, zero, hold null or non-finite
components or have another length than most take no part; ties go to the smaller id;
rows that repeat id and vector are one candidate; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

TABLES, WIDTH, TARGET = 8, 1.5, 0.97
SAMPLE, SAMPLE_QUERIES = 4_096, 256
GROUP_ROWS, CHUNK_QUERIES = 65_536, 8_192
#: Queries whose scores a task holds at once.
BLOCK_QUERIES = 128


@dataclass
class Hashing:
    """Projections of all tables; ``largest`` is the greatest vector length."""

    a: np.ndarray  # (tables, dim + 1, m)
    b: np.ndarray  # (tables, m)
    largest: float
    probes: int = 0

    @property
    def m(self) -> int:
        return self.a.shape[2]

    def extended(self, x: np.ndarray, query: bool) -> np.ndarray:
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.hstack([unit, np.zeros((len(x), 1))])
        unit = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        return np.hstack([unit, rest[:, None]])

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash numbers of extended vectors, and their places within the cells."""
        f = (x @ self.a[table] + self.b[table]) / WIDTH
        h = np.floor(f)
        return h.astype(np.int64), f - h

    def code(self, cells: np.ndarray, table: int) -> np.ndarray:
        """One number per table and bucket; cells are within +-32 for unit vectors."""
        powers = 64 ** np.arange(self.m, dtype=np.int64)
        return (np.clip(cells, -31, 31) + 32) @ powers * TABLES + table

    def probe_codes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """Codes of the buckets that each query visits, best first."""
        steps = np.array(list(itertools.product((0, -1, 1), repeat=self.m)), dtype=np.int64)
        cells, within = self.cells(x, table)
        cost = within ** 2 @ (steps == -1).T + (1 - within) ** 2 @ (steps == 1).T
        probes = min(probes, len(steps))
        best = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(cost, best, 1), axis=1, kind="stable"), 1)
        return self.code(cells[:, None, :] + steps[best], table)


def numbers_per_table(n: int) -> int:
    return 6 if n < 1_000_000 else 7 if n < 30_000_000 else 8


def fit(vectors: np.ndarray, queries: np.ndarray, n: int, k: int, largest: float) -> Hashing:
    """Projections, and the number of probes that finds ``TARGET`` of the sample's neighbours."""
    rng = np.random.default_rng(11)
    m = numbers_per_table(n)
    hashing = Hashing(rng.normal(size=(TABLES, vectors.shape[1] + 1, m)), rng.uniform(0, WIDTH, (TABLES, m)), largest)
    near = max(1, min(len(vectors) - 1, round(k * len(vectors) / n)))
    scores = queries @ vectors.T
    same = (queries[:, None, :1] == vectors[None, :, :1])[:, :, 0] & (scores >= (queries ** 2).sum(1)[:, None] * (1 - 1e-12))
    scores[same] = -np.inf
    true = np.argsort(-scores, axis=1)[:, :near]
    base, probe = hashing.extended(vectors, False), hashing.extended(queries, True)
    most = 3 ** m
    # The first probe, in any table, that finds each true neighbour.
    first = np.full(true.shape, most + 1)
    for t in range(TABLES):
        codes = hashing.code(hashing.cells(base, t)[0], t)
        for s in range(0, len(queries), 32):
            visits = hashing.probe_codes(probe[s:s + 32], t, most)
            hit = visits[:, None, :] == codes[true[s:s + 32]][:, :, None]
            place = np.where(hit.any(axis=2), hit.argmax(axis=2) + 1, most + 1)
            first[s:s + 32] = np.minimum(first[s:s + 32], place)
    hashing.probes = int(min(most, np.quantile(first, TARGET, method="higher"))) if first.size else most
    return hashing


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector array<double>`` of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
                       & F.exists("vector", lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (usual["n"] if usual else 0))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """``vector, rep, members``: each distinct vector with its ``k + 1`` smallest ids.  Repeated
    rows are dropped first, so that they take no places; the window's limit acts before its shuffle, so a common vector sends that many rows per task."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.select("id", "vector").distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    return few.groupBy("vector").agg(F.min("id").alias("rep"), F.array_sort(F.collect_set("id")).alias("members"))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.empty((0, 0))


def _group_of(codes: np.ndarray, salt: np.ndarray | int, groups: int) -> np.ndarray:
    """A spread-out group number per bucket and salt."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(salt).astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(groups)).astype(np.int64)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` largest scores, ties to smaller ids."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        row, col = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    else:
        row, col = np.nonzero(np.isfinite(scores))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def search_group(codes: np.ndarray, reps: np.ndarray, vectors: np.ndarray, query_reps: np.ndarray,
                 queries: np.ndarray, visits: list[np.ndarray], k: int) -> Iterator[tuple]:
    """Best ``k`` candidates of each query in one group of buckets: ``(query, rep, score)`` arrays."""
    order = np.argsort(codes, kind="stable")
    codes, reps, vectors = codes[order], reps[order], vectors[order]
    bucket, first = np.unique(codes, return_index=True)
    last = np.append(first[1:], len(codes))
    own, column = np.unique(reps, return_inverse=True)
    for s in range(0, len(queries), BLOCK_QUERIES):
        part = visits[s:s + BLOCK_QUERIES]
        wanted = np.concatenate(part)
        who = np.repeat(np.arange(len(part)), [len(v) for v in part])
        at = np.minimum(np.searchsorted(bucket, wanted), len(bucket) - 1)
        there = bucket[at] == wanted
        at, who = at[there], who[there]
        by_bucket = np.argsort(at, kind="stable")
        at, who = at[by_bucket], who[by_bucket]
        scores = np.full((len(part), len(own)), -np.inf)
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        for a, b in zip(starts, np.append(starts[1:], len(at))):
            rows = slice(first[at[a]], last[at[a]])
            scores[who[a:b, None], column[rows]] = queries[s + who[a:b]] @ vectors[rows].T
        row, col = _top(scores, own, k)
        yield query_reps[s + row], own[col], scores[row, col]


def search(df: DataFrame, query_filter, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every row that meets
    ``query_filter`` (a condition on ``id``), itself left out."""
    spark = df.sparkSession
    rows = valid_vectors(df, id_col, vector_col)
    classes = materialize(classes_of(rows, k), "ann-classes")
    query_ids = materialize(rows.filter(query_filter).select("id", "vector").distinct()
                            .join(classes.select("vector", "rep"), "vector").select("id", "rep"), "ann-queries")
    facts = classes.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x * x)).alias("sq")).first()
    asked = classes.join(query_ids.select("rep").distinct(), "rep", "left_semi").select("rep", "vector")
    n, n_queries = facts["n"], query_ids.select("rep").distinct().count()
    out = "query_id long, rank int, vec_id long, score double"
    if not n_queries:
        return spark.createDataFrame([], out)

    def sample(frame: DataFrame, size: int, total: int) -> np.ndarray:
        share = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(min(1.0, size / total) * (1 << 20))
        return _matrix([r["vector"] for r in frame.filter(share).select("vector").collect()])

    vectors, queries = sample(classes, SAMPLE, n), sample(asked, SAMPLE_QUERIES, n_queries)
    if len(vectors) < 2 or not len(queries):  # a table so small that all of it is the sample
        vectors = queries = _matrix([r["vector"] for r in classes.limit(SAMPLE).collect()])
    held = spark.sparkContext.broadcast(fit(vectors, queries, n, k, math.sqrt(facts["sq"])))
    groups = -(-n * TABLES // GROUP_ROWS)

    def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = held.value
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist())
            if not len(x):
                continue
            ext = hashing.extended(x, False)
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            for t in range(TABLES):
                codes = hashing.code(hashing.cells(ext, t)[0], t)
                yield pa.RecordBatch.from_arrays([pa.array(codes), batch.column(0), raw], names=["code", "rep", "vector"])

    index = classes.select("rep", "vector").mapInArrow(index_rows, "code long, rep long, vector binary")
    # Buckets beyond a group's size, at most one per GROUP_ROWS index rows, and their parts.
    large = {r["code"]: -(-r["count"] // GROUP_ROWS) for r in
             index.groupBy("code").count().filter(F.col("count") > GROUP_ROWS).collect()}
    parts = spark.sparkContext.broadcast(large)
    touched = min(groups, TABLES * held.value.probes)
    chunks = max(1, -(-n_queries * touched // (groups * CHUNK_QUERIES)))

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, reps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            salt = np.array([rep % parts.value.get(c, 1) for c, rep in zip(codes.tolist(), reps.tolist())], np.int64)
            group = pa.array(_group_of(codes, salt, groups), pa.int64())
            for c in range(chunks):
                yield pa.RecordBatch.from_arrays([group, pa.array(np.full(len(codes), c, np.int32)), *batch.columns],
                                                 names=["grp", "chunk", "code", "rep", "vector"])

    def visit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = held.value
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                rows = batch.slice(s, 256)
                x, reps = _matrix(rows.column(1).to_pylist()), rows.column(0).to_pylist()
                ext = hashing.extended(x, True)
                codes = np.hstack([hashing.probe_codes(ext, t, hashing.probes) for t in range(TABLES)])
                got = {"grp": [], "chunk": [], "rep": [], "vector": [], "codes": []}
                for rep, v, own in zip(reps, x, codes):
                    salts = [parts.value.get(c, 1) for c in own.tolist()] if parts.value else 1
                    every = np.repeat(own, salts)
                    salt = np.concatenate([np.arange(p) for p in salts]) if parts.value else 0
                    grp = _group_of(every, salt, groups)
                    order = np.argsort(grp, kind="stable")
                    for g, own_codes in zip(*_runs(grp[order], every[order])):
                        for key, value in zip(got, (g, rep % chunks, rep, v.tobytes(), np.unique(own_codes).tobytes())):
                            got[key].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got["grp"], pa.int64()), pa.array(got["chunk"], pa.int32()), pa.array(got["rep"], pa.int64()),
                     pa.array(got["vector"], pa.binary()), pa.array(got["codes"], pa.binary())], names=list(got))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "rep": [], "score": []}).astype({"query": "int64", "rep": "int64"})
        right = right.sort_values("rep", kind="stable")
        base = np.frombuffer(b"".join(left["vector"])).reshape(len(left), -1)
        asked_for = np.frombuffer(b"".join(right["vector"])).reshape(len(right), -1)
        visits = [np.frombuffer(c, np.int64) for c in right["codes"]]
        got = [np.concatenate(x) for x in zip(*search_group(
            left["code"].to_numpy(), left["rep"].to_numpy(), base, right["rep"].to_numpy(), asked_for, visits, k + 1))]
        return pd.DataFrame(dict(zip(("query", "rep", "score"), got)))

    placed = index.mapInArrow(place_rows, "grp long, chunk int, code long, rep long, vector binary")
    visits = asked.mapInArrow(visit_rows, "grp long, chunk int, rep long, vector binary, codes binary")
    found = (placed.groupBy("grp", "chunk").cogroup(visits.groupBy("grp", "chunk"))
             .applyInPandas(meet, "query long, rep long, score double"))
    found = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    near = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    near = near.join(classes.select("rep", "members"), "rep").select("query", "score", F.explode("members").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    final = (near.join(query_ids.select(F.col("rep").alias("query"), F.col("id").alias("query_id")), "query")
             .filter(F.col("vec_id") != F.col("query_id")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (final.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Distinct sorted keys and the values of each."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts].tolist(), np.split(values, starts[1:])
