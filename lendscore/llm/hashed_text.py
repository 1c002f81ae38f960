"""Hashed terms of texts, and training by averaged shards (operators 1 and 3).

``averaged_fit`` trains on a stored, bounded sample of distinct texts that is dealt into a fixed
number of shards by a hash.  In every round each shard continues from the same
parameters in a task of its own and the driver averages what they return (a few MB
per shard).  The shards, not the cluster, fix the result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import BoundedCache, as_text, distinct_sample, list_array, slices

#: Buckets of hashed terms; shards of a training sample.
BITS, SHARDS = 18, 4
#: Letters of a word's leading part, which stands for its inflected forms.
LEADING = 4

_WORDS = regex.compile(r"\p{L}+")
_TOKENS = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")


def bucket(term: str, bits: int = BITS) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)


#: A word's own bucket and that of its leading letters, in one number.
_PAIRS = BoundedCache(lambda w: bucket("w:" + w) << 32 | bucket("l:" + w[:LEADING]), 500_000)
_SINGLES = BoundedCache(bucket, 500_000)


def presence(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words and of their leading letters, each with value 1."""
    words = set(_WORDS.findall(text.lower()))
    pairs = np.fromiter(map(_PAIRS.__getitem__, words), np.int64, len(words))
    at = np.unique(np.concatenate([pairs >> 32, pairs & 0xFFFFFFFF])).astype(np.int32)
    return at, np.ones(len(at), dtype=np.float32)


def shape_of(token: str) -> str:
    if token.isupper() and len(token) > 1:
        return "s:upper"
    if token[0].isalpha():
        return "s:title" if token[0].isupper() else "s:lower"
    return "s:digit" if token[0].isdigit() else "s:mark"


def frequencies(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words, their leading letters, marks and token shapes, with the square
    roots of their shares."""
    tokens = _TOKENS.findall(text)
    counts = Counter(map(str.lower, tokens))
    counts.update(["l:" + t[:LEADING].lower() for t in tokens])
    counts.update(map(shape_of, tokens))
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    at = np.fromiter(map(_SINGLES.__getitem__, counts), np.int64, len(counts))
    share = np.fromiter(counts.values(), np.float64, len(counts)) / (3 * len(tokens))
    at, where = np.unique(at, return_inverse=True)
    return at.astype(np.int32), np.sqrt(np.bincount(where, share)).astype(np.float32)


def training_table(labelled: DataFrame, terms: Callable, max_rows: int, text_col: str = "text",
                   label_col: str = "label") -> DataFrame:
    """``shard, label, h, at, value`` of about ``max_rows`` distinct labelled texts (all, if fewer), chosen by
    hash and stored; copies of a text with one label count once."""
    rows = labelled.select(F.col(label_col).cast("int").alias("label"),
                           as_text(F.col(text_col)).alias("text")).filter("label IS NOT NULL")
    rows = distinct_sample(rows, "text", max_rows)

    kind = T.StructType().add("at", T.ArrayType(T.IntegerType())).add("value", T.ArrayType(T.FloatType()))

    @F.arrow_udf(kind)
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [terms(t) for part in slices(batch) for t in part.to_pylist()]
            yield pa.StructArray.from_arrays(
                [list_array([f[0] for f in found], np.int32, pa.int32()),
                 list_array([f[1] for f in found], np.float32, pa.float32())], names=["at", "value"])

    shard = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(SHARDS)).cast("int")
    out = rows.select(shard.alias("shard"), "label", F.xxhash64("text").alias("h"), hashed(F.col("text")).alias("terms"))
    table = materialize(out.select("shard", "label", "h", "terms.at", "terms.value"), "training")
    if table.isEmpty() and not labelled.filter(F.col(label_col).isNotNull()).isEmpty():
        raise ValueError("the sample of labelled rows is empty")
    return table


def averaged_fit(table: DataFrame, start: list[np.ndarray], epoch: Callable, rounds: int) -> list[np.ndarray]:
    """Parameters after ``rounds`` of ``epoch(params, rows, seed) -> params`` per shard.

    ``rows`` are ``(label, at, value)``, in an order fixed by hash and seed."""
    sc = table.sparkSession.sparkContext
    shapes = [(p.shape, p.size) for p in start]
    params = [p.astype(np.float32) for p in start]

    def one_shard(held, r: int) -> Callable:
        def train(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["h", "label"], kind="stable")
            rows = list(zip(pdf["label"], pdf["at"], pdf["value"]))
            rows = [rows[i] for i in np.random.default_rng(r).permutation(len(rows))]
            out = epoch([p.copy() for p in held.value], rows)
            flat = np.concatenate([p.astype(np.float32).ravel() for p in out])
            return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "params": [flat.tobytes()]})
        return train

    for r in range(rounds):
        held = sc.broadcast(params)
        got = sorted(table.groupBy("shard").applyInPandas(one_shard(held, r), "shard int, params binary").collect())
        held.unpersist()
        mean = np.mean([np.frombuffer(g["params"], np.float32) for g in got], axis=0, dtype=np.float64)
        cuts = np.cumsum([size for _, size in shapes])[:-1]
        params = [p.reshape(shape).astype(np.float32) for p, (shape, _) in zip(np.split(mean, cuts), shapes)]
    return params


def rows_of(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, Callable]:
    """All terms of a batch behind each other, and a function that sums by text."""
    n = np.array([len(f[0]) for f in found], dtype=np.int64)
    at = np.concatenate([f[0] for f in found]) if len(found) else np.empty(0, np.int32)
    value = np.concatenate([f[1] for f in found]) if len(found) else np.empty(0, np.float32)

    def per_text(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(n), *x.shape[1:]))
        if (n > 0).any():
            out[n > 0] = np.add.reduceat(x, (np.cumsum(n) - n)[n > 0], axis=0, dtype=np.float64)
        return out

    return at, value, per_text
