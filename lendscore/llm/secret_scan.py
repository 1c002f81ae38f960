"""Secret scans with a randomness test battery (operator 9).

Three fixed patterns give the *base* spans: ``assign`` (a credential name, a
separator, a value), ``access`` (access key ids) and ``hex`` (long lower-case
hexadecimal runs).  The method adds ``random`` spans: long runs of key
characters that look drawn at random.

A candidate is a run of ``MIN_RUN`` or more characters of ``A-Za-z0-9+/_-`` with
at least a letter and a digit, or letters of both cases after the first.  Its
encoding is inferred from its characters (hex, base-32, base-36 of one case, base-62 or base-64) and
mapped to code numbers, on which three tests run:

* chi-squared uniformity of the codes over bins.  The null hypothesis is
  *ordinary text*: characters drawn from the corpus's own frequencies (counted
  over all documents), under which the statistic follows a non-central
  chi-squared law whose centre grows with the length.  The p-value is the chance
  that ordinary text looks this uniform, so short runs cannot reach a small one.
  Lower-case and base-36 alphabets share their letters with ordinary words: their bins
  are filled in the order of the corpus's frequencies, which tells words from
  uniform codes best, and the law's lower tail is Sankaran's approximation;
  a run whose codes are not uniform (p below ``NOT_UNIFORM``) is ordinary there;
* the runs test (codes above and below the middle) and
* lag-one serial correlation: a candidate that either test finds not random
  (p below ``NOT_RANDOM``) is ordinary, with p-value 1.

Benjamini-Hochberg over the candidates of all documents then fixes the p-value
up to which candidates are secrets, so that about ``FDR`` of the added spans at
most are false.  As the p-values already hold the length, the control does too.

Counting characters and candidate p-values are one partial aggregation each
(256 rows and one row per p-value class reach the driver); scanning is
an Arrow UDF without a shuffle.

Defined results: a null or empty text has no spans; candidates that touch a
base span add nothing; repeated rows are counted as often as they occur; with
no candidates, nothing is added; columns named like the output are replaced, all
others pass through.  Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, slices

#: The base kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Runs that are too short are dropped; for these two kinds the repeat count does it.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_NAMES = ("passw", "secret", "token", "api")
MIN_VALUE = 6

MIN_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % MIN_RUN)
FDR, NOT_RANDOM, BINS = 0.01, 0.001, 8
#: Below this p-value of uniform codes, a run in an alphabet of one case is ordinary.
NOT_UNIFORM = 0.01
#: p-values are rounded up to classes of this width in log10.
P_CLASS = 0.05

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {
    "hex": _DIGIT + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGIT + _UPPER,
    "hex_lower": _DIGIT + "abcdef",
    "base32_lower": _LOWER + "234567",
    "base36_lower": _DIGIT + _LOWER,
    "base62": _UPPER + _LOWER + _DIGIT,
    "base64": _UPPER + _LOWER + _DIGIT + "+/",
    "base64url": _UPPER + _LOWER + _DIGIT + "-_",
}
#: Alphabets whose bins are filled by frequency.
BY_FREQUENCY = ("base32", "base36", "hex_lower", "base32_lower", "base36_lower")
_CODES = {name: {ch: i for i, ch in enumerate(chars)} for name, chars in ENCODINGS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds, sorted."""
    low = text.lower()
    spans = []
    if any(name in low for name in ASSIGN_NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def infer_encoding(run: str) -> str | None:
    """The smallest alphabet that holds the run; None for ordinary-looking runs."""
    upper = any("A" <= c <= "Z" for c in run[1:])
    lower = any("a" <= c <= "z" for c in run)
    digit = any("0" <= c <= "9" for c in run)
    letter = lower or upper or run[0].isalpha()
    if not letter or not (digit or (upper and lower)):
        return None
    chars = set(run)
    one_case = ("hex", "base32", "base36") if not lower else ("hex_lower", "base32_lower", "base36_lower")
    for name in (*one_case, "base62", "base64", "base64url"):
        if chars <= _CODES[name].keys():
            return name
    return None


def _normal_below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def runs_p(high: np.ndarray) -> float:
    """Two-sided p-value of the runs test on a 0/1 sequence."""
    n, n1 = len(high), int(high.sum())
    n0 = n - n1
    if n1 == 0 or n0 == 0:
        return 0.0
    mean = 2.0 * n1 * n0 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    if var <= 0:
        return 1.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    return 2 * _normal_below(-abs(runs - mean) / math.sqrt(var))


def serial_p(codes: np.ndarray) -> float:
    """Two-sided p-value of lag-one serial correlation."""
    x = codes - codes.mean()
    total = float((x * x).sum())
    if total == 0:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / total
    n = len(codes)
    return 2 * _normal_below(-abs(r + 1.0 / n) * math.sqrt(n))


def non_central_below(x: float, k: int, centre: float) -> float:
    """Sankaran's approximation of the non-central chi-squared law's lower tail."""
    mean, spread = k + centre, k + 2 * centre
    h = 1 - 2 * mean * (k + 3 * centre) / (3 * spread * spread)
    p, m = spread / (mean * mean), (h - 1) * (1 - 3 * h)
    middle = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    return _normal_below(((x / mean) ** h - middle) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p)))


def bin_shares(counts: np.ndarray, encoding: str) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each code, and the bins' shares in ordinary text, from byte counts."""
    chars = ENCODINGS[encoding]
    own = np.array([counts[ord(c)] for c in chars], dtype=float) + 0.5
    bins = np.arange(len(chars)) * BINS // len(chars)
    if encoding in BY_FREQUENCY:
        bins[np.argsort(-own, kind="stable")] = bins.copy()
    return bins, np.bincount(bins, own, minlength=BINS) / own.sum()


def candidate_p(run: str, encoding: str, shares: tuple[np.ndarray, np.ndarray]) -> float:
    """The chance that ordinary text of this length looks as uniform, or 1."""
    codes = np.array([_CODES[encoding][c] for c in run])
    (bins, text), size, n = shares, len(ENCODINGS[encoding]), len(run)
    if runs_p((codes >= size // 2).astype(np.int8)) < NOT_RANDOM or serial_p(codes) < NOT_RANDOM:
        return 1.0
    wide = np.bincount(bins, minlength=BINS) / size
    seen = np.bincount(bins[codes], minlength=BINS)
    stat = float((((seen - n * wide) ** 2) / (n * wide)).sum())
    centre = n * float((((text - wide) ** 2) / wide).sum())
    k = BINS - 1
    if encoding in BY_FREQUENCY:
        if 1.0 - non_central_below(stat, k, 0.0) < NOT_UNIFORM:
            return 1.0
        p = non_central_below(stat, k, centre)
    else:
        p = _normal_below((stat - k - centre) / math.sqrt(2.0 * (k + 2.0 * centre)))
    return min(1.0, max(p, 1e-300))


def candidates(text: str, base: list[tuple[int, int, int]], shares: dict) -> list[tuple[int, int, float]]:
    """``(start, end, p)`` of the runs that touch no base span."""
    found = []
    for m in RUN.finditer(text):
        encoding = infer_encoding(m[0])
        if encoding and not any(s < m.end() and m.start() < e for s, _, e in base):
            found.append((m.start(), m.end(), candidate_p(m[0], encoding, shares[encoding])))
    return found


@dataclass
class SecretModel:
    """Bins and their shares of ordinary text per encoding, and the largest p-value of a secret."""

    shares: dict
    threshold: float


def p_class(p: float) -> int:
    """Class of a p-value: its log10, rounded up to a multiple of ``P_CLASS``."""
    return math.ceil(math.log10(p) / P_CLASS)


def fdr_threshold(class_counts: dict[int, int], fdr: float = FDR) -> float:
    """Benjamini-Hochberg on classes: the largest class edge e with
    ``e <= fdr * (candidates up to e) / (all candidates)``; 0 if there is none."""
    total, up_to, best = sum(class_counts.values()), 0, 0.0
    for k in sorted(class_counts):
        up_to += class_counts[k]
        edge = 10.0 ** (k * P_CLASS)
        if edge <= fdr * up_to / total:
            best = edge
    return best


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, dtype=np.int64)
    for batch in batches:
        for part in slices(batch.column(0)):
            total += np.bincount(np.frombuffer("".join(part.to_pylist()).encode(), dtype=np.uint8), minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["byte", "n"])


def fit(df: DataFrame, text_col: str = "text", fdr: float = FDR) -> SecretModel:
    """Character frequencies and the false-discovery threshold of all texts."""
    texts = df.select(as_text(F.col(text_col)).alias("text"))
    counts = np.zeros(256)
    for r in texts.mapInArrow(_byte_counts, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        counts[r["byte"]] = r["n"]
    shares = {name: bin_shares(counts, name) for name in ENCODINGS}

    def p_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch.column(0)):
                for text in part.to_pylist():
                    if RUN.search(text):
                        for _, _, p in candidates(text, base_spans(text), shares):
                            k = p_class(p)
                            found[k] = found.get(k, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                                         names=["k", "n"])

    classes = texts.mapInArrow(p_classes, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return SecretModel(shares, fdr_threshold({r["k"]: r["n"] for r in classes}, fdr))


SPAN = T.StructType().add("start", T.IntegerType()).add("rank", T.IntegerType()).add("end", T.IntegerType())


def scan(df: DataFrame, model: SecretModel, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``df`` with ``out_col``: ``array<struct<start,rank,end>>`` of all spans,
    by start, then kind; ``rank`` is the kind's place in ``KINDS``."""
    shares, threshold = model.shares, model.threshold

    @F.arrow_udf(T.ArrayType(SPAN))
    def spans_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = []
            for part in slices(batch):
                for text in part.to_pylist():
                    spans = base_spans(text)
                    spans += [(s, 3, e) for s, e, p in candidates(text, spans, shares)
                              if 10.0 ** (p_class(p) * P_CLASS) <= threshold]
                    out.append([{"start": s, "rank": k, "end": e} for s, k, e in sorted(spans)])
            yield pa.array(out, type=kind)

    return df.withColumn(out_col, spans_of(as_text(F.col(text_col))))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def redact(df: DataFrame, spans_col: str, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with the union of the spans in ``text_col`` replaced by ``mask``;
    texts without spans, null ones included, stay as they are."""

    @F.arrow_udf(T.StringType())
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            at, parts = 0, []
            for s in found or ():
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    parts += [text[at:s["start"]], mask]
                at = s["end"]
            out.append("".join(parts) + text[at:] if parts else text)
        return pa.array(out, type=pa.string())

    return df.withColumn(text_col, F.when(F.size(spans_col) > 0, masked(F.col(text_col), F.col(spans_col)))
                         .otherwise(F.col(text_col)))
