"""Dictionary fit (A6), scaler fit (A7) and feature transformers.

Fitting is one distributed aggregate per estimator; only the small result
(means/stds, sorted category lists) reaches the driver, and its size is
checked before it is collected.  Transforms are plain Catalyst expressions
(constant maps folded into codegen), so scoring never leaves the JVM.

Estimators are ``pyspark.ml`` stages with ``DefaultParamsWritable`` so a
fitted ``PipelineModel`` saves and loads as one artifact.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, DoubleType, FloatType, NumericType

from ..session import materialize, scratch_path
from .profile import long_values
from .ranking import exact_rank

# A dictionary larger than this stays a table and is applied by a join.
MAX_COLLECTED_CATEGORIES = 1_000
# A stored dictionary of up to this many bytes is broadcast when applied.
MAX_BROADCAST_BYTES = 32 << 20


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# --- A6 -------------------------------------------------------------------
def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_distinct)`` of non-null values, one shuffle for all."""
    lv = long_values(df, cols).filter(F.col("value").isNotNull()).distinct()
    return lv.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def _native(v: str, num: float | None, dtype) -> Any:
    if isinstance(dtype, BooleanType):
        return v == "true"
    if isinstance(dtype, (DoubleType, FloatType)):
        return float(num)
    if isinstance(dtype, DecimalType):
        return Decimal(v)
    if isinstance(dtype, NumericType):
        return int(v)
    return v


def _exact_order(v: Column) -> Column:
    """Text of an exact number (plain digits) that sorts as the number does: digits padded on both sides, behind a
    sign; those of negative numbers are complemented."""
    size = F.regexp_replace(v, "^-", "")
    whole, rest = F.substring_index(size, ".", 1), F.when(F.contains(size, F.lit(".")), F.substring_index(size, ".", -1)).otherwise("")
    digits = F.concat(F.lpad(whole, 39, "0"), F.rpad(rest, 38, "0"))
    return F.when(F.startswith(v, F.lit("-")), F.concat(F.lit("0"), F.translate(digits, "0123456789", "9876543210"))).otherwise(
        F.concat(F.lit("1"), digits))


def native_order(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Order of the rows of ``long_values`` within a column: doubles by value, exact numbers exactly, others by text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exact = [c for c in cols if isinstance(types[c], NumericType) and not isinstance(types[c], (DoubleType, FloatType))]
    is_exact = F.col("column_name").isin(exact) if exact else F.lit(False)
    return [F.when(~is_exact, F.col("num")), F.when(is_exact, _exact_order(F.col("value"))), F.col("value")]


def fit_dictionaries(df: DataFrame, cols: Sequence[str],
                     max_size: int = 100_000) -> dict[str, list[Any]]:
    """Sorted distinct non-null values per column, in the column's *native*
    order (numbers numerically -- not as text).  Raises if a column has more
    than ``max_size`` values; use :func:`dictionary_frame` for those."""
    small, large = _split_dictionaries(df, cols, max_size)
    if large:
        raise ValueError(f"dictionaries too large to collect {large}; use dictionary_frame()")
    return small


def _split_dictionaries(df: DataFrame, cols: Sequence[str], max_size: int):
    """One pass: collect the dictionaries of at most ``max_size`` values;
    report the sizes of the larger ones (which are never collected)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    lv = materialize(long_values(df, cols).filter(F.col("value").isNotNull()).distinct(), "dictionary")
    sizes = {r[0]: r[1] for r in lv.groupBy("column_name").count().collect()}
    large = {c: n for c, n in sizes.items() if n > max_size}
    small: dict[str, list[Any]] = {c: [] for c in cols if c not in large}
    for r in lv.filter(~F.col("column_name").isin(list(large))).collect():
        small[r.column_name].append(_native(r.value, r.num, types[r.column_name]))
    for c in small:
        small[c].sort()
    return small, large


def dictionary_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A6 as a DataFrame: ``(column_name, value, code)`` with ``code`` the
    0-based position in native sort order.  Exact for any cardinality: the
    ranking is range-partitioned, never one task per column.  Beyond 2^31 values of
    one column the ``int`` cast fails (ANSI) instead of wrapping."""
    lv = long_values(df, cols).filter(F.col("value").isNotNull()).distinct()
    r = exact_rank(lv, native_order(df, cols), ["column_name"], rn="_rn")
    return r.select("column_name", "value", (F.col("_rn") - 1).cast("int").alias("code"))


# --- A7 -------------------------------------------------------------------
def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, mean, std)`` with the *population* std, one pass."""
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- shared plumbing for the stages ------------------------------------------
class _JsonState(Params):
    state = Param(Params._dummy(), "state", "fitted state as JSON", typeConverter=TypeConverters.toString)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class _ColsStage(HasInputCols, HasOutputCols):
    def _outs(self) -> list[str]:
        if self.isDefined(self.outputCols) and self.getOutputCols():
            return self.getOutputCols()
        return list(self.getInputCols())


def _decode_keys(values: list, kind: str) -> list:
    return [float(v) if kind in ("double", "float") else v for v in values]


def _value_kind(df: DataFrame, c: str) -> str:
    return df.schema[c].dataType.simpleString()


def _code_of(c: str, values: list, kind: str) -> Column:
    """Position of a column's value in a collected dictionary, or null."""
    if kind in ("double", "float") or kind.startswith("decimal"):  # by value: their texts differ by engine
        return F.try_element_at(F.create_map(*[x for i, v in enumerate(values)
                                               for x in (F.lit(v).cast(kind), F.lit(i))]), _q(c))
    texts = [str(v).lower() if kind == "boolean" else str(v) for v in values]
    # One literal, whatever the number of values; the optimizer folds it once.
    positions = F.from_json(F.lit(json.dumps({t: i for i, t in enumerate(texts)})), "map<string,int>")
    return F.try_element_at(positions, _q(c).cast("string"))


# --- F1 -------------------------------------------------------------------
class PopulationStandardScaler(Estimator, _ColsStage, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std; a zero std scales by 1 (x - mean)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationStandardScalerModel":
        stats = {r.column_name: (r.mean, r.std) for r in scaler_stats(df, self.getInputCols()).collect()}
        return PopulationStandardScalerModel(inputCols=self.getInputCols(), outputCols=self._outs(),
                                             state=json.dumps(stats))


class PopulationStandardScalerModel(Model, _ColsStage, _JsonState, DefaultParamsReadable,
                                    DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def expressions(self) -> dict[str, Column]:
        st = self._state()
        out = {}
        for c, o in zip(self.getInputCols(), self._outs()):
            mean, std = st[c]
            scale = std if std not in (None, 0.0) else 1.0
            out[o] = (_q(c).cast("double") - F.lit(mean)) / F.lit(scale)
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())


# --- F2 / F3 / F4 ------------------------------------------------------------
class _DictionaryEstimator(Estimator, _ColsStage):
    maxCategories = Param(Params._dummy(), "maxCategories", "largest dictionary to collect",
                          typeConverter=TypeConverters.toInt)

    def _fit_state(self, df: DataFrame) -> dict:
        limit = self.getOrDefault(self.maxCategories) if self.isDefined(self.maxCategories) \
            else MAX_COLLECTED_CATEGORIES
        return category_state(df, self.getInputCols(), limit)


def category_state(df: DataFrame, cols: Sequence[str], limit: int = MAX_COLLECTED_CATEGORIES) -> dict:
    """Fitted state of the dictionary stages for ``cols`` (one pass for all).

    A column whose dictionary exceeds ``limit`` is ranked distributedly and
    stored as a table under the shared storage root (``{"path": ..., "size":
    n, "bytes": b}``) instead of being collected; either form gives the same codes.
    """
    small, large = _split_dictionaries(df, cols, limit)
    state = {c: {"kind": _value_kind(df, c), "values": _storable(small[c]), "size": len(small[c])} for c in small}
    for c, n in large.items():
        path = scratch_path(df.sparkSession, f"dictionary-{c}")
        dictionary_frame(df, [c]).select("value", "code").write.parquet(path)
        size = df.sparkSession.read.parquet(path).agg(F.sum(F.octet_length("value") + 16)).head()[0]
        state[c] = {"kind": _value_kind(df, c), "path": path, "size": int(n), "bytes": int(size)}
    return state


def _storable(values: list) -> list:
    """Values as JSON holds them; decimals as text, from which they are cast back exactly."""
    return [str(v) if isinstance(v, Decimal) else v for v in values]


class OneHotColumns(_DictionaryEstimator, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 int column per category (sorted, none dropped): ``<col>_oh<i>``.
    Unknown and null give all zeros.  A table can hold so many columns only; for
    dictionaries of any size use :func:`one_hot_slots` or the sparse vectors of
    the feature assembler."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OneHotColumnsModel":
        values = fit_dictionaries(df, self.getInputCols())
        state = {c: {"kind": _value_kind(df, c), "values": _storable(v), "size": len(v)} for c, v in values.items()}
        return OneHotColumnsModel(inputCols=self.getInputCols(), state=json.dumps(state))


def one_hot_slots(df: DataFrame, key: Sequence[str], codes: "CategoryCodesModel") -> DataFrame:
    """One-hot in sparse form: ``(key..., column_name, slot)`` per known value, for any
    number of categories; unknown and null values have no row."""
    coded = codes.transform(df)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(o).alias("slot"))
                      for c, o in zip(codes.getInputCols(), codes._outs())])
    return (coded.select(*key, F.explode(pairs).alias("_p")).select(*key, "_p.column_name", "_p.slot")
            .filter(F.col("slot") >= 0))


class UnknownLast(Transformer, _ColsStage, _JsonState, DefaultParamsReadable, DefaultParamsWritable):
    """Codes for :class:`pyspark.ml.feature.OneHotEncoder`: -1 becomes the dictionary's size,
    which the encoder's dropped last category then encodes as all zeros."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        size = self._state()
        out = {}
        for c, o in zip(self.getInputCols(), self._outs()):
            meta = {"ml_attr": {"type": "nominal", "num_vals": size[c] + 1, "name": o}}
            out[o] = F.when(_q(c) < 0, size[c]).otherwise(_q(c)).cast("double").alias(o, metadata=meta)
        return df.select("*", *out.values())


class OneHotColumnsModel(Model, _ColsStage, _JsonState, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def output_names(self) -> list[str]:
        st = self._state()
        return [f"{c}_oh{i}" for c in self.getInputCols() for i in range(len(st[c]["values"]))]

    def expressions(self) -> dict[str, Column]:
        st = self._state()
        out = {}
        for c in self.getInputCols():
            for i, v in enumerate(_decode_keys(st[c]["values"], st[c]["kind"])):
                out[f"{c}_oh{i}"] = F.coalesce((_q(c) == F.lit(v).cast(st[c]["kind"])).cast("int"),
                                               F.lit(0))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())


class BinaryOrdinal(_DictionaryEstimator, DefaultParamsReadable, DefaultParamsWritable):
    """Two-valued features -> 0/1 in sorted order; an unseen value raises."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CategoryCodesModel":
        return CategoryCodesModel(inputCols=self.getInputCols(), outputCols=self._outs(),
                                  state=json.dumps(self._fit_state(df)), onUnknown="error")


class CategoryCodes(_DictionaryEstimator, DefaultParamsReadable, DefaultParamsWritable):
    """Code = position in the sorted training categories; unseen or null -> -1."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, maxCategories=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CategoryCodesModel":
        return CategoryCodesModel(inputCols=self.getInputCols(), outputCols=self._outs(),
                                  state=json.dumps(self._fit_state(df)), onUnknown="minus_one")


class CategoryCodesModel(Model, _ColsStage, _JsonState, DefaultParamsReadable, DefaultParamsWritable):
    onUnknown = Param(Params._dummy(), "onUnknown", "minus_one | error",
                      typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, state=None, onUnknown="minus_one"):
        super().__init__()
        self._set(**self._input_kwargs)

    def expressions(self) -> dict[str, Column]:
        """Constant-map lookups for the collected dictionaries."""
        st = self._state()
        out = {}
        for c, o in zip(self.getInputCols(), self._outs()):
            if "path" in st[c]:
                continue
            vals = _decode_keys(st[c]["values"], st[c]["kind"])
            out[o] = self._or_unknown(c, _code_of(c, vals, st[c]["kind"]))
        return out

    def _or_unknown(self, c: str, hit: Column) -> Column:
        if self.getOrDefault(self.onUnknown) != "error":
            return F.coalesce(hit, F.lit(-1))
        miss = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "),
                                      F.coalesce(_q(c).cast("string"), F.lit("null"))))
        return F.when(hit.isNotNull(), hit).otherwise(miss.cast("int"))

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns(self.expressions())
        st = self._state()
        for c, o in zip(self.getInputCols(), self._outs()):
            if "path" not in st[c]:
                continue
            # Large dictionary: equi-join on the value text.  Broadcast only
            # when its counted bytes are few; otherwise a shuffle join (AQE
            # splits a skewed category's partition).
            d = df.sparkSession.read.parquet(st[c]["path"]).select(
                F.col("value").alias(f"_dv_{o}"), F.col("code").alias(f"_dc_{o}"))
            if st[c]["bytes"] <= MAX_BROADCAST_BYTES:
                d = F.broadcast(d)
            out = (out.join(d, _q(c).cast("string") == F.col(f"_dv_{o}"), "left")
                      .withColumn(o, self._or_unknown(c, F.col(f"_dc_{o}")))
                      .drop(f"_dv_{o}", f"_dc_{o}"))
        return out
