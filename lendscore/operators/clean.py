"""Cleaning and encoding operators.

Each operator is one ``select``: the rules are folded into one expression
per output column, so the plan has a single Project over the scan however
many rules there are (the reference chains a ``withColumn`` per step).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ColumnRule, EncodeRule, FeatureRules
from ..functions import columns as C


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _replace_columns(df: DataFrame, exprs: Mapping[str, Column],
                     extra: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Project all columns, swapping in ``exprs`` and appending ``extra``."""
    cols = [exprs[c].alias(c) if c in exprs else _q(c) for c in df.columns]
    cols += [e.alias(n) for n, e in extra]
    return df.select(*cols)


def nullify_tokens(df: DataFrame, columns: Iterable[str], tokens: Iterable[Any]) -> DataFrame:
    """Listed sentinel values become null in the listed columns."""
    tokens = list(tokens)
    return _replace_columns(df, {c: C.nullify(_q(c), tokens) for c in columns})


def collapse_categories(df: DataFrame, merges: Mapping[str, Mapping[Any, Any]]) -> DataFrame:
    """C4: ``{column: {old: new}}``; unlisted values and nulls pass through."""
    return _replace_columns(df, {c: C.collapse(_q(c), m) for c, m in merges.items()})


def fill_missing(df: DataFrame, value: Any, subset: Iterable[str]) -> DataFrame:
    """``fillna`` restricted to ``subset``."""
    return _replace_columns(df, {c: C.fill(_q(c), value) for c in subset})


def map_values(df: DataFrame, mapping: Mapping[Any, Any], subset: Iterable[str]) -> DataFrame:
    """``replace`` restricted to ``subset``; unmapped values unchanged."""
    return _replace_columns(df, {c: C.map_values(_q(c), mapping) for c in subset})


def ordinal_encode(df: DataFrame, input_cols: Sequence[str], mappings: Sequence[Mapping[Any, Any]],
                   output_cols: Sequence[str], dtype: str = "int",
                   on_unknown: str = "error") -> DataFrame:
    """Copy each input column to its output, map and cast; inputs kept."""
    if not (len(input_cols) == len(mappings) == len(output_cols)):
        raise ValueError("input_cols, mappings and output_cols must have equal length")
    rules = [EncodeRule(i, o, dict(m), dtype, on_unknown)
             for i, m, o in zip(input_cols, mappings, output_cols)]
    return apply_rules(df, FeatureRules(encodings=tuple(rules)))


def label_encode(df: DataFrame, column: str, mapping: Mapping[Any, Any], dtype: str = "int",
                 on_unknown: str = "error") -> DataFrame:
    """Encode the target column in place."""
    return apply_rules(df, FeatureRules(encodings=(EncodeRule(column, column, dict(mapping),
                                                               dtype, on_unknown),)))


def column_expr(rule: ColumnRule, base: Column) -> Column:
    e = C.nullify(base, rule.null_tokens)
    e = C.collapse(e, rule.merge)
    return C.fill(e, rule.fill)


def apply_rules(df: DataFrame, rules: FeatureRules) -> DataFrame:
    """C11 (generic): cleaning rules then encodings, as one Project.

    Encodings read the *cleaned* value of their input column.  An encoding
    whose output equals its input replaces it (label encoding); otherwise the
    output is appended and the input kept.
    """
    cleaned: dict[str, Column] = {}
    for r in rules.columns:
        cleaned[r.column] = column_expr(r, cleaned.get(r.column, _q(r.column)))
    exprs = dict(cleaned)
    extra: list[tuple[str, Column]] = []
    for e in rules.encodings:
        src = cleaned.get(e.column, _q(e.column))
        enc = C.encode(src, e.mapping, e.dtype, e.on_unknown, name=e.column)
        if e.output in df.columns:
            exprs[e.output] = enc
        else:
            extra.append((e.output, enc))
    return _replace_columns(df, exprs, extra)


def feature_table(raw: DataFrame, rules: FeatureRules, normalize: bool = True) -> DataFrame:
    """C1 + C11: normalise headers, then clean and encode in one Project."""
    df = C.normalize_column_names(raw) if normalize else raw
    return apply_rules(df, rules)


def select_features(df: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                    target: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Keys, numeric list, categorical list, then target (that order)."""
    cols = [*keys, *numerical, *categorical] + ([target] if target else [])
    return df.select(*[_q(c) for c in cols])


def nan_to_null(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """NaN -> null in floating columns."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    subset = floats if subset is None else set(subset) & floats
    return _replace_columns(df, {c: C.nan_to_null(_q(c)) for c in subset})


def decode_prediction(df: DataFrame, column: str = "prediction",
                      output: str = "Credit risk prediction",
                      positive: str = "bad", negative: str = "good") -> DataFrame:
    """Class code -> label text."""
    return df.withColumn(output, C.decode_label(_q(column), positive, negative))


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """C14: first ``n`` rows; deterministic when ``order_by`` is given
    (planned as TakeOrderedAndProject: per-partition top-n, no full sort)."""
    if order_by:
        df = df.orderBy(*[_q(c) for c in order_by])
    return df.limit(n)
