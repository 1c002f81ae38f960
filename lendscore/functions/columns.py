"""Column expressions for cleaning and encoding.

All of these build Catalyst expressions (no Python UDFs), so whole-stage
codegen keeps them in one generated function per stage.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]")


# --- C1 -------------------------------------------------------------------
def normalized_name(name: str) -> str:
    """Every character outside ``[a-zA-Z0-9]`` becomes ``_``, one for one."""
    return _NON_ALNUM.sub("_", name)


def normalize_column_names(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Rename all columns with :func:`normalized_name` (a metadata-only Project).

    Two headers that normalise to the same name raise (``on_collision=
    "error"``) or get a numeric suffix (``"suffix"``).
    """
    new = [normalized_name(c) for c in df.columns]
    seen: dict[str, list[str]] = {}
    for old, n in zip(df.columns, new):
        seen.setdefault(n, []).append(old)
    clashes = {n: olds for n, olds in seen.items() if len(olds) > 1}
    if clashes:
        if on_collision == "error":
            raise ValueError(f"column names collide after normalisation: {clashes}")
        counts: dict[str, int] = {}
        out = []
        for n in new:
            k = counts.get(n, 0)
            counts[n] = k + 1
            out.append(n if k == 0 else f"{n}_{k}")
        new = out
    return df.toDF(*new)


# --- C3 / C4 / C5 ---------------------------------------------------------
def nullify(col: Column, tokens: Iterable[Any]) -> Column:
    """Exact (case-sensitive) sentinel values become null; null stays null."""
    tokens = list(tokens)
    if not tokens:
        return col
    if len(tokens) == 1:
        return F.nullif(col, F.lit(tokens[0]))
    return F.when(col.isin(tokens), F.lit(None)).otherwise(col)


def collapse(col: Column, merge: Mapping[Any, Any]) -> Column:
    """Merge categories: listed values map to their target, others pass."""
    if not merge:
        return col
    by_target: dict[Any, list[Any]] = {}
    for src, dst in merge.items():
        by_target.setdefault(dst, []).append(src)
    expr = None
    for dst, srcs in by_target.items():
        cond = col == srcs[0] if len(srcs) == 1 else col.isin(srcs)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    return expr.otherwise(col)


def fill(col: Column, value: Any) -> Column:
    return col if value is None else F.coalesce(col, F.lit(value))


# --- C6 / C7 / C8 / C9 ----------------------------------------------------
def map_literal(mapping: Mapping[Any, Any]) -> Column:
    """A constant map; Catalyst folds it once per query."""
    if not mapping:
        raise ValueError("mapping must not be empty")
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def map_values(col: Column, mapping: Mapping[Any, Any]) -> Column:
    """``df.replace`` for one column: mapped values replaced, others kept."""
    return F.coalesce(F.try_element_at(map_literal(mapping), col), col)


def encode(col: Column, mapping: Mapping[Any, Any], dtype: str = "int",
           on_unknown: str = "error", name: str = "column") -> Column:
    """Map categories to codes and cast.  Null in -> null out.

    ``on_unknown``: ``"error"`` raises naming the column and value,
    ``"null"`` gives null, ``"cast"`` casts the unmapped value itself
    (strict under ANSI, like a plain replace-then-cast).
    """
    hit = F.try_element_at(map_literal({k: v for k, v in mapping.items()}), col).cast(dtype)
    if on_unknown == "null":
        miss = F.lit(None).cast(dtype)
    elif on_unknown == "cast":
        miss = col.cast(dtype)
    elif on_unknown == "error":
        miss = F.raise_error(F.concat(F.lit(f"unmapped value in {name}: "),
                                      col.cast("string"))).cast(dtype)
    else:
        raise ValueError(f"on_unknown must be error|null|cast, got {on_unknown!r}")
    return F.when(col.isNull(), F.lit(None).cast(dtype)).when(hit.isNotNull(), hit).otherwise(miss)


# --- C12 / C13 ------------------------------------------------------------
def nan_to_null(col: Column) -> Column:
    """NaN becomes null; the column keeps its own type."""
    return F.when(~F.isnan(col), col)


def decode_label(col: Column, positive: str = "bad", negative: str = "good",
                 positive_code: int = 1) -> Column:
    """Class code -> text; ``int(p) == 1`` is positive, everything else negative."""
    return F.when(col.cast("int") == positive_code, F.lit(positive)).otherwise(F.lit(negative))


# --- hashing helpers ------------------------------------------------------
def keyed_md5(key: Column, seed: int) -> Column:
    """``md5("<key>:<seed>")`` as 32 hex chars (same text in DuckDB)."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hex_prefix_int(hex_col: Column, digits: int) -> Column:
    """Integer value of the first ``digits`` hex characters (<= 15)."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


def hash_unit(key: Column, seed: int = 0) -> Column:
    """A deterministic pseudo-uniform score in [0, 1) from a key."""
    return hex_prefix_int(keyed_md5(key, seed), 13) / F.lit(float(16 ** 13))
