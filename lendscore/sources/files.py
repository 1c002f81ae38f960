"""I1 CSV ingest and I8 JSON records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import nullify

# The tokens pandas' default CSV reader turns into missing
# values (its documented default ``na_values``).
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             null_tokens: Iterable[str] = PANDAS_NULL_TOKENS,
             infer: bool = False, multi_line: bool = True) -> DataFrame:
    """Read a headered CSV the way the pipeline expects.

    Every string column is read as text first so that *all* null tokens can
    be nulled (the CSV reader's ``nullValue`` takes only one token), then
    cast to ``schema`` if given.  Values that are no token stay as they are, spaces
    included; quotes are doubled inside quotes (RFC 4180).  Quoted values
    may hold line ends, which makes each file one task: write many files, or pass
    ``multi_line=False`` for files without such values, whose blocks are then read
    in parallel.  Pass a schema in production (inference is an extra full pass,
    after the tokens are nulled).
    """
    tokens = list(null_tokens)
    raw = (spark.read.option("header", "true").option("mode", "FAILFAST").option("quote", '"').option("escape", '"')
           .option("multiLine", str(multi_line).lower()).csv(path))  # all strings
    df = raw.select(*[nullify(F.col(f"`{f.name}`"), tokens).alias(f.name) for f in raw.schema.fields])
    if schema is None and infer:
        schema = _inferred(df)
    if schema is not None:
        st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])
    return df


def _inferred(df: DataFrame) -> StructType:
    """Per column the first of bigint, double and boolean that takes all its values, or string."""
    kinds = ("bigint", "double", "boolean")
    aggs = [F.bool_and(F.col(f"`{c}`").try_cast(k).isNotNull() | F.col(f"`{c}`").isNull()).alias(f"{i}_{k}")
            for i, c in enumerate(df.columns) for k in kinds]
    fits = df.agg(*aggs).first()
    return StructType.fromDDL(", ".join(
        f"`{c}` " + next((k for k in kinds if fits[f"{i}_{k}"]), "string") for i, c in enumerate(df.columns)))


def to_json_records(df: DataFrame, columns: list[str] | None = None,
                    column_name: str = "record") -> DataFrame:
    """I8: one JSON object per row; NaN becomes null and nulls are kept."""
    columns = columns or df.columns
    fields = []
    for f in df.select(*columns).schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        fields.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(column_name))
