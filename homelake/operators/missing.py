"""Missing values: text tokens and non-finite numbers become null, at any nesting depth: in structs,
arrays and the values of maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a CSV reader takes as missing.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def null_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in columns})


def _finite(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        infinite = F.lit(float("inf")).cast(kind)
        return F.when(~F.isnan(c) & (F.abs(c) != infinite), c)
    if isinstance(kind, T.StructType):
        cleaned = F.struct(*[_finite(c[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), cleaned)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda item: _finite(item, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, item: _finite(item, kind.valueType))
    return c


def finite_only(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in all columns; other values stay."""
    return df.select(*[_finite(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
