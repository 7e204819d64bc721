"""J3 — rows of ``new`` whose key is absent from ``existing``; nulls compare equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, NumericType, StringType,
                               TimestampNTZType, TimestampType)


def _filler(dtype: DataType) -> Column:
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    raise TypeError(f"unsupported key type {dtype.simpleString()}")


def null_safe_key(df: DataFrame, key: Sequence[str], prefix: str = "__k") -> tuple[DataFrame, list[str]]:
    """Encode each key column as (value with null filled, is-null flag).

    Equality on the pair is null-safe equality on the column, and both sides
    of a join can be hash-partitioned on these same plain columns.
    """
    names = []
    cols = {}
    for i, k in enumerate(key):
        dtype = df.schema[k].dataType
        cols[f"{prefix}{i}v"] = F.coalesce(F.col(k), _filler(dtype))
        cols[f"{prefix}{i}n"] = F.col(k).isNull()
        names += [f"{prefix}{i}v", f"{prefix}{i}n"]
    return df.withColumns(cols), names


def anti_join_null_safe(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """``new`` rows with no ``existing`` row of the same key (null = null).

    ``existing`` is reduced to its distinct keys first (partial aggregation
    collapses repeated keys map-side); the join then reuses that partitioning.
    Duplicates inside ``new`` are all kept.
    """
    key = list(key)
    ex, names = null_safe_key(existing.select(*key), key)
    ex = ex.select(*names).distinct()
    nw, _ = null_safe_key(new, key)
    return nw.join(ex, names, "left_anti").drop(*names)
