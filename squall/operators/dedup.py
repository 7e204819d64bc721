"""A6 full-row dedup, A7 keyed dedup keeping the first row by an order, A8 latest-by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, NumericType, TimestampNTZType, TimestampType)

_ROW = "__first_row"
_BESIDE = "__beside"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed; nulls compare equal."""
    return df.dropDuplicates()


def _order_key(df: DataFrame, c: str | Column, descending: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if not descending:
        return col
    dtype = df.select(col).schema.fields[0].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return -F.unix_micros(col.cast("timestamp"))
    if isinstance(dtype, DateType):
        return -F.unix_date(col)
    if isinstance(dtype, NumericType):
        return -col
    raise TypeError(f"descending order needs a numeric or time column, got {dtype.simpleString()}")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] = (),
                  descending: Sequence[bool] | None = None, beside: DataFrame | None = None,
                  ranged: Sequence[str] = ()) -> DataFrame:
    """One row per ``key`` — the first by ``order``.

    Ties after ``order`` are broken by the remaining columns, so the pick is
    deterministic. Null keys group together (nulls equal). Runs as a grouped
    ``min`` over one struct (order keys, then the row) with partial
    aggregation: a key holding a large share of the rows is reduced on the
    map side instead of landing in one task.

    ``beside`` (one row per key) keeps the keys that it holds, nulls equal, and
    adds its other columns; ``ranged``, some of the key columns, clusters the
    result by their ranges. The rows go through one exchange for all of this.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest and beside is None:
        return df.dropDuplicates(key)
    desc = list(descending) if descending is not None else [False] * len(order)
    ordering = [_order_key(df, c, d).alias(f"__o{i}") for i, (c, d) in enumerate(zip(order, desc))]
    # one struct, compared field by field: the order keys, then the row itself
    # (tie-break and payload at once, so the row is carried only once)
    row = F.struct(*ordering, *[F.col(c) for c in rest])
    if beside is None:
        out = (df.repartitionByRange(*ranged) if ranged else df).groupBy(*key).agg(F.min(row).alias(_ROW))
        return out.select(*[F.col(c) for c in key], *[F.col(_ROW).getField(c).alias(c) for c in rest]).select(*df.columns)
    more = [c for c in beside.columns if c not in key]
    both = df.select(*key, (row if rest else F.struct(F.lit(0))).alias(_ROW)).unionByName(
        beside.select(*key, F.struct(*more).alias(_BESIDE)), allowMissingColumns=True)
    out = ((both.repartitionByRange(*ranged) if ranged else both).groupBy(*key)
           .agg(F.min(_ROW).alias(_ROW), F.max(_BESIDE).alias(_BESIDE))
           .where(F.col(_ROW).isNotNull() & F.col(_BESIDE).isNotNull()))
    return out.select(*[F.col(c) if c in key else F.col(_ROW).getField(c).alias(c) for c in df.columns],
                      *[F.col(_BESIDE).getField(c).alias(c) for c in more])


def latest_by(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` equals its maximum (e.g. newest snapshot).

    The maximum is a one-row aggregate joined back by broadcast.
    """
    top = df.agg(F.max(column).alias("__latest"))
    return df.join(F.broadcast(top), F.col(column) == F.col("__latest"), "inner").drop("__latest")
