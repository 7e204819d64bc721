"""P5–P10: zips, renames, contract projection, split-and-explode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from squall import constants as K
from squall.functions.text import strip


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; others are ignored."""
    present = {a: b for a, b in mapping.items() if a in df.columns}
    return df.withColumnsRenamed(present) if present else df


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """P8 + P9: exactly the contract columns, in order, cast to the contract
    types; a missing column is added as null."""
    cols = []
    for f in contract.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def zip_arrays(df: DataFrame, arrays: Mapping[str, str], keep: Sequence[str] = (),
               check_lengths: bool = True) -> DataFrame:
    """P5: parallel arrays -> one row per index.

    ``arrays`` maps output column -> array column. Unequal lengths fail the
    job (``arrays_zip`` alone would pad with nulls); the check sits inside the
    exploded expression so the optimizer cannot prune it. A null array counts
    as empty.
    """
    names = list(arrays)
    srcs = {n: F.coalesce(F.col(a), F.array()) for n, a in arrays.items()}
    if check_lengths and len(names) > 1:
        first = srcs[names[0]]
        same = reduce(lambda a, b: a & b, [F.size(srcs[n]) == F.size(first) for n in names[1:]])
        srcs[names[0]] = F.when(same, first).otherwise(
            F.raise_error(F.lit("parallel arrays have unequal lengths")))
    zipped = F.arrays_zip(*[srcs[n].alias(n) for n in names])
    out = df.select(*keep, F.explode(zipped).alias("__z"))
    return out.select(*keep, *[F.col("__z").getField(n).alias(n) for n in names])


def split_routes(df: DataFrame, column: str = "routeId", separator: str = K.ROUTE_LIST_SEPARATOR,
                 fill: str = K.UNKNOWN_ROUTE) -> DataFrame:
    """P10 + E10 + E13 + E12 + F2 for a route list column.

    null -> ``fill``; text; split on the literal ``separator`` (so ``A|B``
    stays whole); one row per part; strip whitespace; drop empty parts.
    """
    # literal separator for Spark's regex split (Java \Q...\E quoting)
    pattern = "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.split(F.coalesce(F.col(column).cast("string"), F.lit(fill)), pattern)
    kept = F.filter(F.transform(parts, strip), lambda part: part != F.lit(""))
    return df.withColumn(column, F.explode(kept))
