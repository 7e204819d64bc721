"""Stack frames by column name with a source tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[tuple[DataFrame | None, str]], source_col: str = "source") -> DataFrame | None:
    """Union by name, missing columns as null, each frame tagged with its source.

    Any frame may be ``None`` (absent input); returns ``None`` when all are.
    Order of the list is the stacking order (history first by convention).
    """
    tagged = [df.withColumn(source_col, F.lit(src)) for df, src in frames if df is not None]
    if not tagged:
        return None
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
