"""Numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_dp(c, digits: int = 2) -> Column:
    """Scale, round half to even, unscale — the array-library rounding.

    0.125 -> 0.12 and 39.355 -> 39.35 (the product is 3935.4999...). ``bround``
    rounds the decimal text instead and would give 39.36.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def celsius_to_fahrenheit(c) -> Column:
    """X * 1.8 + 32, in that order of operations."""
    return _col(c).cast("double") * F.lit(1.8) + F.lit(32.0)


def to_number(c) -> Column:
    """Text or number -> double; invalid -> null."""
    return _col(c).cast("string").try_cast("double")


def code_to_label(c, table=None, default: str | None = None) -> Column:
    """Map a numeric code through ``[(codes, label), ...]``; else default.

    Defaults to the WMO weather-code table. Null and unknown codes get the
    default label.
    """
    table = K.WMO_CODE_FORECASTS if table is None else table
    default = K.WMO_CODE_DEFAULT if default is None else default
    code = _col(c).cast("double")
    expr = None
    for codes, label in table:
        cond = code.isin([float(x) for x in codes])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
