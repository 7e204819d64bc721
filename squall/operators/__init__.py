"""DataFrame -> DataFrame operators."""

from squall.operators.aggregates import daily_summary, impact_aggregate
from squall.operators.anti_join import anti_join_null_safe
from squall.operators.asof import asof_nearest
from squall.operators.dedup import distinct_rows, first_per_key, latest_by
from squall.operators.reshape import conform, rename, split_routes, zip_arrays
from squall.operators.union import stack

__all__ = [
    "anti_join_null_safe", "asof_nearest", "conform", "daily_summary", "distinct_rows",
    "first_per_key", "impact_aggregate", "latest_by", "rename", "split_routes", "stack",
    "zip_arrays",
]
