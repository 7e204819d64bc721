"""A1–A5: the daily summary and the categorised impact aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions.text import categorise, weather_keyword_predicate
from squall.functions.timefn import utc_date


def daily_summary(fact: DataFrame, time_col: str = "weather_start", route_col: str = "routeId",
                  entity_col: str = "entity_id", temp_col: str = "temperature",
                  forecast_col: str = "shortForecast", mean_scale: int = 10) -> DataFrame:
    """A1: per (UTC date, route): distinct entities (A2), mean temperature (A3),
    most frequent forecast, ties to the smallest value (A4).

    Rows with a null route are not summarised. Output columns:
    alert_date, routeId, entity_id (a count), temperature, shortForecast.

    The mean is an exact decimal sum (``mean_scale`` decimals of a reading
    count; readings are below 1e18) divided once as doubles: unrounded, and
    the same however the rows are partitioned, unlike a floating-point sum.
    """
    temp = F.col(temp_col)
    # NaN / infinite readings are skipped like nulls (a missing value, as the
    # array-library mean treats NaN)
    reading = temp.try_cast(f"decimal({18 + mean_scale},{mean_scale})")
    mean = F.sum(reading).cast("double") / F.nullif(F.count(reading), F.lit(0))
    return (fact.where(F.col(route_col).isNotNull())
            .groupBy(utc_date(time_col).alias("alert_date"), F.col(route_col).alias("routeId"))
            .agg(F.count_distinct(entity_col).alias("entity_id"),
                 mean.alias("temperature"),
                 F.mode(forecast_col, deterministic=True).alias("shortForecast")))


def impact_aggregate(fact: DataFrame, predicate=None, rules=None, default: str | None = None,
                     route_col: str = "routeId", time_col: str = "weather_start",
                     entity_col: str = "entity_id", forecast_col: str = "shortForecast") -> DataFrame:
    """A5 (+F3, E14): weather-related rows grouped by route, hour and category.

    Null routes are kept as their own group. Output: routeId, weather_start,
    weather_category, total_alerts (distinct entities).
    """
    predicate = weather_keyword_predicate() if predicate is None else predicate
    return (fact.where(predicate)
            .groupBy(F.col(route_col).alias("routeId"), F.col(time_col).alias("weather_start"),
                     categorise(forecast_col, rules, default).alias("weather_category"))
            .agg(F.count_distinct(entity_col).alias("total_alerts")))
