"""Bronze -> silver: the four feeds normalised to the ALERT and WEATHER contracts.

Each function takes the parsed bronze DataFrame (see ``squall.sources.bronze``)
and returns contract rows; none of them touches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall import constants as K
from squall import schemas
from squall.functions.numeric import celsius_to_fahrenheit, code_to_label, round_dp
from squall.functions.text import first_translation, route_from_header
from squall.functions.timefn import (epoch_seconds_timestamp, lenient_timestamp, plus_seconds,
                                     strict_timestamp)
from squall.operators.dedup import distinct_rows
from squall.operators.reshape import conform, rename, split_routes, zip_arrays


def live_alert_rows(feed: DataFrame) -> DataFrame:
    """Live alert feed (``entity`` array) -> ALERT rows, before dedup.

    One row per alert x informed entity x active period (P3, J1): an alert
    without informed entities yields nothing, one without periods yields rows
    with null start/end. Header/description take the first translation or ''
    (P1, P2). Epoch-second periods become timestamps, junk -> null (E3, E16).
    A null route takes the first ``[CODE]`` of the header, else SYSTEM_WIDE (E11).
    """
    e = feed.select(F.explode("entity").alias("e"))
    a = e.select(
        F.coalesce(F.col("e.id"), F.lit("")).alias("entity_id"),
        first_translation(F.col("e.alert.headerText.translation")).alias("header_text"),
        first_translation(F.col("e.alert.descriptionText.translation")).alias("description_text"),
        F.col("e.alert.informedEntity").alias("_ie"),
        F.col("e.alert.activePeriod").alias("_ap"))
    rows = (a.withColumn("_i", F.explode("_ie"))
            .withColumn("_p", F.explode_outer("_ap")))
    return rows.select(
        "entity_id",
        route_from_header(F.col("_i.routeId"), F.col("header_text")).alias("routeId"),
        epoch_seconds_timestamp(F.col("_p.start")).alias("start"),
        epoch_seconds_timestamp(F.col("_p.end")).alias("end"),
        "header_text", "description_text")


def live_alerts(feed: DataFrame) -> DataFrame:
    """Live alert feed -> silver ALERT rows (A6 full-row dedup)."""
    return distinct_rows(live_alert_rows(feed))


def historical_alert_rows(records: DataFrame, source_tz: str | None = None) -> DataFrame:
    """Historical alert records -> ALERT rows, before dedup.

    Rename to the contract (P6); lenient UTC parse of the date (E1); end = start
    + 1 h when absent (E4); route list: null -> 'Unknown', split on ' | ',
    strip, drop empty (E10, E13, P10, E12, F2); contract projection (P8).
    ``source_tz`` reads offset-less dates as wall clock in that zone (default UTC).
    """
    df = rename(records, K.HISTORICAL_ALERT_RENAMES)
    if "routeId" not in df.columns:
        df = df.withColumn("routeId", F.lit(None).cast("string"))
    df = df.withColumn("start", lenient_timestamp("start", source_tz))
    if "end" not in df.columns:
        df = df.withColumn("end", plus_seconds("start", K.DEFAULT_DURATION_SECONDS))
    df = split_routes(df, "routeId")
    return conform(df, schemas.ALERT)


def historical_alerts(records: DataFrame, source_tz: str | None = None) -> DataFrame:
    return distinct_rows(historical_alert_rows(records, source_tz))


def live_weather(doc: DataFrame) -> DataFrame:
    """Forecast document -> WEATHER rows: one per period (P4); times with
    offsets parsed to UTC (E1); temperature rounded to 2 dp (E7)."""
    p = doc.select(F.explode("properties.periods").alias("p"))
    return p.select(
        lenient_timestamp(F.col("p.startTime")).alias("startTime"),
        lenient_timestamp(F.col("p.endTime")).alias("endTime"),
        round_dp(F.col("p.temperature"), 2).alias("temperature"),
        F.col("p.shortForecast").alias("shortForecast"))


def historical_weather(doc: DataFrame) -> DataFrame:
    """Hourly archive (parallel arrays) -> WEATHER rows.

    Zip by index, unequal lengths fail (P5); strict time parse (E2); end =
    start + 1 h (E4); Celsius -> Fahrenheit rounded to 2 dp (E8, E7); WMO
    code -> forecast text (E9).
    """
    z = zip_arrays(doc, {"time": "hourly.time", "temperature_2m": "hourly.temperature_2m",
                         "precipitation": "hourly.precipitation", "weather_code": "hourly.weather_code"})
    start = strict_timestamp(F.col("time"), "hourly time")
    return z.select(
        start.alias("startTime"),
        plus_seconds(start, K.DEFAULT_DURATION_SECONDS).alias("endTime"),
        round_dp(celsius_to_fahrenheit(F.col("temperature_2m")), 2).alias("temperature"),
        code_to_label(F.col("weather_code")).alias("shortForecast"))
