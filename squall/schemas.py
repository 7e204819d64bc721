"""Contracts (silver / gold) and the bronze JSON shapes, as explicit Spark schemas.

Explicit schemas mean no inference pass over the input and a missing field is
simply null (P1).
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

S = StringType()
TS = TimestampType()
D = DoubleType()

ALERT = StructType([
    StructField("entity_id", S), StructField("routeId", S), StructField("start", TS),
    StructField("end", TS), StructField("header_text", S), StructField("description_text", S),
])

WEATHER = StructType([
    StructField("startTime", TS), StructField("endTime", TS),
    StructField("temperature", D), StructField("shortForecast", S),
])

# Silver snapshots carry where and when they were taken.
SNAPSHOT_TAGS = StructType([StructField("source", S), StructField("ingest_ts", TS)])

GOLD = StructType(ALERT.fields + [
    StructField("weather_start", TS), StructField("weather_end", TS),
    StructField("temperature", D), StructField("shortForecast", S),
])

FACT = StructType(GOLD.fields + [StructField("weather_date", DateType()), StructField("batch_id", LongType())])

SUMMARY = StructType([
    StructField("alert_date", DateType()), StructField("routeId", S), StructField("entity_id", LongType()),
    StructField("temperature", D), StructField("shortForecast", S),
])

VIEW = StructType([
    StructField("routeId", S), StructField("weather_start", TS),
    StructField("weather_category", S), StructField("total_alerts", LongType()),
])

# ---- bronze -----------------------------------------------------------------

_TRANSLATED = StructType([StructField("translation", ArrayType(StructType([StructField("text", S)])))])

LIVE_ALERT_FEED = StructType([
    StructField("entity", ArrayType(StructType([
        StructField("id", S),
        StructField("alert", StructType([
            StructField("headerText", _TRANSLATED),
            StructField("descriptionText", _TRANSLATED),
            StructField("informedEntity", ArrayType(StructType([StructField("routeId", S)]))),
            # epoch seconds; kept as text so junk does not fail the read
            StructField("activePeriod", ArrayType(StructType([StructField("start", S), StructField("end", S)]))),
        ])),
    ]))),
])

LIVE_WEATHER_DOC = StructType([
    StructField("properties", StructType([
        StructField("periods", ArrayType(StructType([
            StructField("startTime", S), StructField("endTime", S),
            StructField("temperature", D), StructField("shortForecast", S),
        ]))),
    ])),
])

HISTORICAL_ALERT_RECORD = StructType([
    StructField("status_id", S), StructField("date", S), StructField("affected", S),
    StructField("header", S), StructField("description", S),
    StructField("agency", S), StructField("status_label", S),
])

HISTORICAL_WEATHER_DOC = StructType([
    StructField("hourly", StructType([
        StructField("time", ArrayType(S)),
        StructField("temperature_2m", ArrayType(D)),
        StructField("precipitation", ArrayType(D)),
        StructField("weather_code", ArrayType(D)),
    ])),
])
