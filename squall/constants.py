"""Fixed values the results depend on.

Everything in this module must stay equal to the behaviour being reproduced
(keyword lists, CASE rules, code tables, patterns, contract column orders).
They are stated plainly, in their natural order, and are used as parameters
by the operators; no logic lives here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — do not edit without re-checking the semantics they encode.
# ---------------------------------------------------------------------------

# Contract column orders (silver / gold).
ALERT_COLUMNS = ["entity_id", "routeId", "start", "end", "header_text", "description_text"]
WEATHER_COLUMNS = ["startTime", "endTime", "temperature", "shortForecast"]
FACT_KEY = ["entity_id", "routeId", "weather_start", "header_text"]
ALERT_DEDUP_KEY = ["entity_id", "start", "routeId"]

# Historical alert record -> alert contract.
HISTORICAL_ALERT_RENAMES = {
    "status_id": "entity_id",
    "date": "start",
    "affected": "routeId",
    "header": "header_text",
    "description": "description_text",
}

# Join tolerance between an alert start and a weather hour: 2 hours, inclusive.
ASOF_TOLERANCE_SECONDS = 2 * 3600
# Fact rows are keyed on weather_start rounded to the nearest 15 minutes (ties to even).
FACT_ROUND_SECONDS = 15 * 60
# Rows without an explicit end last one hour.
DEFAULT_DURATION_SECONDS = 3600

# Route taken from a header when an informed entity has no route.
ROUTE_IN_HEADER_PATTERN = r"\[([1-7A-Z]+)\]"
SYSTEM_WIDE_ROUTE = "SYSTEM_WIDE"
UNKNOWN_ROUTE = "Unknown"
# Historical affected-route lists are separated by this literal text.
ROUTE_LIST_SEPARATOR = " | "

# Reporting-view keyword filter: lower(header_text) / lower(description_text) LIKE '%kw%'.
HEADER_WEATHER_KEYWORDS = [
    "weather", "heavy rain", "snow", "flood", "wind", "storm", "icy", "icing",
    "hurricane", "blizzard", "fog", "heat",
]
DESCRIPTION_WEATHER_KEYWORDS = [
    "weather", "light rain", "drizzle", "heavy rain", "snow", "flood", "wind", "storm",
    "icy", "icing", "hurricane", "blizzard", "fog", "heat",
]

# Historical extraction predicate: agency = 'Subway' and any pattern in header or description.
EXTRACT_AGENCY = "Subway"
EXTRACT_KEYWORDS = [
    "storm", "snow", "flood", "weather", "wind", "blizzard", "hurricane", "heavy rain", " rain",
]

# Forecast category, first matching rule wins, case-insensitive substring match.
FORECAST_CATEGORY_RULES = [
    (["rain", "showers", "hurricane"], "Rain"),
    (["snow", "blizzard"], "Snow"),
    (["sunny", "clear"], "Clear"),
]
FORECAST_CATEGORY_DEFAULT = "Cloudy/Other"

# WMO weather code -> forecast text; anything else (and null) is the default.
WMO_CODE_FORECASTS = [
    ([0, 1, 2], "Clear"),
    ([3], "Cloudy"),
    ([51, 53, 55, 61, 63, 65, 80, 81, 82], "Rain"),
    ([71, 73, 75, 85, 86], "Snow"),
    ([95, 96, 99], "Storm"),
]
WMO_CODE_DEFAULT = "Cloudy/Other"

# Name under which the reporting view is registered (queried by consumers).
IMPACT_VIEW_NAME = "view_weather_impact"

# Source ranks used when the same record arrives from several snapshots.
SOURCE_HISTORICAL = "historical"
SOURCE_LIVE = "live"
