"""Weather and air-quality indicators as column expressions.

Every function is column-parametric: callers bind it to whatever columns
carry temperature, humidity, wind and so on. ``weather_indicators`` bundles
them into one projection over a readings DataFrame (batch or streaming).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the feed producer's rules for identical results).
SEASON_MONTHS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
}
SEASON_OTHERWISE = "autumn"
SEASON_BASE_TEMP_C = {"winter": 5, "spring": 12, "summer": 22, "autumn": 12}
DIURNAL_AMPLITUDE_C = 4.0
DIURNAL_PEAK_SHIFT_H = 6
URBAN_HEAT_ISLAND_C = 2
CORE_ZONE = "Paris"
SEA_LEVEL_PRESSURE_HPA = 1013.25
PRESSURE_DROP_PER_M = 0.12
HUMIDITY_MIN, HUMIDITY_MAX = 30, 95
HUMIDITY_BASE_WINTER, HUMIDITY_BASE_OTHER = 75, 65
DEW_POINT_DIVISOR = 5.0
FEELS_LIKE_WIND_KMH = 10.0
FEELS_LIKE_FACTOR = 0.15
PRECIP_LIGHT_BELOW_MM = 2.5
PRECIP_MODERATE_BELOW_MM = 7.5
AIR_QUALITY_LABELS = ["Bon", "Moyen", "Dégradé", "Mauvais", "Très mauvais"]
WEATHER_CONDITIONS = ["clear", "partly_cloudy", "cloudy", "overcast", "light_rain", "moderate_rain",
                      "drizzle", "thunderstorm", "fog", "mist", "haze", "light_snow", "snow"]
CLEAR_SKY_CONDITIONS = ("clear", "partly_cloudy")
DAYLIGHT_FIRST_HOUR, DAYLIGHT_LAST_HOUR = 7, 17
VISIBILITY_RANGE_KM = {
    "fog": (0.1, 1.0),
    "mist": (1.0, 8.0),
    "moderate_rain": (3.0, 8.0),
    "light_rain": (8.0, 15.0),
}
VISIBILITY_DEFAULT_KM = (15.0, 35.0)
POLLUTANTS = ["PM10", "PM2.5", "NO2", "O3", "SO2", "CO"]
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(x: Column | str, digits: int = 1) -> Column:
    """floor(x * 10^d + 0.5) / 10^d: one rounding rule on every engine. NaN stays NaN, and a value whose
    scaled form is beyond 2^53 (it has no such digit) stays as it is."""
    scale = float(10 ** digits)
    v = _c(x).cast("double")
    whole = F.abs(v) * F.lit(scale) < F.lit(float(2 ** 53))  # false for NaN, which orders above all
    return F.when(whole, F.floor(v * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(v)


def season(month: Column | str) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASON_MONTHS.items():
        expr = (F.when(m.isin(*months), F.lit(name)) if expr is None
                else expr.when(m.isin(*months), F.lit(name)))
    return F.when(m.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(SEASON_OTHERWISE)))


def season_base_temperature(season_col: Column | str) -> Column:
    pairs = []
    for name, base in SEASON_BASE_TEMP_C.items():
        pairs += [F.lit(name), F.lit(float(base))]
    return F.element_at(F.create_map(*pairs), _c(season_col))


def diurnal_factor(hour: Column | str) -> Column:
    """sin((hour - 6) * pi / 12) * 4: peaks at 12h, lowest at 0h."""
    return F.sin((_c(hour) - F.lit(DIURNAL_PEAK_SHIFT_H)) * F.lit(math.pi) / F.lit(12.0)) * F.lit(DIURNAL_AMPLITUDE_C)


def urban_heat_island(zone: Column | str, core_zone: str = CORE_ZONE) -> Column:
    z = _c(zone)
    return F.when(z.isNull(), F.lit(None).cast("int")).when(z == F.lit(core_zone), F.lit(URBAN_HEAT_ISLAND_C)).otherwise(F.lit(0))


def expected_temperature(month: Column | str, hour: Column | str, zone: Column | str,
                         core_zone: str = CORE_ZONE) -> Column:
    """Noise-free producer model: season base + diurnal swing + heat island."""
    raw = season_base_temperature(season(month)) + diurnal_factor(hour) + urban_heat_island(zone, core_zone)
    return round_half_up(raw, 1)


def temperature_anomaly(actual: Column | str, expected: Column) -> Column:
    return round_half_up(_c(actual) - expected, 1)


def expected_pressure(altitude_m: Column | str) -> Column:
    return round_half_up(F.lit(SEA_LEVEL_PRESSURE_HPA) - _c(altitude_m) * F.lit(PRESSURE_DROP_PER_M), 1)


def clamp(x: Column | str, lo: float = HUMIDITY_MIN, hi: float = HUMIDITY_MAX) -> Column:
    """min(hi, max(lo, x)); null stays null (greatest/least would skip it)."""
    v = _c(x)
    return F.when(v.isNull(), v).otherwise(F.least(F.lit(hi), F.greatest(F.lit(lo), v)))


def humidity_base(season_col: Column | str) -> Column:
    return F.when(_c(season_col) == F.lit("winter"), F.lit(HUMIDITY_BASE_WINTER)).otherwise(F.lit(HUMIDITY_BASE_OTHER))


def dew_point(temp_c: Column | str, humidity_pct: Column | str) -> Column:
    return round_half_up(_c(temp_c) - (F.lit(100.0) - _c(humidity_pct)) / F.lit(DEW_POINT_DIVISOR), 1)


def feels_like(temp_c: Column | str, wind_kmh: Column | str) -> Column:
    t, w = _c(temp_c), _c(wind_kmh)
    return round_half_up(F.when(w > F.lit(FEELS_LIKE_WIND_KMH), t - w * F.lit(FEELS_LIKE_FACTOR)).otherwise(t), 1)


def gust_or_wind(gust: Column | str, wind: Column | str) -> Column:
    return F.coalesce(_c(gust), _c(wind))


def precipitation_type(condition: Column | str) -> Column:
    c = _c(condition)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c.contains("rain"), F.lit("rain"))
            .when(c.contains("snow"), F.lit("snow"))
            .otherwise(F.lit("none")))


def precipitation_intensity(amount_mm: Column | str) -> Column:
    a = _c(amount_mm)
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a < F.lit(PRECIP_LIGHT_BELOW_MM), F.lit("light"))
            .when(a < F.lit(PRECIP_MODERATE_BELOW_MM), F.lit("moderate"))
            .otherwise(F.lit("heavy")))


def air_quality_label(index: Column | str) -> Column:
    """Index 1..5 -> label; anything else -> null (no wrap-around for 0)."""
    i = _c(index)
    labels = F.array(*[F.lit(x) for x in AIR_QUALITY_LABELS])
    return F.when(i.between(1, len(AIR_QUALITY_LABELS)), F.get(labels, i - F.lit(1)))


def visibility_range(condition: Column | str) -> tuple[Column, Column]:
    lo_pairs, hi_pairs = [], []
    for cond, (lo, hi) in VISIBILITY_RANGE_KM.items():
        lo_pairs += [F.lit(cond), F.lit(lo)]
        hi_pairs += [F.lit(cond), F.lit(hi)]
    c = F.coalesce(_c(condition), F.lit(""))
    lo = F.coalesce(F.element_at(F.create_map(*lo_pairs), c), F.lit(VISIBILITY_DEFAULT_KM[0]))
    hi = F.coalesce(F.element_at(F.create_map(*hi_pairs), c), F.lit(VISIBILITY_DEFAULT_KM[1]))
    return lo, hi


def visibility_plausible(visibility_km: Column | str, condition: Column | str) -> Column:
    lo, hi = visibility_range(condition)
    return F.coalesce(_c(visibility_km).between(lo, hi), F.lit(False))


def is_daylight(hour: Column | str) -> Column:
    return _c(hour).between(DAYLIGHT_FIRST_HOUR, DAYLIGHT_LAST_HOUR)


def is_clear_sky(condition: Column | str, clear: tuple[str, ...] = CLEAR_SKY_CONDITIONS) -> Column:
    return _c(condition).isin(*clear)


def condition_description(condition: Column | str) -> Column:
    """``light_rain`` -> ``Light Rain``."""
    return F.initcap(F.replace(_c(condition), F.lit("_"), F.lit(" ")))


def pollutant_map(columns: Mapping[str, Column | str]) -> Column:
    pairs = []
    for name, col in columns.items():
        pairs += [F.lit(name), _c(col)]
    return F.create_map(*pairs)


def pollutants_long(df: DataFrame, map_col: str, keep: list[str],
                    name_col: str = "pollutant", value_col: str = "concentration") -> DataFrame:
    """One row per (reading, pollutant): explode of the pollutant map."""
    return df.select(*keep, F.explode(map_col).alias(name_col, value_col))


def weather_indicators(df: DataFrame, *, temp: str, humidity: str, wind: str, condition: str,
                       precipitation: str | None = None, month: str | None = None,
                       hour: str | None = None, zone: str | None = None,
                       altitude: str | None = None, aqi: str | None = None,
                       visibility: str | None = None, gust: str | None = None,
                       core_zone: str = CORE_ZONE) -> DataFrame:
    """All derived indicators in a single projection (one ``withColumns``)."""
    cols: dict[str, Column] = {
        "dew_point_c": dew_point(temp, humidity),
        "feels_like_c": feels_like(temp, wind),
        "condition_description": condition_description(condition),
        "precipitation_type": precipitation_type(condition),
    }
    if gust:
        cols["gust_kmh"] = gust_or_wind(gust, wind)
    if precipitation:
        cols["precipitation_intensity"] = precipitation_intensity(precipitation)
    if month:
        cols["season"] = season(month)
    if month and hour and zone:
        cols["expected_temp_c"] = expected_temperature(month, hour, zone, core_zone)
    if hour:
        cols["daylight"] = is_daylight(hour)
        cols["uv_possible"] = is_daylight(hour) & is_clear_sky(condition)
    if altitude:
        cols["expected_pressure_hpa"] = expected_pressure(altitude)
    if aqi:
        cols["air_quality_label"] = air_quality_label(aqi)
    if visibility:
        cols["visibility_plausible"] = visibility_plausible(visibility, condition)
    return df.withColumns(cols)
