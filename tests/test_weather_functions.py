"""Boundary values of every weather / air-quality column function."""

import math

import pytest
from pyspark.sql import functions as F

from urbanflow.functions import weather as W
from conftest import rows


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_round_half_up_is_engine_independent(spark):
    got = one(spark, W.round_half_up("v", 1), [(0.25,), (0.35,), (-0.25,), (2.449,), (None,)], "v double")
    assert got == [0.3, 0.4, -0.2, 2.4, None]


@pytest.mark.parametrize("month,season", [(12, "winter"), (1, "winter"), (2, "winter"), (3, "spring"),
                                          (5, "spring"), (6, "summer"), (8, "summer"), (9, "autumn"),
                                          (11, "autumn"), (None, None)])
def test_season(spark, month, season):
    assert one(spark, W.season("m"), [(month,)], "m int") == [season]


def test_expected_temperature_matches_formula(spark):
    data = [(7, 12, "Paris"), (1, 0, "Essonne"), (4, 18, "Paris"), (10, 6, "Yvelines")]
    got = one(spark, W.expected_temperature("m", "h", "z"), data, "m int, h int, z string")
    base = {7: 22, 1: 5, 4: 12, 10: 12}
    want = [math.floor((base[m] + math.sin((h - 6) * math.pi / 12) * 4 + (2 if z == "Paris" else 0)) * 10 + 0.5) / 10
            for m, h, z in data]
    assert got == want
    assert got[0] == 28.0  # summer noon in the core zone: 22 + 4 + 2


def test_expected_pressure(spark):
    assert one(spark, W.expected_pressure("a"), [(0,), (100,), (132,)], "a int") == [1013.3, 1001.3, 997.4]


def test_clamp_keeps_null(spark):
    got = one(spark, W.clamp("h", 30, 95), [(10,), (30,), (60,), (95,), (120,), (None,)], "h int")
    assert got == [30, 30, 60, 95, 95, None]


def test_dew_point(spark):
    assert one(spark, W.dew_point("t", "rh"), [(20.0, 60), (10.0, 100), (None, 50)], "t double, rh int") == [12.0, 10.0, None]


def test_feels_like_wind_threshold_is_strict(spark):
    got = one(spark, W.feels_like("t", "w"), [(20.0, 10.0), (20.0, 10.1), (20.0, 20.0)], "t double, w double")
    assert got == [20.0, 18.5, 17.0]


def test_precipitation_type(spark):
    data = [("light_rain",), ("moderate_rain",), ("light_snow",), ("snow",), ("drizzle",),
            ("thunderstorm",), ("clear",), (None,)]
    assert one(spark, W.precipitation_type("c"), data, "c string") == [
        "rain", "rain", "snow", "snow", "none", "none", "none", None]


def test_precipitation_intensity_boundaries(spark):
    got = one(spark, W.precipitation_intensity("p"), [(0.0,), (2.4,), (2.5,), (7.4,), (7.5,), (None,)], "p double")
    assert got == ["light", "light", "moderate", "moderate", "heavy", None]


def test_air_quality_label_guards_range(spark):
    got = one(spark, W.air_quality_label("i"), [(0,), (1,), (3,), (5,), (6,), (None,)], "i int")
    assert got == [None, "Bon", "Dégradé", "Très mauvais", None, None]


def test_visibility_plausible_uses_default_bounds(spark):
    data = [(0.5, "fog"), (2.0, "fog"), (20.0, "cloudy"), (10.0, "cloudy"), (12.0, "light_rain"), (None, "fog"), (20.0, None)]
    got = one(spark, W.visibility_plausible("v", "c"), data, "v double, c string")
    assert got == [True, False, True, False, True, False, True]


def test_daylight_and_clear_sky(spark):
    got = rows(spark.createDataFrame([(6, "clear"), (7, "clear"), (17, "partly_cloudy"), (18, "clear"), (12, "fog")],
                                     "h int, c string")
               .select(W.is_daylight("h"), W.is_clear_sky("c")))
    assert got == [(False, True), (True, True), (True, True), (False, True), (True, False)]


def test_condition_description(spark):
    got = one(spark, W.condition_description("c"), [("light_rain",), ("partly_cloudy",), ("fog",)], "c string")
    assert got == ["Light Rain", "Partly Cloudy", "Fog"]


def test_pollutants_long_explodes_map(spark):
    df = spark.createDataFrame([(1, 40, 21)], "id int, pm10 int, pm25 int")
    df = df.withColumn("p", W.pollutant_map({"PM10": F.col("pm10"), "PM2.5": F.col("pm25")}))
    got = sorted(rows(W.pollutants_long(df, "p", ["id"])))
    assert got == [(1, "PM10", 40), (1, "PM2.5", 21)]


def test_weather_indicators_single_projection(spark):
    df = spark.createDataFrame([(24.5, 60, 12.0, "light_rain", 2.5, 7, 23, "Paris", 42, 3, 12.4)],
                               "t double, rh int, w double, c string, p double, m int, h int, z string, a int, q int, v double")
    out = W.weather_indicators(df, temp="t", humidity="rh", wind="w", condition="c", precipitation="p",
                               month="m", hour="h", zone="z", altitude="a", aqi="q", visibility="v")
    r = out.collect()[0].asDict()
    assert r["dew_point_c"] == 16.5 and r["feels_like_c"] == 22.7
    assert r["precipitation_type"] == "rain" and r["precipitation_intensity"] == "moderate"
    assert r["season"] == "summer" and r["daylight"] is False and r["uv_possible"] is False
    assert r["air_quality_label"] == "Dégradé" and r["visibility_plausible"] is True
    assert r["condition_description"] == "Light Rain" and r["expected_pressure_hpa"] == 1008.2


def test_gust_defaults_to_wind(spark):
    got = rows(spark.createDataFrame([(None, 6.0), (16.8, 12.0), (None, None)], "g double, w double")
               .select(W.gust_or_wind("g", "w")))
    assert got == [(6.0,), (16.8,), (None,)]
