"""Explicit schemas of every feed (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType,
                               MapType, StringType, StructField, StructType, TimestampType)


def _s(*fields: StructField) -> StructType:
    return StructType(list(fields))


def _f(name: str, dtype, nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


COORDINATES = _s(_f("latitude", DoubleType()), _f("longitude", DoubleType()))

# The seven top-level fields the ingest job reads. ``altitude`` and
# ``altitude_m`` are both accepted (the producer writes ``altitude_m``).
WEATHER_CORE = _s(
    _f("reading_id", StringType()),
    _f("timestamp", StringType()),
    _f("station", _s(
        _f("name", StringType()),
        _f("coordinates", COORDINATES),
        _f("department", StringType()),
        _f("zone", StringType()),
        _f("altitude", IntegerType()),
        _f("altitude_m", IntegerType()),
    )),
    _f("temperature", _s(_f("actual_c", DoubleType()), _f("feels_like_c", DoubleType()))),
    _f("atmospheric", _s(
        _f("humidity_percent", IntegerType()),
        _f("pressure_hpa", DoubleType()),
        _f("visibility_km", DoubleType()),
    )),
    _f("wind", _s(_f("speed_kmh", DoubleType()), _f("direction", StringType()))),
    _f("conditions", _s(_f("weather", StringType()), _f("description", StringType()))),
)

# Every field the producer puts on the wire.
WEATHER_FULL = _s(
    _f("reading_id", StringType()),
    _f("timestamp", StringType()),
    _f("station", _s(
        _f("name", StringType()),
        _f("coordinates", COORDINATES),
        _f("department", StringType()),
        _f("zone", StringType()),
        _f("altitude_m", IntegerType()),
    )),
    _f("temperature", _s(
        _f("actual_c", DoubleType()),
        _f("feels_like_c", DoubleType()),
        _f("dew_point_c", DoubleType()),
        _f("urban_heat_island_effect", IntegerType()),
    )),
    _f("atmospheric", _s(
        _f("humidity_percent", IntegerType()),
        _f("pressure_hpa", DoubleType()),
        _f("visibility_km", DoubleType()),
    )),
    _f("wind", _s(_f("speed_kmh", DoubleType()), _f("direction", StringType()), _f("gust_kmh", DoubleType()))),
    _f("precipitation", _s(_f("amount_mm", DoubleType()), _f("type", StringType()), _f("intensity", StringType()))),
    _f("conditions", _s(
        _f("weather", StringType()),
        _f("description", StringType()),
        _f("uv_index", IntegerType()),
        _f("season", StringType()),
    )),
    _f("air_quality", _s(
        _f("overall_index", IntegerType()),
        _f("overall_description", StringType()),
        _f("pollutants", MapType(StringType(), IntegerType())),
    )),
    _f("metadata", _s(
        _f("data_source", StringType()),
        _f("region", StringType()),
        _f("measurement_height_m", IntegerType()),
        _f("quality_control", _s(
            _f("temperature_valid", BooleanType()),
            _f("pressure_valid", BooleanType()),
            _f("humidity_valid", BooleanType()),
            _f("wind_valid", BooleanType()),
            _f("precipitation_valid", BooleanType()),
        )),
    )),
    _f("thread_id", IntegerType()),
    _f("message_number", IntegerType()),
    _f("processing_timestamp", StringType()),
)

# PM sensor test feed: epoch-seconds timestamp.
PM = _s(
    _f("station", StringType()),
    _f("timestamp", DoubleType()),
    _f("pm10", IntegerType()),
    _f("pm25", IntegerType()),
    _f("counter", LongType()),
)

# Column names of the yearly station-traffic CSV (';'-separated,
# UTF-8 with BOM). Connections stay strings ("3bis", "A").
TRAFIC = _s(
    _f("Rang", IntegerType()),
    _f("Réseau", StringType()),
    _f("Station", StringType()),
    _f("Trafic", LongType()),
    _f("Correspondance_1", StringType()),
    _f("Correspondance_2", StringType()),
    _f("Correspondance_3", StringType()),
    _f("Correspondance_4", StringType()),
    _f("Correspondance_5", StringType()),
    _f("Ville", StringType()),
    _f("Arrondissement pour Paris", IntegerType()),
)

STATION = _s(
    _f("name", StringType(), False),
    _f("lat", DoubleType()),
    _f("lon", DoubleType()),
    _f("department", StringType()),
    _f("zone", StringType()),
    _f("altitude", IntegerType()),
)

# Column layout of the Kafka source; file and memory streams used in tests
# are adapted to exactly this layout so the same parsing code runs on both.
KAFKA_RECORD = _s(
    _f("key", BinaryType()),
    _f("value", BinaryType()),
    _f("topic", StringType()),
    _f("partition", IntegerType()),
    _f("offset", LongType()),
    _f("timestamp", TimestampType()),
    _f("timestampType", IntegerType()),
)


# Datasets with a known schema for batch loads; any other dataset is inferred.
KNOWN_DATASETS = {"trafic": TRAFIC}


def with_corrupt_column(schema: StructType, name: str = "_corrupt_record") -> StructType:
    """Schema plus the PERMISSIVE-mode corrupt-record string column."""
    if name in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(name, StringType(), True)])
