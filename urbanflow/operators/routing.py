"""Content-based routing of Kafka records into object layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.ids import short_id
from ..functions.paths import (department_or_default, generic_object_path, weather_object_path,
                               zone_slug)
from ..functions.timeparts import format_date, format_hour, format_time, utc_wall_clock

WEATHER_LAYOUT = "weather"
GENERIC_LAYOUT = "kafka"

ROUTING_FIELDS = StructType([StructField("station", StructType([
    StructField("zone", StringType()), StructField("department", StringType())]))])


def route_messages(records: DataFrame, weather_topic: str = "weather", value: str = "value",
                   arrival: str = "timestamp") -> DataFrame:
    """Add the routing decision and object path to Kafka-layout records.

    A record goes to the weather layout when its topic is the weather topic
    and its JSON carries a (non-null) ``station`` object; everything else
    takes the generic per-topic layout. Paths are keyed by the record's
    arrival time (the Kafka timestamp), which is replay-stable.
    """
    # one parse per record, of just the fields routing needs
    head = F.from_json(F.col(value).cast("string"), ROUTING_FIELDS)
    arrived = utc_wall_clock(F.col(arrival))
    is_weather = (F.col("topic") == F.lit(weather_topic)) & head["station"].isNotNull()
    zone = zone_slug(head["station"]["zone"])
    dept = department_or_default(head["station"]["department"])
    msg_id = short_id("topic", "partition", "offset")
    date, hour, time = format_date(arrived), format_hour(arrived), format_time(arrived)
    return (records
            .withColumns({
                "layout": F.when(is_weather, F.lit(WEATHER_LAYOUT)).otherwise(F.lit(GENERIC_LAYOUT)),
                "message_id": msg_id,
                "date": date,
                "hour": hour,
            })
            .withColumns({
                "zone": F.when(F.col("layout") == WEATHER_LAYOUT, zone),
                "dept": F.when(F.col("layout") == WEATHER_LAYOUT, dept),
            })
            .withColumn("object_path", F.when(
                F.col("layout") == WEATHER_LAYOUT,
                weather_object_path(F.col("zone"), F.col("dept"), date, hour, msg_id))
                .otherwise(generic_object_path(F.col("topic"), date, time, msg_id))))
