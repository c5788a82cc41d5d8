"""Object-path columns of the topic router."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults used when the station object lacks a field.
UNKNOWN_ZONE = "unknown_zone"
UNKNOWN_DEPT = "unknown_dept"
UNKNOWN_STATION = "Station inconnue"


def zone_slug(zone: Column) -> Column:
    return F.replace(F.coalesce(zone, F.lit(UNKNOWN_ZONE)), F.lit(" "), F.lit("_"))


def department_or_default(dept: Column) -> Column:
    return F.coalesce(dept, F.lit(UNKNOWN_DEPT))


def weather_object_path(zone: Column, dept: Column, date: Column, hour: Column, msg_id: Column) -> Column:
    """weather/{zone}/dept_{dept}/{date}/hour_{HH}/{id}.json"""
    return F.concat(F.lit("weather/"), zone, F.lit("/dept_"), dept, F.lit("/"), date,
                    F.lit("/hour_"), hour, F.lit("/"), msg_id, F.lit(".json"))


def generic_object_path(topic: Column, date: Column, time: Column, msg_id: Column) -> Column:
    """kafka/{topic}/{date}/{HH-mm-ss}_{id}.json"""
    return F.concat(F.lit("kafka/"), topic, F.lit("/"), date, F.lit("/"), time, F.lit("_"),
                    msg_id, F.lit(".json"))
