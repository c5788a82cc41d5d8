"""Dimension enrichment; the planner picks the join strategy from the sizes it knows and AQE measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """Join a dimension. No hint and no counting job: ``autoBroadcastJoinThreshold`` decides by bytes, at plan
    time and again at run time; a dimension beyond it is joined by shuffle, with skewed keys split."""
    return df.join(dim, on, how)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls of (possibly nested) fields by defaults; output column
    names are the last path segment unless the key is ``src AS name``."""
    cols = {}
    for key, default in defaults.items():
        src, _, name = key.partition(" AS ")
        name = name or src.split(".")[-1]
        cols[name] = F.coalesce(F.col(src), F.lit(default))
    return df.withColumns(cols)


def fill_station_attributes(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Fill missing station attributes (coordinates, department, zone,
    altitude) from the station registry, looked up by ``station.name``.

    A left join against the registry (37 fixed rows): works on a
    stream (stream-static join) and never drops a reading, known or not.
    """
    dim = stations.select(F.col("name").alias("_st_name"), F.col("lat").alias("_st_lat"),
                          F.col("lon").alias("_st_lon"), F.col("department").alias("_st_dept"),
                          F.col("zone").alias("_st_zone"), F.col("altitude").alias("_st_alt"))
    j = df.join(dim, F.col("station.name") == F.col("_st_name"), "left")
    st = F.col("station")
    coords = F.struct(F.coalesce(st["coordinates"]["latitude"], F.col("_st_lat")).alias("latitude"),
                      F.coalesce(st["coordinates"]["longitude"], F.col("_st_lon")).alias("longitude"))
    filled = (st.withField("coordinates", coords)
              .withField("department", F.coalesce(st["department"], F.col("_st_dept")))
              .withField("zone", F.coalesce(st["zone"], F.col("_st_zone")))
              .withField("altitude", F.coalesce(st["altitude"], F.col("_st_alt"))))
    return j.withColumn("station", F.when(st.isNull(), st).otherwise(filled)).drop(*dim.columns)
