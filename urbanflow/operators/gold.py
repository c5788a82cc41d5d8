"""Fusion of two feeds into a gold table: aggregate each side, then join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import enrich


def fuse(base: DataFrame, facts: DataFrame, base_key: str, fact_key: str,
         measures: Mapping[str, Column], fill: Mapping[str, object] | None = None,
         dims: Sequence[tuple[DataFrame, str | Sequence[str]]] = ()) -> DataFrame:
    """``base`` LEFT JOIN (facts aggregated per key) [LEFT JOIN dims].

    Facts are reduced to one row per key before the join (partial
    aggregation happens map-side, so a hot key ships one partial row per
    task), which removes the fan-out of joining raw facts. Dimensions are
    joined as the planner sees fit.
    """
    agg = facts.groupBy(F.col(fact_key).alias(base_key)).agg(*[c.alias(n) for n, c in measures.items()])
    out = base.join(agg, base_key, "left")
    if fill:
        out = out.fillna(dict(fill))
    for dim, on in dims:
        out = enrich(out, dim, on, "left")
    return out
