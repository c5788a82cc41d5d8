"""Rule-driven range checks: flags, all-valid, and a valid/quarantine split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RangeRule:
    """``lo <= value <= hi`` with optional open ends; a null value fails."""

    name: str
    column: str
    lo: float | None = None
    hi: float | None = None
    lo_inclusive: bool = True
    hi_inclusive: bool = True

    def check(self, bind: Mapping[str, str] | None = None) -> Column:
        v = F.col((bind or {}).get(self.column, self.column))
        cond = v.isNotNull()
        if self.lo is not None:
            cond = cond & (v >= F.lit(self.lo) if self.lo_inclusive else v > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (v <= F.lit(self.hi) if self.hi_inclusive else v < F.lit(self.hi))
        return F.coalesce(cond, F.lit(False))


# The producer's quality-control bounds.
WEATHER_RULES = (
    RangeRule("temperature_valid", "temperature", -20, 45),
    RangeRule("pressure_valid", "pressure", 950, 1050),
    RangeRule("humidity_valid", "humidity", 0, 100),
    RangeRule("wind_valid", "wind", None, 150),
    RangeRule("precipitation_valid", "precipitation", None, 100, hi_inclusive=False),
)


def qc_flags(df: DataFrame, rules: Sequence[RangeRule] = WEATHER_RULES,
             bind: Mapping[str, str] | None = None, all_valid: str = "all_valid") -> DataFrame:
    """One boolean column per rule plus their conjunction."""
    flags = {r.name: r.check(bind) for r in rules}
    out = df.withColumns(flags)
    conj = F.lit(True)
    for r in rules:
        conj = conj & F.col(r.name)
    return out.withColumn(all_valid, conj)


def failed_rules(rules: Sequence[RangeRule]) -> Column:
    """Comma-separated names of the failed rules (empty string when none)."""
    return F.concat_ws(",", *[F.when(~F.col(r.name), F.lit(r.name)) for r in rules])


def qc_split(df: DataFrame, rules: Sequence[RangeRule] = WEATHER_RULES,
             bind: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows carry ``failed_rules``."""
    flagged = qc_flags(df, rules, bind)
    valid = flagged.filter(F.col("all_valid"))
    rejected = flagged.filter(~F.col("all_valid")).withColumn("failed_rules", failed_rules(rules))
    return valid, rejected
