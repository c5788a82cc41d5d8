"""Distinct counts and quantiles of columns from stored, mergeable sketches.

Each partition of a table keeps one HLL and one KLL sketch a column. Sketches of new partitions are added, and
any union of partitions is answered from them alone: no row is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# log2 of the HLL registers, and three standard deviations of its relative error (unions included)
HLL_BITS = 13
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
# size of the KLL sketch, and the error of a rank it gives, as a share of the values (99 % of sketches keep it)
KLL_SIZE = 800
KLL_ERROR = 0.005


def _identity(df: DataFrame, name: str) -> Column:
    """64 bits that stand for a value; -0.0 is 0.0; null for null."""
    c = F.col(name)
    if dict(df.dtypes)[name] in ("double", "float"):
        c = c + F.lit(0.0)
    return F.when(c.isNotNull(), F.xxhash64(c))


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row per group and column: ``by``, column_name, n_rows, n_null, distinct_sketch, value_sketch (null for
    columns that are no numbers). One scan; each task sends one sketch a group and column, so a group that holds
    most rows is no single task. Nulls are in no sketch, NaN only among the distinct values."""
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        numeric = kinds[c].startswith(("int", "bigint", "small", "tiny", "double", "float", "decimal"))
        value = F.col(c).cast("double")
        aggs += [F.count(F.col(c)).alias(f"_v{i}"), F.hll_sketch_agg(_identity(df, c), HLL_BITS).alias(f"_d{i}"),
                 (F.kll_sketch_agg_double(F.when(~F.isnan(value), value), KLL_SIZE) if numeric else F.lit(None).cast("binary")).alias(f"_q{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    each = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(f"_v{i}")).alias("n_null"),
                 F.col(f"_d{i}").alias("distinct_sketch"), F.col(f"_q{i}").alias("value_sketch")) for i, c in enumerate(columns)]))
    return wide.select(*by, F.col("_n").alias("n_rows"), each.alias("_c")).select(
        *by, "_c.column_name", "n_rows", "_c.n_null", "_c.distinct_sketch", "_c.value_sketch")


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of unions: those of all rows that agree in ``by`` and column_name, merged."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"))


def sketch_estimates(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """n_distinct (within HLL_ERROR of it) and quantiles (each a value whose rank is within KLL_ERROR of its
    probability; null for columns without a number) in place of the sketches."""
    sketch = F.col("value_sketch")
    some = sketch.isNotNull() & (F.kll_sketch_get_n_double(sketch) > 0)
    quantiles = F.when(some, F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(p)) for p in probabilities]))
    return sketches.withColumns({"n_distinct": F.hll_sketch_estimate("distinct_sketch"), "quantiles": quantiles}).drop(
        "distinct_sketch", "value_sketch")
