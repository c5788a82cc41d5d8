"""Column types of delimited text, from one pass that counts what the values look like.

Counts of kinds add up, so files, partitions and later loads merge by addition; the type of a column is the
least one above all kinds it has. Where a reader's inference shows only the outcome, the counts show how many
values stand against a narrower type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each value has the first kind that it matches. An integer with leading zeros is a code, so text.
KINDS = {
    "integer": r"^[+-]?(0|[1-9][0-9]{0,17})$",
    "number": r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "boolean": r"^(?i:true|false)$",
    "date": r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$",
    "timestamp": r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[T ]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,9})?$",
}
ALL = (*KINDS, "text")


def kind_of(value: Column) -> Column:
    """integer, number, boolean, date, timestamp or text; null for null and empty text."""
    kind = F.when(value.isNull() | (value == ""), F.lit(None).cast("string"))
    for name, pattern in KINDS.items():
        kind = kind.when(value.rlike(pattern), name)
    return kind.otherwise("text")


def kind_counts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """by, column_name, n_rows and n_<kind> of text columns (default: all but ``by``): one scan, partial sums."""
    columns = [c for c in df.columns if c not in by] if columns is None else columns
    kinds = df.select(*by, *[kind_of(F.col(f"`{c}`")).alias(f"_k{i}") for i, c in enumerate(columns)])
    wide = kinds.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.count_if(F.col(f"_k{i}") == k).alias(f"_{i}_{k}") for i in range(len(columns)) for k in ALL])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"_{i}_{k}").alias(f"n_{k}") for k in ALL])
                               for i, c in enumerate(columns)]))
    return wide.select(*by, "n_rows", each.alias("_c")).select(*by, "_c.column_name", "n_rows", *[f"_c.n_{k}" for k in ALL])


def merged_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of several loads as those of one."""
    return counts.groupBy(*by, "column_name").agg(F.sum("n_rows").alias("n_rows"), *[F.sum(f"n_{k}").alias(f"n_{k}") for k in ALL])


def column_types(counts: DataFrame) -> DataFrame:
    """counts with n_null, type (bigint, double, boolean, date, timestamp_ntz, string; a column without values:
    string) and n_against: the values that are not of the column's commonest kind, so what widened its type."""
    n = {k: F.col(f"n_{k}") for k in ALL}
    values = sum((n[k] for k in ALL[1:]), n[ALL[0]])

    def only(*kinds):
        return values == sum((n[k] for k in kinds[1:]), n[kinds[0]])

    kind = (F.when(values == 0, "string").when(only("integer"), "bigint").when(only("integer", "number"), "double")
            .when(only("boolean"), "boolean").when(only("date"), "date").when(only("date", "timestamp"), "timestamp_ntz")
            .otherwise("string"))
    return counts.withColumns({"n_null": F.col("n_rows") - values, "type": kind, "n_against": values - F.greatest(*n.values())})
