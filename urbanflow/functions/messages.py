"""JSON message decoding: empty-payload filter, permissive parse, flatten, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import with_corrupt_column

CORRUPT = "_corrupt_record"

# A payload is "empty" when the consumer would skip it: missing, blank, or a
# falsy JSON document (null, false, "", {}, [], a numeric zero).
EMPTY_PAYLOAD = r'^\s*(null|false|""|\{\s*\}|\[\s*\]|-?0+(\.0*)?([eE][+-]?[0-9]+)?)?\s*$'


def payload_text(value: Column | str) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("string")


def is_empty_payload(value: Column | str) -> Column:
    text = payload_text(value)
    return text.isNull() | text.rlike(EMPTY_PAYLOAD)


def drop_empty(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(~is_empty_payload(value))


def decode_json(df: DataFrame, schema: StructType, value: str = "value", into: str = "data",
                corrupt: str = CORRUPT) -> DataFrame:
    """Parse ``value`` (binary or string) into struct ``into`` in PERMISSIVE mode.

    Malformed documents never fail the query; they keep the raw text in
    ``into.<corrupt>`` and null fields.
    """
    return df.withColumn(into, F.from_json(
        payload_text(value), with_corrupt_column(schema, corrupt),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))


def flatten(df: DataFrame, struct_col: str = "data", keep: Sequence[str] = ()) -> DataFrame:
    """Top-level star expansion; nested structs stay nested."""
    return df.select(*keep, f"{struct_col}.*")


def required_present(required: Sequence[str]) -> Column:
    cond = F.lit(True)
    for name in required:
        cond = cond & F.col(name).isNotNull()
    return cond


def split_valid(df: DataFrame, required: Sequence[str], flag: str = "_valid") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): a row is quarantined when any required field is null."""
    flagged = df.withColumn(flag, required_present(required))
    return (flagged.filter(F.col(flag)).drop(flag), flagged.filter(~F.col(flag)).drop(flag))


def to_json_value(struct: Column) -> Column:
    """JSON text keeping null fields, as Python's json.dumps does."""
    return F.to_json(struct, {"ignoreNullFields": "false"})
