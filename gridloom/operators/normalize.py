"""From raw columns to canonical tables, and from those to the unified long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import identifier, no_nan, parse_ts, quoted, csv_line, to_num, ts_text
from ..schema import DEMAND, GRAIN, SIGNALS, VALUE_COLUMN


def normalize(signal: str, raw: DataFrame) -> DataFrame:
    """Text columns, by position, to the canonical table; another number of columns is an error."""
    want = 2 if signal == DEMAND else 3
    if len(raw.columns) != want:
        raise ValueError(f"{signal} expected {want} columns, got {raw.columns}")
    time, *names, value = (F.col(f"`{c}`") for c in raw.columns)
    return raw.select(parse_ts(time).alias("timestamp"), *[identifier(n).alias("generator_id") for n in names], to_num(value).alias(VALUE_COLUMN[signal]))


def to_long(signal: str, df: DataFrame) -> DataFrame:
    """A canonical table in the unified columns; demand has no generator. NaN becomes null."""
    if signal not in SIGNALS:
        raise ValueError(f"unsupported signal: {signal}")
    generator = F.lit(None).cast("string") if signal == DEMAND else F.col("generator_id").cast("string")
    value = no_nan(F.col(VALUE_COLUMN[signal]).cast("double"))
    return df.select("timestamp", F.lit(signal).alias("source"), generator.alias("generator_id"), value.alias("value_mw"))


def unify(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [to_long(s, t) for s, t in tables.items()])


def grain(signal: str) -> list[str]:
    return list(GRAIN[signal])


def csv_rows(unified: DataFrame, keep: list | None = None) -> DataFrame:
    """The unified table as lines of the CSV contract. keep: columns that stay beside them."""
    line = csv_line(quoted(ts_text(F.col("timestamp"))), quoted(F.col("source")), quoted(F.col("generator_id")), F.col("value_mw"))
    return unified.select(*(keep or []), line.alias("value"))


CSV_HEADER = '"timestamp","source","generator_id","value_mw"'
