"""Signals, their canonical schemas and the unified long schema."""

from __future__ import annotations

from pyspark.sql import types as T

DEMAND, DISPATCH, STATE = "demand", "dispatch", "state_estimation"
SIGNALS = (DEMAND, DISPATCH, STATE)
#: The value column of each signal's canonical table.
VALUE_COLUMN = {DEMAND: "demand_forecast_mw", DISPATCH: "dispatch_mw", STATE: "estimated_generation_mw"}
#: The columns that name a row of each signal.
GRAIN = {DEMAND: ["timestamp"], DISPATCH: ["timestamp", "generator_id"], STATE: ["timestamp", "generator_id"]}
SLOT_MINUTES = 5
SLOTS_PER_DAY = 24 * 60 // SLOT_MINUTES

UNIFIED = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("generator_id", T.StringType(), True),
        T.StructField("value_mw", T.DoubleType(), True),
    ]
)


def canonical(signal: str) -> T.StructType:
    fields = [T.StructField("timestamp", T.TimestampNTZType(), True)]
    if signal != DEMAND:
        fields.append(T.StructField("generator_id", T.StringType(), True))
    return T.StructType([*fields, T.StructField(VALUE_COLUMN[signal], T.DoubleType(), True)])
