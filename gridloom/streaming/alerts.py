"""Slots that stay empty, told while rows still arrive: event time, a watermark and keyed state.

Rows come in any order within the lateness.  Each source keeps the slots that were
seen and aren't closed yet, and the last slot that is.  When the watermark (the
latest time of all sources less the lateness) passes a slot, the slot is closed: if
it was never seen, and lies behind the source's first slot, it is told as missing,
once.  Rows are reduced to slots before they reach a source's state, so a source
with most of the rows is no hot key: its state has the slots of the lateness at most.

Rows later than the watermark are dropped, as is usual; so what is told equals the
batch answer up to the last watermark, if no row was later than the lateness.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SLOT_MS = 5 * 60 * 1000
STATE = "closed long, seen array<long>"


def without_late_copies(rows: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Rows of a stream, each key once within the lateness; timestamp becomes a zoned time, which watermarks need."""
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late).dropDuplicatesWithinWatermark(keys)


def closed_by(watermark_ms: int, closed: int | None, seen: set[int]) -> tuple[list[int], int | None, set[int]]:
    """Slots (numbers) told as missing once the watermark has come so far, the last slot closed now, and those still open."""
    until = -(-watermark_ms // SLOT_MS) - 1  # the last slot that begins before the watermark
    known = [s for s in seen if s <= until]
    if closed is None and not known:
        return [], None, seen
    first = min(known) if closed is None else closed + 1
    return [s for s in range(first, until + 1) if s not in seen], max(until, closed if closed is not None else until), {s for s in seen if s > until}


def missing_slots(rows: DataFrame, late: str) -> DataFrame:
    """A stream of rows (timestamp, source) as a stream of source and slot, for each slot of five minutes that a source misses."""
    slots = rows.select("source", F.col("timestamp").cast("timestamp").alias("timestamp"))
    slots = slots.select("source", F.window("timestamp", "5 minutes")["start"].alias("timestamp")).withWatermark("timestamp", late)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        closed, seen = state.get if state.exists else (None, [])
        held = set(seen)
        for part in parts:
            held.update((part["timestamp"].astype("datetime64[ms, UTC]" if part["timestamp"].dt.tz is not None else "datetime64[ms]").astype("int64") // SLOT_MS).tolist())
        now = state.getCurrentWatermarkMs()
        told, closed, held = closed_by(now, closed, {s for s in held if closed is None or s > closed})
        state.update((closed, sorted(held)))
        state.setTimeoutTimestamp(now + 1)  # called again as soon as the watermark moves, also without rows
        if told:
            yield pd.DataFrame({"source": [key[0]] * len(told), "slot": pd.to_datetime([s * SLOT_MS for s in told], unit="ms", utc=True)})

    once = slots.dropDuplicatesWithinWatermark(["source", "timestamp"])
    made = once.groupBy("source").applyInPandasWithState(step, "source string, slot timestamp", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return made.select("source", F.col("slot").cast("timestamp_ntz").alias("timestamp"))
