"""Order-dependent operators over time, without a window over all rows.

A window ordered by time and partitioned by nothing runs in one task, and one
partitioned by day hangs on the fullest day.  Here rows are dealt to ranges of time
with some as many rows each, whose bounds come from a sketch of the times; rows are
windowed within their range, and each range gets the last row of the range before
it from a table of one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges with bounds of their own; each is cut evenly where more are wanted.
RANGES = 256


def bounds(df: DataFrame, ts: str, n: int) -> list:
    """Times that cut the rows into up to n ranges of some as many rows: quantiles of a sketch that tasks merge, one row for the driver."""
    sketch = df.agg(F.percentile_approx(ts, [i / n for i in range(1, n)], max(10_000, 50 * n))).first()[0] if n > 1 else None
    return sorted(set(sketch or []))


def range_of(ts: Column, cuts: list, kind: str = "timestamp_ntz") -> Column:
    """The number of the range that a time lies in: how many cuts are at or before it, by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(ts < F.lit(cuts[middle]).cast(kind), within(low, middle)).otherwise(within(middle + 1, high))

    return within(0, len(cuts))


def previous(df: DataFrame, columns: list[str], ts: str = "timestamp", tie: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Adds prev_<column> for each column: its value in the row before, by time and then by the tie columns.  Gaps aren't minded.

    Rows without a time have no row before them, and are before none.  Rows of one
    time stay together in a range.  Takes the bounds of the ranges (as many as Spark
    has shuffle partitions, RANGES at most, if not given) when it is called.
    """
    order = [F.col(ts), *[F.col(t) for t in tie or []]]
    n = ranges or min(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = df.schema[ts].dataType.simpleString()
    timeless = -1 - F.pmod(F.xxhash64(*df.columns), F.lit(n))
    held = F.struct(*columns)
    dealt = df.withColumn("__range", F.when(F.col(ts).isNull(), timeless).otherwise(range_of(F.col(ts), bounds(df, ts, n), kind)))
    last = dealt.where("__range >= 0").groupBy("__range").agg(F.max_by(held, F.struct(*order)).alias("__last"))
    before = last.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__before"))  # a row a range
    inside = Window.partitionBy("__range").orderBy(*order)
    rows = dealt.withColumn("__lag", F.lag(held).over(inside)).withColumn("__first", F.row_number().over(inside) == 1)
    joined = rows.join(F.broadcast(before), "__range", "left")
    found = F.when(F.col("__range") < 0, None).when(F.col("__first"), F.col("__before")).otherwise(F.col("__lag"))
    return joined.select(*[rows[c] for c in df.columns], *[found[c].alias(f"prev_{c}") for c in columns])


def ramps(df: DataFrame, columns: list[str], ts: str = "timestamp", tie: list[str] | None = None, gap_minutes: int | None = None) -> DataFrame:
    """Adds <column>_ramp, the change from the row before.

    gap_minutes: if given, a change over a longer gap is null; by default gaps
    aren't minded.
    """
    made = previous(df, list(dict.fromkeys([*columns, ts])), ts, tie)
    near = F.lit(True) if gap_minutes is None else F.col(f"prev_{ts}") >= F.col(ts) - F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    return made.select(*df.columns, *[F.when(near, F.col(c) - F.col(f"prev_{c}")).alias(f"{c}_ramp") for c in columns])


def minutes_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("MINUTE", earlier, later)


def top_by(df: DataFrame, value: Column, n: int, *ties: Column) -> DataFrame:
    """The n rows of the largest values, nulls last, ties in the given order: one bounded heap a task."""
    return df.orderBy(value.desc_nulls_last(), *ties).limit(n)


def top_per(df: DataFrame, by: list[str], value: Column, n: int, *ties: Column) -> DataFrame:
    """The n rows of the largest values in each group. Spark keeps n a task before it shuffles (window group limit)."""
    w = Window.partitionBy(*by).orderBy(value.desc_nulls_last(), *ties)
    return df.withColumn("__at", F.row_number().over(w)).where(F.col("__at") <= n).drop("__at")
