"""Expected slots, missing ones, and runs of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def axis(spark: SparkSession, start: str, end: str, minutes: int = 5) -> DataFrame:
    """All slots of [start, end), made in as many tasks as there are days."""
    days = spark.sql(f"SELECT explode(sequence(date_trunc('DAY', TIMESTAMP_NTZ '{start}'), TIMESTAMP_NTZ '{end}', INTERVAL 1 DAY)) AS day")
    slots = days.selectExpr(f"explode(sequence(CAST(day AS TIMESTAMP_NTZ), CAST(day AS TIMESTAMP_NTZ) + INTERVAL 1 DAY - INTERVAL {minutes} MINUTES, INTERVAL {minutes} MINUTES)) AS timestamp")
    return slots.where(f"timestamp >= TIMESTAMP_NTZ '{start}' AND timestamp < TIMESTAMP_NTZ '{end}'")


def missing(expected: DataFrame, observed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Expected slots without a row, for each value of the by columns of expected."""
    keys = [*(by or []), "timestamp"]
    return expected.join(observed.select(*keys).distinct(), keys, "left_anti")


def outside(expected: DataFrame, observed: DataFrame) -> DataFrame:
    return observed.select("timestamp").where("timestamp IS NOT NULL").distinct().join(expected, "timestamp", "left_anti")


def shared(*missing_sets: DataFrame) -> DataFrame:
    out = missing_sets[0].select("timestamp")
    for m in missing_sets[1:]:
        out = out.intersect(m.select("timestamp"))
    return out


def runs(slots: DataFrame, by: list[str], minutes: int = 5) -> DataFrame:
    """Contiguous runs of slots in each group: by..., run_start, run_end, slots. Groups should name a month or so, each is windowed in one task."""
    w = Window.partitionBy(*by).orderBy("timestamp")
    island = F.col("timestamp") - F.make_dt_interval(mins=minutes * F.row_number().over(w))
    keyed = slots.select(*by, "timestamp", island.alias("__island"))
    made = keyed.groupBy(*by, "__island").agg(F.min("timestamp").alias("run_start"), F.max("timestamp").alias("run_end"), F.count("*").alias("slots"))
    return made.drop("__island")


#: Slots that make the first pieces of time (a day of five-minute slots), and pieces that are merged into one of the next level.
PIECE, MERGED, LEVELS = 288, 64, 3


def merged(a: Column, b: Column) -> Column:
    """The state of two pieces of time in order: what is present at their ends and the longest run, from the states of both.

    lo, hi: first slot and the one after the last; prefix, suffix: lengths of the runs
    at the ends; start, length: the longest run, the earliest of equals.  The operation
    is associative, so pieces may be merged in any grouping.
    """
    touch = a["hi"] == b["lo"]
    joined = F.when(touch, a["suffix"] + b["prefix"]).otherwise(F.lit(0))
    best = F.greatest(a["length"], joined, b["length"])
    start = F.when(a["length"] == best, a["start"]).when(joined == best, a["hi"] - a["suffix"]).otherwise(b["start"])
    prefix = F.when(touch & (a["prefix"] == a["hi"] - a["lo"]), a["prefix"] + b["prefix"]).otherwise(a["prefix"])
    suffix = F.when(touch & (b["suffix"] == b["hi"] - b["lo"]), a["suffix"] + b["suffix"]).otherwise(b["suffix"])
    return F.struct(a["lo"].alias("lo"), b["hi"].alias("hi"), prefix.alias("prefix"), suffix.alias("suffix"), start.alias("start"), best.alias("length"))


def _folded(states: Column) -> Column:
    """States of pieces, put in order and merged from the first on."""
    ordered = F.array_sort(states)
    return F.reduce(F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), ordered[0], merged)


def longest_run(slots: DataFrame, by: list[str], minutes: int = 5) -> DataFrame:
    """The longest run of slots of each group, the earliest of equals: by..., run_start, run_end, slots.

    Runs aren't windowed: each day of a group becomes a state of six numbers, and
    states are merged by some days, years and so on, so that no task gathers a
    group, however long its history or whatever share of the rows it has.  Times are
    taken to their slot; slots that come twice count once; rows without a time don't.
    """
    t = F.col("timestamp")
    number = F.floor((F.unix_date(F.to_date(t)).cast("long") * 1440 + F.hour(t) * 60 + F.minute(t)) / F.lit(minutes))
    one = lambda k: F.struct(k.alias("lo"), (k + 1).alias("hi"), F.lit(1).cast("long").alias("prefix"), F.lit(1).cast("long").alias("suffix"), k.alias("start"), F.lit(1).cast("long").alias("length"))
    keyed = slots.where(F.col("timestamp").isNotNull()).select(*by, number.alias("__k")).withColumn("__piece", F.floor(F.col("__k") / PIECE))
    made = keyed.groupBy(*by, "__piece").agg(F.collect_set("__k").alias("__ks")).select(*by, "__piece", _folded(F.transform("__ks", one)).alias("__s"))
    for _ in range(LEVELS - 1):
        made = made.withColumn("__piece", F.floor(F.col("__piece") / MERGED)).groupBy(*by, "__piece").agg(_folded(F.collect_list("__s")).alias("__s"))
    made = made.groupBy(*by).agg(_folded(F.collect_list("__s")).alias("__s"))
    at = lambda k: F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(k * minutes).cast("int"))
    return made.select(*by, at(F.col("__s.start")).alias("run_start"), at(F.col("__s.start") + F.col("__s.length") - 1).alias("run_end"), F.col("__s.length").alias("slots"))


def gaps(df: DataFrame, by: list[str], minutes: int = 5) -> DataFrame:
    """Slots without a row between the first and the last row of each group: by..., timestamp.  Slots are made by day, in as many tasks as Spark likes."""
    seen = df.where(F.col("timestamp").isNotNull()).select(*by, "timestamp")
    span = seen.groupBy(*by).agg(F.min("timestamp").alias("__first"), F.max("timestamp").alias("__last"))
    days = span.select("*", F.explode(F.sequence(F.to_date("__first"), F.to_date("__last"))).alias("__day"))
    day, step = F.col("__day").cast("timestamp_ntz"), F.make_dt_interval(mins=F.lit(minutes))
    slots = days.select("*", F.explode(F.sequence(day, day + F.expr("INTERVAL 1 DAY") - step, step)).alias("timestamp"))
    expected = slots.where((F.col("timestamp") > F.col("__first")) & (F.col("timestamp") < F.col("__last"))).select(*by, "timestamp")
    return missing(expected, seen, by)
