"""The signals over the driver's tables: a stand-in for published power data of the same shape.

Events become five-minute signals: views, summed, are demand; clicks and purchases
are dispatch of a generator for each user; sign-ups and errors are state estimates,
under identifiers of another name space.  Line items, whose shipping days stand for
slots and suppliers for generators, give volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import exact_sum, slot
from ..operators.rules import marked
from ..schema import DEMAND, DISPATCH, STATE, canonical


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _named(rows: DataFrame, signal: str) -> DataFrame:
    """Marked columns under the names of the signal's table."""
    return rows.toDF(*canonical(signal).names)


def demand(events: DataFrame) -> DataFrame:
    views = events.where("event_type = 'view'").groupBy(slot(F.col("ts")).alias("timestamp"))
    return _named(views.agg(marked(exact_sum(F.col("value")), "value", DEMAND)), DEMAND)


def dispatch(events: DataFrame) -> DataFrame:
    rows = events.where("event_type IN ('click', 'purchase')")
    return _named(rows.select(slot(F.col("ts")).alias("timestamp"), marked(F.col("user_id").cast("string"), "identifier", DISPATCH), marked(F.col("value"), "value", DISPATCH)), DISPATCH)


def state_estimation(events: DataFrame) -> DataFrame:
    rows = events.where("event_type IN ('signup', 'error')")
    return _named(rows.select(slot(F.col("ts")).alias("timestamp"), marked(F.concat(F.lit("IJ"), F.col("user_id")), "identifier", STATE), marked(F.col("value"), "value", STATE)), STATE)


def signals(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = table(spark, sf_dir, "events")
    return {DEMAND: demand(events), DISPATCH: dispatch(events), STATE: state_estimation(events)}


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a long table by day."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_shipdate").alias("timestamp"), F.concat(F.lit("S"), F.col("l_suppkey")).alias("generator_id"), F.col("l_quantity").alias("value_mw"))
