"""Load shape, reconciliation of signals, concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import exact_sum, share
from .selection import quantiles


def by_timestamp(df: DataFrame, value: str, prefix: str) -> DataFrame:
    """Sum and count of present values at each timestamp."""
    rows = df.where(F.col("timestamp").isNotNull() & F.col(value).isNotNull())
    return rows.groupBy("timestamp").agg(exact_sum(F.col(value)).alias(f"{prefix}_mw"), F.count("*").alias(f"{prefix}_rows"))


def daily_shape(demand: DataFrame, value: str) -> DataFrame:
    c = F.col(value)
    rows = demand.where(F.col("timestamp").isNotNull() & c.isNotNull())
    made = rows.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("n"), F.min(c).alias("min_mw"), F.avg(c).alias("mean_mw"), F.max(c).alias("max_mw"))
    return made.withColumn("peak_to_trough_mw", F.col("max_mw") - F.col("min_mw"))


def reconcile(demand: DataFrame, dispatch: DataFrame, state: DataFrame) -> DataFrame:
    """Three signals side by side at each timestamp of any of them, with their differences. Identifiers of two signals never meet."""
    d = demand.where("timestamp IS NOT NULL").select("timestamp", F.col("demand_forecast_mw").alias("demand_mw"))
    p, s = by_timestamp(dispatch, "dispatch_mw", "dispatch"), by_timestamp(state, "estimated_generation_mw", "state")
    joined = d.join(p, "timestamp", "full").join(s, "timestamp", "full")
    less = lambda a, b: (F.col(f"{a}_mw") - F.col(f"{b}_mw")).alias(f"{a}_minus_{b}")
    return joined.select("*", less("dispatch", "demand"), less("state", "demand"), less("state", "dispatch"))


def generator_summary(df: DataFrame, value: str) -> DataFrame:
    c = F.col(value)
    rows = df.where(F.col("generator_id").isNotNull() & c.isNotNull())
    return rows.groupBy("generator_id").agg(F.count("*").alias("n"), F.avg(c).alias("mean_mw"), F.max(c).alias("max_mw"), exact_sum(c).alias("sum_mw"))


def with_shares(summary: DataFrame, value: str = "sum_mw") -> DataFrame:
    """Adds total and share (per cent). One row for each generator: the total is one aggregate, joined back as a single row."""
    total = summary.agg(exact_sum(F.col(value)).alias("total_mw"))
    return summary.join(F.broadcast(total)).withColumn("share_pct", share(F.col(value), F.col("total_mw")))


def hhi(summary: DataFrame, value: str = "sum_mw") -> DataFrame:
    """The Herfindahl-Hirschman index: the sum of squared shares, times 10,000."""
    shares = with_shares(summary, value)
    return shares.agg(F.sum(F.pow(F.col("share_pct") / 100, 2)).alias("x")).select((F.col("x") * 10000).alias("hhi"))


def difference_summary(pairs: DataFrame, difference: str) -> DataFrame:
    """One row: how many, mean, median, mean of absolute values, and quantiles; null where nothing is to be summed up."""
    c = F.col(difference)
    some = pairs.where(c.isNotNull())
    sums = some.agg(F.count("*").alias("n"), F.avg(c).alias("mean"), F.avg(F.abs(c)).alias("mae"))
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("quantile")))
    found = quantiles(some, difference, [0.01, 0.5, 0.99]).agg(at(0.5).alias("median"), at(0.01).alias("q01"), at(0.5).alias("q50"), at(0.99).alias("q99"))
    return sums.join(F.broadcast(found)).select("n", "mean", "median", "mae", "q01", "q50", "q99")


def spread(long: DataFrame, by: str, value: str) -> DataFrame:
    """For each group: how many values, mean, median, least and largest."""
    c = F.col(value)
    sums = long.groupBy(by).agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"))
    return sums.join(quantiles(long, value, [0.5], [by]).select(by, F.col("quantile").alias("median")), by, "left")


def jaccard(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes, overlap and similarity of two sets of identifiers."""
    left = a.where(F.col(key).isNotNull()).select(key).distinct().withColumn("a", F.lit(1))
    right = b.where(F.col(key).isNotNull()).select(key).distinct().withColumn("b", F.lit(1))
    both = left.join(right, key, "full")
    count = lambda c: F.count_if(c)
    in_a, in_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    made = both.agg(count(in_a).alias("size_a"), count(in_b).alias("size_b"), count(in_a & in_b).alias("overlap"), count(in_a & ~in_b).alias("only_a"), count(~in_a & in_b).alias("only_b"), F.count("*").alias("__all"))
    return made.withColumn("jaccard", F.when(F.col("__all") > 0, F.col("overlap") / F.col("__all"))).drop("__all")


def min_max(df: DataFrame, value: str, by: list[str], floor: float = 1.0) -> DataFrame:
    """Values of each group between 0 and 1, over a range of at least floor. Groups' ends are aggregated and joined back, so a large group isn't gathered in one task."""
    ends = df.groupBy(*by).agg(F.min(value).alias("__low"), F.max(value).alias("__high")).select(*[F.col(b).alias(f"__{b}") for b in by], "__low", "__high")
    same = [df[b].eqNullSafe(ends[f"__{b}"]) for b in by]
    joined = df.join(ends, same, "left") if by else df.join(F.broadcast(ends))
    scaled = (F.col(value) - F.col("__low")) / F.greatest(F.col("__high") - F.col("__low"), F.lit(floor))
    return joined.select(*[df[c] for c in df.columns], scaled.alias("normalized"))
