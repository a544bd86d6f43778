"""Exact quantiles by radix selection.

A double is read as a whole number of 64 bits in the same order (its IEEE bits, the
sign apart), and ranks are found digit by digit: a histogram of the first digit tells
which digit holds a wanted rank; only values with that digit are counted by the next
one.  Histograms are added up in each task before they are shuffled, so values that
don't hold a rank never leave their task, wherever they crowd and however far out a
few of them lie.  When few enough values are left, or no digit is, they are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits below each digit: digits of 22, 21 and 21 bits.
SHIFTS = (42, 21, 0)
#: Values of one digit that are ranked in one task, or this part of all of a group's.
FEW, SHARE = 2048, 2000
#: Digits in play that come to the driver, as a table that later passes are joined with; beyond that they stay where they are and all passes are made.
LOCAL = 20_000


def ordered_bits(x: Column) -> Column:
    """A long for each finite double, in the same order; both zeros are 0.

    The exponent's bits, then those of the fraction, as IEEE has them.  A logarithm
    that rounds up beside a power of two costs the last bit there, never the order.
    """
    a = F.abs(x)
    e = F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1023))
    bits = (e + 1023).cast("long") * (1 << 52) + F.floor((a / F.pow(F.lit(2.0), e) - 1) * float(1 << 52)).cast("long")
    return F.when(a == 0, F.lit(0).cast("long")).when(x < 0, -bits).otherwise(bits)


def _first(values: DataFrame, probabilities: list[float], shift: int) -> DataFrame:
    """The first pass: of each rank that is wanted, the digit that holds it, from one histogram of each group.

    g, rank, total (values of the group), prefix (digits so far), before (values below them), size (values with them).
    """
    sizes = values.groupBy("g", F.shiftright("key", shift).alias("prefix")).agg(F.count("*").alias("size"))
    group = Window.partitionBy("g")
    ends = sizes.withColumn("end", F.sum("size").over(group.orderBy("prefix"))).withColumn("total", F.sum("size").over(group))
    at = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    ranks = F.array_distinct(F.array(*[side(at(p)) for p in probabilities for side in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("size")))
    return ends.select("g", F.explode(here).alias("rank"), "total", "prefix", (F.col("end") - F.col("size")).alias("before"), "size")


def _narrowed(values: DataFrame, sought: DataFrame, shift: int, last: int, small) -> DataFrame:
    """A further pass: the values that share their digits so far with a rank are counted by the next digit. small: broadcasts digits in play that are known to be few."""
    above = sought.select("g", F.col("prefix").alias("above")).distinct()
    some = values.select("g", F.shiftright("key", shift).alias("digit"), F.shiftright("key", last).alias("above")).join(small(above), ["g", "above"], "left_semi")
    sizes = some.groupBy("g", "above", "digit").agg(F.count("*").alias("size"))
    ends = sizes.withColumn("end", F.sum("size").over(Window.partitionBy("g", "above").orderBy("digit")))
    at = F.col("rank") - F.col("before")
    joined = sought.drop("size").withColumnRenamed("prefix", "above").join(ends, ["g", "above"]).where((at < F.col("end")) & (at >= F.col("end") - F.col("size")))
    return joined.select("g", "rank", "total", F.col("digit").alias("prefix"), (F.col("before") + F.col("end") - F.col("size")).alias("before"), "size")


def quantiles(df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation over finite values: rows (by..., probability, quantile).

    A group without finite values has no rows; nulls are a group.  Runs up to three
    jobs, of which the driver sees the digits in play.
    """
    c, names = F.col(value).cast("double"), by or []
    group = F.struct(*names) if names else F.struct(F.lit(0).alias("all"))
    finite = df.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    values = finite.select(group.alias("g"), c.alias("v")).withColumn("key", ordered_bits(F.col("v")))
    last, small = None, lambda d: d
    for shift in SHIFTS:
        sought = _first(values, probabilities, shift) if last is None else _narrowed(values, sought, shift, last, small)
        last = shift
        rows = sought.limit(LOCAL + 1).collect()
        small = F.broadcast if len(rows) <= LOCAL else lambda d: d
        if len(rows) > LOCAL:
            continue
        sought = df.sparkSession.createDataFrame(rows, sought.schema)
        if all(r["size"] <= max(FEW, r["total"] // SHARE) for r in rows):
            break
    left = values.select("g", "v", F.shiftright("key", last).alias("prefix")).join(small(sought.select("g", "prefix").distinct()), ["g", "prefix"], "left_semi")
    counts = left.groupBy("g", "prefix", "v").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("to", F.sum("n").over(Window.partitionBy("g", "prefix").orderBy("v")))
    here = F.col("rank") - F.col("before")
    found = ranked.join(small(sought), ["g", "prefix"]).where((here < F.col("to")) & (here >= F.col("to") - F.col("n")))
    each = found.select("g", "rank", "v", "total", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"))
    each = each.withColumn("at", F.col("probability") * (F.col("total") - 1))
    each = each.where((F.col("rank") == F.floor("at")) | (F.col("rank") == F.ceil("at")))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    made = each.groupBy("g", "probability", "at").agg((low + (high - low) * (F.col("at") - F.floor("at"))).alias("quantile"))
    return made.select(*[F.col(f"g.{n}").alias(n) for n in names], "probability", "quantile")
