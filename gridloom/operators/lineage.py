"""Roll-ups over source-months, manifests and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals(df: DataFrame, by: str, **sums: Column) -> DataFrame:
    """Sums for each value of a column and for all rows (null), in one pass."""
    return df.rollup(by).agg(*[c.alias(name) for name, c in sums.items()])


def missingness(units: DataFrame, by: str, unit: str, missing: str) -> DataFrame:
    """For each source: units, those with missing slots, all missing slots, the most in one unit and the first unit with that many."""
    m = F.col(missing)
    worst = F.min(F.struct((-m).alias("n"), F.col(unit).alias("unit")))
    made = units.groupBy(by).agg(F.count("*").alias("units"), F.count_if(m > 0).alias("units_with_missing"), F.sum(m).cast("long").alias("missing_slots"), F.max(m).alias("max_missing"), worst.alias("w"))
    return made.select(by, "units", "units_with_missing", "missing_slots", "max_missing", F.col("w.unit").alias("worst_unit"))


def left_default(detail: DataFrame, other: DataFrame, keys: list[str], column: str, default) -> DataFrame:
    """A left join in which an absent partner counts as a default."""
    return detail.join(other.select(*keys, column), keys, "left").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def plan(months: DataFrame, sources: DataFrame, index: DataFrame) -> DataFrame:
    """Every month of every source, with whether the index has it. Both sides of the product are dimensions of a few hundred rows."""
    wanted = months.crossJoin(sources)
    found = index.select("source", "month").distinct().withColumn("__there", F.lit(True))
    status = F.when(F.col("__there"), "found").otherwise("missing_post")
    return wanted.join(found, ["source", "month"], "left").select("source", "month", status.alias("status"))


def reconcile_files(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join of (name, bytes): missing, unexpected, size_mismatch or ok."""
    e, a = expected.select("name", F.col("bytes").alias("expected_bytes")), actual.select("name", F.col("bytes").alias("actual_bytes"))
    status = F.when(F.col("actual_bytes").isNull(), "missing").when(F.col("expected_bytes").isNull(), "unexpected").when(F.col("actual_bytes") != F.col("expected_bytes"), "size_mismatch").otherwise("ok")
    return e.join(a, "name", "full").withColumn("status", status)


def grouped_lists(df: DataFrame, key: str, member: str) -> DataFrame:
    """Each signature with its members in order, comma-joined."""
    return df.groupBy(key).agg(F.count_distinct(member).alias("n"), F.array_join(F.array_sort(F.collect_set(member)), ",").alias("members"))


def size_projection(bytes_per_month: DataFrame, horizons: dict[str, int]) -> DataFrame:
    """Linear growth: bytes of one month (column bytes) times months, in GB of three decimals."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("horizon"), F.lit(v).alias("months")) for k, v in horizons.items()]))
    made = bytes_per_month.select("bytes", rows.alias("h")).select("h.horizon", "h.months", (F.col("bytes") * F.col("h.months")).alias("projected_bytes"))
    return made.withColumn("projected_gb", F.round(F.col("projected_bytes") / 1e9, 3))
