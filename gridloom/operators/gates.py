"""Named checks and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def same_schema(found: T.StructType, wanted: T.StructType, nullability: bool = True) -> list[str]:
    """Differences in names, order, types and, if asked for, nullability."""
    out = []
    if found.names != wanted.names:
        return [f"columns are {found.names}, not {wanted.names}"]
    for a, b in zip(found, wanted, strict=True):
        if a.dataType != b.dataType:
            out.append(f"{a.name} is {a.dataType.simpleString()}, not {b.dataType.simpleString()}")
        if nullability and a.nullable != b.nullable:
            out.append(f"{a.name} is {'' if a.nullable else 'not '}nullable")
    return out


def checks(df: DataFrame, **conditions: Column) -> DataFrame:
    """Rows (check_name, passed): each condition is an aggregate over df, all in one pass."""
    one = df.agg(*[c.alias(n) for n, c in conditions.items()])
    listed = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(n), F.lit(False)).alias("passed")) for n in conditions])
    return one.select(F.explode(listed).alias("c")).select("c.*")


def all_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def verdict(report: DataFrame, observations: Column | None = None) -> DataFrame:
    """One row: PASS, PASS_WITH_OBSERVATIONS or FAIL, with the numbers of checks."""
    seen = F.lit(False) if observations is None else observations
    ok = F.coalesce(F.bool_and("passed"), F.lit(False))
    word = F.when(~ok, "FAIL").when(seen, "PASS_WITH_OBSERVATIONS").otherwise("PASS")
    return report.agg(F.count("*").alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed"), word.alias("verdict"))


def require(previous: str, wanted: str = "PASS_WITH_OBSERVATIONS") -> None:
    if previous != wanted:
        raise RuntimeError(f"the gate before says {previous}, not {wanted}")


def equal_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Members of one side only, as (member, side)."""
    x, y = (d.select(F.col(d.columns[0]).alias("member")).distinct() for d in (a, b))
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))
