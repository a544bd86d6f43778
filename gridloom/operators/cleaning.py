"""Duplicates, ambiguous snapshots and the gates around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def duplicate_members(df: DataFrame, keys: list[str]):
    """One row: rows that share their key with another, and rows beyond the first of each key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("members"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra")
    )


def conflicts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each key with its rows and its number of different values, null being one."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), (F.count_distinct(value) + F.max(F.col(value).isNull().cast("int"))).alias("n_values"))


class GateError(RuntimeError):
    pass


def dedup_exact(df: DataFrame, keys: list[str]) -> DataFrame:
    """Full-row duplicates go, provided that every duplicate of a key is one; else an error.

    One aggregation by all columns, of which another by key is made: the counts
    come to the driver, rows don't.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    by_key = rows.groupBy(*keys).agg(F.sum("__n").alias("n"), F.count("*").alias("different"))
    key_extra, row_extra = by_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)), F.coalesce(F.sum(F.col("n") - F.col("different")), F.lit(0))).first()
    if key_extra != row_extra:
        raise GateError(f"{key_extra} duplicates by key, but {row_extra} by row: keys {keys} have different values")
    return rows.drop("__n")


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__at", F.row_number().over(w)).where("__at = 1").drop("__at")


def _drop_ambiguous(df: DataFrame, keys: list[str], value: str, item: dict) -> tuple[DataFrame, list[dict]]:
    """Removes whole snapshots in which every key stands exactly twice, some with different values, if that is as recorded."""
    stamps = item.get("timestamps", [])
    at = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    wanted = [s.replace("T", " ") for s in stamps]
    seen = conflicts(df.where(at.isin(*wanted)) if wanted else df.limit(0), keys, value).withColumn("__at", at)
    sums = seen.groupBy("__at").agg(
        F.sum("n").alias("rows"), F.count("*").alias("keys"), F.sum((F.col("n_values") > 1).cast("long")).alias("conflicting"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    found = {r["__at"]: r for r in sums.collect()}  # a row for each timestamp of the catalogue
    evidence, done = item.get("evidence", {}), []
    for stamp, text in zip(stamps, wanted, strict=True):
        r = found.get(text)
        if r is None:
            raise GateError(f"{stamp} is in the catalogue, but no rows are at it")
        if (r["least"], r["most"]) != (2, 2):
            raise GateError(f"{stamp}: not every key stands there twice")
        if not r["conflicting"]:
            raise GateError(f"{stamp}: both rows of every key are equal")
        for name, now in (("rows_at_timestamp", r["rows"]), ("unique_candidate_keys", r["keys"]), ("conflicting_candidate_keys", r["conflicting"])):
            if evidence.get(name) is not None and int(evidence[name]) != now:
                raise GateError(f"{stamp}: {name} is {now}, the catalogue says {evidence[name]}")
        done.append(
            {"action": item["action"], "timestamp": stamp, "rows_removed": r["rows"], "unique_candidate_keys": r["keys"], "conflicting_candidate_keys": r["conflicting"],
             "exact_candidate_keys": r["keys"] - r["conflicting"], "reason": item.get("reason"), "evidence": evidence}
        )
    return df.where(~at.isin(*wanted) | F.col("timestamp").isNull()) if wanted else df, done


ACTIONS = {"drop_ambiguous_duplicate_timestamp": _drop_ambiguous}


def apply_exceptions(df: DataFrame, keys: list[str], value: str, source: str, month: str, catalogue: list[dict]) -> tuple[DataFrame, list[dict]]:
    """Applies the catalogue's exceptions of a source and month; returns what is left and the lineage of what went."""
    done: list[dict] = []
    for item in catalogue:
        if (item.get("source"), item.get("month")) == (source, month):
            action = ACTIONS.get(item.get("action"))
            if action is None:
                raise GateError(f"{source} {month}: nothing is known to do for {item.get('action')!r}")
            df, new = action(df, keys, value, item)
            done += new
    return df, done


def drop_timestamps(df: DataFrame, stamps: DataFrame) -> DataFrame:
    """Rows at none of the given timestamps; stamps is small and its size is Spark's to judge."""
    return df.join(stamps.select("timestamp").distinct(), "timestamp", "left_anti")


def blank_ids(df: DataFrame, column: str = "generator_id") -> DataFrame:
    return df.where(F.col(column).isNull() | (F.trim(column) == ""))


def numeric_quality(df: DataFrame, value: str) -> DataFrame:
    """One row of counters; zero and negative values are counted, not removed."""
    c = F.col(value)
    inf = float("inf")
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(c.isNull()).alias("n_null"), F.count_if(F.isnan(c)).alias("n_nan"), F.count_if(c == inf).alias("n_pos_inf"),
        F.count_if(c == -inf).alias("n_neg_inf"), F.count_if(finite & (c < 0)).alias("n_negative"), F.count_if(finite & (c == 0)).alias("n_zero"), F.count_if(finite).alias("n_finite"),
    )
