"""What has been fetched and what is still to be: plans against manifests, hashes and retries."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Made = TypeVar("Made")


def to_fetch(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Each file of a manifest (name, sha256) with what to do, by the digests of the files that are there (name, sha256).

    skip: it is there and its content is as recorded; changed: it is there with
    another content; missing: it isn't there.  A row without a recorded hash is
    fetched again.  Only rows with ``fetch`` need work, so a run that is repeated
    after a failure goes on with what is left.
    """
    there = files.select("name", F.col("sha256").alias("found_sha256"))
    action = F.when(F.col("found_sha256").isNull(), "missing").when(F.col("found_sha256") == F.col("sha256"), "skip").otherwise("changed")
    return manifest.join(there, "name", "left").withColumn("action", action).withColumn("fetch", F.col("action") != "skip")


def with_retries(action: Callable[[], Made], attempts: int = 4, wait: float = 1.0, factor: float = 2.0, errors: tuple[type[Exception], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep) -> tuple[Made, int]:
    """The result of an action and how often it was tried again; after each of the errors it waits, factor times as long each time. The last error is raised."""
    if attempts < 1:
        raise ValueError("one attempt at least")
    for n in range(attempts):
        try:
            return action(), n
        except errors:
            if n + 1 == attempts:
                raise
            sleep(wait * factor**n)
    raise AssertionError
