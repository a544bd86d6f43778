from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    made = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def comparable(rows, columns) -> list:
    """Rows with columns by name, in an order of their own; doubles to nine digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [str(x) for x in r])


def agrees(spark, duck, query, sql, data: str = DATA) -> None:
    df = query(spark, data)
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable([tuple(r) for r in df.collect()], df.columns) == comparable(cursor.fetchall(), columns)
