"""Queries by name, with the DuckDB SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The signals, as sources.tables makes them.
SIGNALS_SQL = """
e AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS timestamp, event_type, user_id, value FROM events),
demand AS (SELECT timestamp, CAST(SUM(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS demand_forecast_mw FROM e WHERE event_type = 'view' GROUP BY timestamp),
dispatch AS (SELECT timestamp, CAST(user_id AS VARCHAR) AS generator_id, value AS dispatch_mw FROM e WHERE event_type IN ('click', 'purchase')),
state AS (SELECT timestamp, 'IJ' || user_id AS generator_id, value AS estimated_generation_mw FROM e WHERE event_type IN ('signup', 'error')),
unified AS (
  SELECT timestamp, 'demand' AS source, CAST(NULL AS VARCHAR) AS generator_id, demand_forecast_mw AS value_mw FROM demand
  UNION ALL SELECT timestamp, 'dispatch', generator_id, dispatch_mw FROM dispatch
  UNION ALL SELECT timestamp, 'state_estimation', generator_id, estimated_generation_mw FROM state),
ship AS (SELECT l_shipdate AS timestamp, 'S' || l_suppkey AS generator_id, l_quantity AS value_mw FROM lineitem)
"""


def query(sql: str | None = None, signals: bool = True):
    """Registers a function as the query of its name. signals: whether the SQL is given the tables of SIGNALS_SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            text = sql.strip()
            if signals:
                text = f"WITH {SIGNALS_SQL}, {text[5:]}" if text.startswith("WITH ") else f"WITH {SIGNALS_SQL} {text}"
            ORACLE_SQL[f.__name__] = text
        return f

    return register
