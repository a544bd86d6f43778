"""Queries over footers, row groups and physical files."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import two_places
from ..operators import physical
from ..schema import DISPATCH
from ..sources import export, footers, readers
from ..sources.scratch import scratch
from ..sources.storage import store
from ..sources.tables import signals
from .registry import query
from .scans import unified

KEYS = {"customer": "c_custkey", "events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey", "part": "p_partkey"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, CAST(MIN({k}) AS DOUBLE) AS least, CAST(MAX({k}) AS DOUBLE) AS most, COUNT(*) - COUNT({k}) AS nulls FROM {t}" for t, k in KEYS.items()), signals=False)
def s15_footers(spark, sf_dir):
    """Counts and ends of keys without a page being read."""
    made = [footers.summed(footers.row_groups(footers.files(spark, f"{sf_dir}/{t}.parquet")), k).select(F.lit(t).alias("table_name"), "*") for t, k in KEYS.items()]
    return reduce(DataFrame.unionByName, made)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey BETWEEN 2000 AND 9000", signals=False)
def s14_batch_scan(spark, sf_dir):
    """Row groups that may hold the range, in batches of 10,000 rows."""
    rows = footers.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], "l_orderkey", 2000, 9000, batch_rows=10_000)
    return rows.where(F.col("l_orderkey").between(2000, 9000))


def released(rows: DataFrame, folder: str) -> DataFrame:
    """Writes a day's rows as a file each, and returns the manifest; then spoils some files, by the day of the month."""

    def run(key, group):
        day = key[0].as_py()
        where, inner = store(folder)
        where.create_dir(inner, recursive=True)
        name, data = f"{day}.parquet", group.drop(["day"]).sort_by([("timestamp", "ascending"), ("generator_id", "ascending")])

        def put(to: str, content: bytes) -> None:
            with where.open_output_stream(f"{inner}/{to}") as f:
                f.write(content)

        def bytes_of(table: pa.Table) -> bytes:
            out = pa.BufferOutputStream()
            pq.write_table(table, out)
            return out.getvalue().to_pybytes()

        content, fault = bytes_of(data), int(day[-2:]) % 7
        said = "; ".join(f"{f.name} {f.type}" for f in data.schema)
        kept = {2: content[:-10], 3: content[:60] + bytes([content[60] ^ 1]) + content[61:], 4: bytes_of(data.set_column(2, "dispatch_mw", data["dispatch_mw"].cast(pa.float32())))}.get(fault, content)
        if fault != 1:
            put(name, kept)
        if fault == 5:
            put(f"{name}.part", content[:100])
        if fault == 6:
            put(f"copy of {name}", content)
        return pa.table({"name": [name], "bytes": [len(content)], "sha256": [hashlib.sha256(content).hexdigest()], "rows": [data.num_rows], "schema": [said]})

    dated = rows.select(F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "timestamp", "generator_id", "dispatch_mw")
    return dated.groupBy("day").applyInArrow(run, "name string, bytes long, sha256 string, rows long, schema string")


FAULTS = "(VALUES (1, '', 'missing'), (2, '', 'size'), (2, '', 'digest'), (2, '', 'unreadable'), (3, '', 'digest'), (4, '', 'size'), (4, '', 'digest'), (4, '', 'schema'), (5, '.part', 'left over'), (6, 'copy of ', 'unexpected')) f(fault, more, problem)"


@query(f"""WITH d AS (SELECT DISTINCT strftime(timestamp, '%Y-%m-%d') AS day FROM dispatch)
SELECT CASE WHEN fault = 6 THEN more ELSE '' END || day || '.parquet' || CASE WHEN fault = 5 THEN more ELSE '' END AS name, problem FROM d JOIN {FAULTS} ON CAST(right(day, 2) AS INTEGER) % 7 = fault""")
def j10_physical_files(spark, sf_dir):
    """A release of a file a day whose files are missing, cut, changed, of another schema, left over or unexpected (also Q08, Q10)."""
    folder = scratch(spark, "release")
    manifest = spark.createDataFrame(released(signals(spark, sf_dir)[DISPATCH], folder).collect(), "name string, bytes long, sha256 string, rows long, schema string")  # a row a day
    return physical.problems(manifest, physical.inventory(spark, folder))


@query("SELECT source, COUNT(*) AS rows, COUNT(*) AS rows_read FROM unified GROUP BY source")
def k03_export_resumed(spark, sf_dir):
    """An export of twenty batches whose first run breaks off; the second writes what is missing. Rows by the writers' records, and as read back."""
    path, u = scratch(spark, "export"), unified(spark, sf_dir)
    late = F.col("timestamp") >= F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    broken = u.withColumn("generator_id", F.when(late, F.raise_error(F.lit("the first run ends here"))).otherwise(F.col("generator_id")))
    try:
        export.export(broken, path, 20)
        raise RuntimeError("the first run was to break off")
    except Exception as e:
        if "the first run ends here" not in str(e):
            raise
    records = export.export(u, path, 20)
    said = records.select(F.explode("by_source").alias("source", "n")).groupBy("source").agg(F.sum("n").alias("rows"))
    lines = spark.read.schema("timestamp timestamp_ntz, source string, generator_id string, value_mw double").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{path}/part-*.csv")
    return said.join(lines.groupBy("source").agg(F.count("*").alias("rows_read")), "source")


LINE_SQL = """'"' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '","' || source || '",' || coalesce('"' || generator_id || '"', '') || ',' || coalesce(CAST(CAST(value_mw AS DECIMAL(18,2)) AS VARCHAR), '')"""


@query(f"""WITH l AS (SELECT string_agg({LINE_SQL}, chr(10) ORDER BY timestamp, source, generator_id NULLS FIRST, CAST(value_mw AS DECIMAL(18,2)) NULLS FIRST) || chr(10) AS text, COUNT(*) AS rows FROM unified WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-08')
SELECT rows, strlen(text) AS bytes, sha256(text) AS sha256 FROM l""")
def k04_slice_digest(spark, sf_dir):
    """A time slice as one file, with rows, bytes and SHA-256 as the task that wrote it says."""
    u = readers.load_window(unified(spark, sf_dir), None, "2024-01-05 00:00:00", "2024-01-08 00:00:00", ["timestamp", "source", "generator_id", "value_mw"])
    records = export.export(u.withColumn("value_mw", two_places(F.col("value_mw"))), scratch(spark, "slice"), 1)
    return records.select("rows", "bytes", "sha256")
