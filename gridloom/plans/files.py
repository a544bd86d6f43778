"""Queries that write files or archives from the tables, in the cluster's shared folder, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ts_text
from ..operators import cleaning, gates, normalize
from ..schema import DEMAND, DISPATCH, STATE, UNIFIED, canonical
from ..sources import archive_source, archives, locate, readers, sinks
from ..sources.scratch import scratch
from ..sources.tables import signals
from ..streaming import collection, incremental
from .registry import query
from .scans import unified

ALL = "SELECT timestamp, source, generator_id, value_mw FROM unified"


@query(ALL)
def k01_partitioned_round_trip(spark, sf_dir):
    path = scratch(spark, "partitioned")
    u = unified(spark, sf_dir)
    sinks.write_partitioned(u, path)
    return readers.read_unified(spark, path).select(u.columns)


@query(ALL)
def k02_single_file(spark, sf_dir):
    path = scratch(spark, "single")
    sinks.write_single(unified(spark, sf_dir), path)
    return readers.read_unified(spark, path)


@query(ALL)
def k03_csv_round_trip(spark, sf_dir):
    """Several parts, each with its header, read back as typed rows."""
    path = scratch(spark, "csv")
    sinks.write_csv(unified(spark, sf_dir).repartition(4), path)
    return readers.read_csv(spark, path)


@query("SELECT strftime(timestamp, '%Y-%m') AS month, COUNT(*) AS n FROM unified GROUP BY 1")
def k03_months_resumed(spark, sf_dir):
    """Months as files; the second run finds the first one's and writes the rest."""
    path, u = scratch(spark, "months"), unified(spark, sf_dir)
    sinks.write_csv_months(u, path, ["2024-01"])
    sinks.write_csv_months(u, path, ["2023-12", "2024-01", "2024-02"])
    month = F.date_format("timestamp", "yyyy-MM").alias("month")
    return readers.read_csv(spark, f"{path}/month=*").groupBy(month).agg(F.count("*").alias("n"))


@query("SELECT timestamp, source, generator_id, value_mw FROM unified WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-08'")
def k04_csv_slice(spark, sf_dir):
    path = scratch(spark, "slice")
    sinks.write_slice(unified(spark, sf_dir), path, "2024-01-05 00:00:00", "2024-01-08 00:00:00")
    return readers.read_csv(spark, path)


@query(f"{ALL} WHERE source <> 'demand'")
def s18_typed_csv(spark, sf_dir):
    """Spark's own CSV, filtered as it is read (also K06)."""
    path = scratch(spark, "typed")
    sinks.write_csv_typed(unified(spark, sf_dir), path)
    return readers.read_csv(spark, path).where(F.col("source") != DEMAND)


@query("SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, source, coalesce(generator_id, '') AS generator_id FROM unified")
def s21_rows_of_texts(spark, sf_dir):
    path = scratch(spark, "texts")
    sinks.write_csv_typed(unified(spark, sf_dir), path)
    return readers.read_dicts(spark, path).select("timestamp", "source", "generator_id")


def manifests(spark, sf_dir) -> tuple[str, list]:
    """A manifest for each source, in a folder of its own: three small files of the driver's."""
    path = scratch(spark, "manifests")
    n = unified(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n")).orderBy("source").collect()  # a row for each source
    for r in n:
        sinks.write_json(spark, f"{path}/{r.source}/manifest.json", {"source": r.source, "rows": r.n, "status": "success"})
    return path, n


@query("SELECT source, COUNT(*) AS rows, 'success' AS status FROM unified GROUP BY 1")
def s20_manifests(spark, sf_dir):
    """Written one by one, whole or not at all (K05), and scanned together."""
    path, _ = manifests(spark, sf_dir)
    return readers.read_manifests(spark, path, "source string, rows long, status string")


TOTALS = "SELECT source, COUNT(*) AS n FROM unified GROUP BY 1"


@query(f"SELECT source || '.txt' AS name, strlen(source || ':' || n) AS bytes, sha256(source || ':' || n) AS sha256 FROM ({TOTALS})")
def s26_file_digests(spark, sf_dir):
    path = scratch(spark, "digests")
    for r in unified(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n")).collect():
        sinks.write_small(spark, f"{path}/{r.source}.txt", f"{r.source}:{r.n}".encode())
    return readers.file_digests(spark, path)


@query(f"SELECT source || '.txt' AS name, CASE source WHEN 'demand' THEN 'skip' WHEN 'dispatch' THEN 'changed' ELSE 'missing' END AS action, source <> 'demand' AS fetch FROM ({TOTALS})")
def x02_skip_existing(spark, sf_dir):
    """Of three files one is as recorded, one was changed, one isn't there."""
    path = scratch(spark, "fetched")
    n = unified(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    for r in n.where(F.col("source") != STATE).collect():
        sinks.write_small(spark, f"{path}/{r.source}.txt", f"{r.source}:{r.n if r.source == DEMAND else 0}".encode())
    manifest = n.select(F.concat("source", F.lit(".txt")).alias("name"), F.sha2(F.concat_ws(":", "source", "n").cast("binary"), 256).alias("sha256"))
    return collection.to_fetch(manifest, readers.file_digests(spark, path)).select("name", "action", "fetch")


@query(f"SELECT CAST(3 AS BIGINT) AS n_files, CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(10 * n) AS BIGINT) AS total_bytes, CAST(MAX(n) AS BIGINT) AS most_rows FROM ({TOTALS})")
def k08_release_manifest(spark, sf_dir):
    path = scratch(spark, "release")
    n = unified(spark, sf_dir).groupBy(F.col("source").alias("name")).agg(F.count("*").alias("rows"))
    sinks.write_manifest(n.select("name", "rows", (10 * F.col("rows")).alias("bytes"), F.sha2("name", 256).alias("sha256")), path)
    return spark.read.json(path).select("n_files", "total_rows", "total_bytes", F.array_max("files.rows").alias("most_rows"))


@query(ALL)
def k07_release_table(spark, sf_dir):
    """Released files: copied once, a second time not, and read as a release."""
    path, folder = scratch(spark, "built"), scratch(spark, "package")
    sinks.write_single(unified(spark, sf_dir), path)
    parts = [f for f in spark.read.parquet(path).inputFiles() if f.endswith(".parquet")]
    copied = sinks.package(spark, parts, folder)
    if len(copied) != len(parts) or sinks.package(spark, parts, folder):
        raise RuntimeError("files are copied once")
    return spark.read.parquet(folder)


@query(ALL)
def x01_incremental(spark, sf_dir):
    """Files that arrive in two runs are each taken once."""
    source, out, mark = (scratch(spark, n) for n in ("arriving", "taken", "mark"))
    u = unified(spark, sf_dir)
    for part in (F.col("source") == DEMAND, F.col("source") != DEMAND):
        u.where(part).write.mode("append").parquet(source)
        incremental.run_available(incremental.new_files(spark, source, spark.read.parquet(source).schema), out, mark)
    return spark.read.parquet(out)


# ---- archives: the tables as monthly attachments would hold them, an archive a day


def attachments(rows: DataFrame, signal: str) -> DataFrame:
    """Archives of one text each, a day's rows in it, in the form of the signal: (path, content)."""
    header, before, encoding = {
        DEMAND: ("TIME,LF05_1", "안내\n", "utf-8"), DISPATCH: ("TIME,GEN_CODE,BASEPOINT", "", "ascii"), STATE: ("시간,발전기CODE,상태추정MW", "자료, 설명\n\n", "cp949"),
    }[signal]
    half = F.when(F.hour("timestamp") < 12, "오전").otherwise("오후")
    korean = F.concat(F.date_format("timestamp", "yyyy-MM-dd "), half, F.date_format("timestamp", " h:mm:ss"))
    time = korean if signal == STATE else ts_text(F.col("timestamp"))
    cells = [time, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in canonical(signal).names[1:]]]
    lines = rows.select(F.date_format("timestamp", "yyyy-MM-dd").alias("path"), F.concat_ws(",", *cells).alias("line"))
    return archives.packed(lines, f"{signal}.txt", f"{before}{header}\n", encoding)


def read_attachments(spark, sf_dir, signal: str) -> DataFrame:
    names = canonical(signal).names
    texts = archives.decoded(attachments(signals(spark, sf_dir)[signal], signal), signal)
    return normalize.normalize(signal, texts.select(*[f"c{i}" for i in range(len(names))]))


@query("SELECT * FROM demand")
def s08_demand_archives(spark, sf_dir):
    return read_attachments(spark, sf_dir, DEMAND)


@query("SELECT * FROM dispatch")
def s09_dispatch_archives(spark, sf_dir):
    return read_attachments(spark, sf_dir, DISPATCH)


@query("SELECT * FROM state")
def s01_state_archives(spark, sf_dir):
    """CP949, lines before the header, and times with morning and afternoon."""
    return read_attachments(spark, sf_dir, STATE)


@query("SELECT strftime(timestamp, '%Y-%m-%d') AS path, 'state_estimation.txt' AS member, 'cp949' AS encoding, CAST(2 AS INTEGER) AS preamble_rows, COUNT(*) AS n FROM state GROUP BY 1")
def s05_headers_found(spark, sf_dir):
    texts = archives.decoded(attachments(signals(spark, sf_dir)[STATE], STATE), STATE)
    return texts.groupBy("path", "member", "encoding", "preamble_rows").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT strftime(timestamp, '%Y-%m-%d') AS path, 'dispatch.txt' AS member, 'text' AS format, 'ascii' AS encoding, CAST(NULL AS VARCHAR) AS problem FROM dispatch")
def s23_probe(spark, sf_dir):
    """Also S27: checksums of members."""
    found = archives.probed(attachments(signals(spark, sf_dir)[DISPATCH], DISPATCH), DISPATCH)
    return found.select("path", "member", "format", "encoding", "problem")


@query("SELECT * FROM dispatch WHERE timestamp >= TIMESTAMP '2024-01-15'")
def s01_archive_source(spark, sf_dir):
    """Archives of days as files, read by the data source: two signals below one folder; the filters on signal and month choose which are opened."""
    folder = scratch(spark, "archives")
    for signal in (DISPATCH, STATE):
        made = attachments(signals(spark, sf_dir)[signal], signal)
        half = F.when(F.substring("path", 9, 2) < "15", "2023-12-as-").otherwise("")  # names tell another month of the first half
        archive_source.write_archives(made.select(F.concat(half, "path").alias("path"), "content"), f"{folder}/{signal}")
    rows = archive_source.load(spark, folder).where((F.col("signal") == DISPATCH) & (F.col("month") >= "2024-01"))
    return normalize.normalize(DISPATCH, rows.select("c0", "c1", "c2"))


@query("SELECT * FROM state")
def g01_table_function(spark, sf_dir):
    """The decoder in SQL, as a table function over the files that binaryFile reads."""
    folder = scratch(spark, "archives")
    archive_source.write_archives(attachments(signals(spark, sf_dir)[STATE], STATE), folder)
    archive_source.register_function(spark)
    archives.archives(spark, folder).createOrReplaceTempView("gridloom_archives")
    rows = spark.sql(f"SELECT c0, c1, c2 FROM signal_rows(TABLE(SELECT path, content, '{STATE}' AS signal FROM gridloom_archives))")
    return normalize.normalize(STATE, rows)


@query("""SELECT DISTINCT strftime(timestamp, '%Y-%m-%d') AS path, 'state_estimation.txt' AS member, 'text' AS kind, 'cp949' AS encoding, '자료, 설명' AS first, '' AS second, '시간,발전기CODE,상태추정MW' AS third, CAST(NULL AS VARCHAR) AS problem FROM state""")
def s24_structure(spark, sf_dir):
    """What raw archives look like: encoding and first lines of each member."""
    found = locate.structure(attachments(signals(spark, sf_dir)[STATE], STATE))
    return found.select("path", "member", "kind", "encoding", *[F.col("preview")[i].alias(n) for i, n in enumerate(("first", "second", "third"))], "problem")


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type", signals=False)
def s25_located(spark, sf_dir):
    """The events, wherever they lie below a folder."""
    where, _, last = sf_dir.rstrip("/").rpartition("/")
    folder = locate.locate(spark, last, roots=[where])
    return spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))


# ---- gates that raise


@query("SELECT DISTINCT timestamp, generator_id, dispatch_mw FROM dispatch")
def q03_exact_duplicates_go(spark, sf_dir):
    d = signals(spark, sf_dir)[DISPATCH]
    return cleaning.dedup_exact(d.unionByName(d), d.columns)


@query("WITH g AS (SELECT timestamp FROM dispatch GROUP BY timestamp HAVING COUNT(*) = COUNT(DISTINCT generator_id)) SELECT * FROM dispatch WHERE timestamp <> (SELECT MIN(timestamp) FROM g)")
def q04_ambiguous_snapshot_goes(spark, sf_dir):
    """The first slot whose generators are there once is given a second time with other values, and goes by the catalogue, with evidence."""
    d = signals(spark, sf_dir)[DISPATCH]
    once = d.groupBy("timestamp").agg(F.count("*").alias("n"), F.count_distinct("generator_id").alias("keys")).where("n = keys")
    first = once.orderBy("timestamp").first()
    again = d.where(F.col("timestamp") == F.lit(first.timestamp)).withColumn("dispatch_mw", F.col("dispatch_mw") + 1)
    item = {"source": DISPATCH, "month": "2024-01", "action": "drop_ambiguous_duplicate_timestamp", "timestamps": [first.timestamp.isoformat()], "evidence": {"rows_at_timestamp": 2 * first.n, "unique_candidate_keys": first.n, "conflicting_candidate_keys": first.n}}
    return cleaning.apply_exceptions(d.unionByName(again), ["timestamp", "generator_id"], "dispatch_mw", DISPATCH, "2024-01", [item])[0]


@query("SELECT * FROM (VALUES ('unified', CAST(0 AS BIGINT)), ('demand', 1), ('dispatch', 1)) t(name, differences)", signals=False)
def q01_schemas(spark, sf_dir):
    """Differences of schemas from the unified one: of the unified table, read back, none; of the signals', their names."""
    u, t = unified(spark, sf_dir), signals(spark, sf_dir)
    n = [("unified", len(gates.same_schema(u.schema, UNIFIED, nullability=False))), *[(s, len(gates.same_schema(t[s].schema, UNIFIED))) for s in (DEMAND, DISPATCH)]]
    return spark.createDataFrame(n, "name string, differences long")


@query("WITH v AS (SELECT COUNT(*) FILTER (value_mw > 400) > 0 AS observed, COUNT(*) > 0 AS passed FROM unified) SELECT CASE WHEN NOT passed THEN 'FAIL' WHEN observed THEN 'PASS_WITH_OBSERVATIONS' ELSE 'PASS' END AS before, COALESCE(passed AND observed, FALSE) AS goes_on FROM v")
def q07_chained_gate(spark, sf_dir):
    """A gate that opens only after a verdict with observations."""
    u = unified(spark, sf_dir)
    report = gates.checks(u, has_rows=F.count("*") > 0).crossJoin(F.broadcast(u.agg((F.count_if(F.col("value_mw") > 400) > 0).alias("observed"))))
    before = gates.verdict(report, F.bool_or("observed")).first().verdict
    try:
        gates.require(before)
        goes_on = True
    except RuntimeError:
        goes_on = False
    return spark.createDataFrame([(before, goes_on)], "before string, goes_on boolean")
