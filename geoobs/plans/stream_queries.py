"""Streaming twins run to the end of the landed files (H).

The streamed table is read as a file stream, written in append mode to the shared folder, and the
written table is the result.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import sinks
from ..streaming import ingest, report, rescan
from ..streaming import sessions as stream_sessions
from . import adapters as A
from .registry import Tables, query

# Silence that ends a session of the closing stream.
IDLE = 300


class _Stream(Tables):
    """The same tables as streams; watermarks need zoned timestamps (the session runs in UTC).

    ``slices`` maps a table to the expression of a slice number: slices come in ascending order, each
    as one micro-batch or several.
    """

    def __init__(self, t: Tables, **slices):
        super().__init__(t.spark, t.sf_dir)
        self.slices, self.landed = slices, {}

    def __getattr__(self, name: str) -> DataFrame:
        static = super().__getattr__(name)
        if name in self.slices:
            if name not in self.landed:
                self.landed[name] = _land(static, self.slices[name])
            landed = ingest.read_landing(
                self.spark, self.landed[name], static.schema, maxFilesPerTrigger="1"
            )
        else:
            landed = ingest.read_landing(
                self.spark, self.sf_dir, static.schema, pattern=f"{name}.parquet"
            )
        zoned = [f.name for f in static.schema if f.dataType.simpleString() == "timestamp_ntz"]
        return landed.withColumns({c: F.col(c).cast("timestamp") for c in zoned})


# Rows of a landed file, which is a micro-batch, and bytes of its row groups, which are read by tasks of
# their own.
FILE_ROWS, GROUP_BYTES = 2_000_000, 4 << 20


def _land(df: DataFrame, slice_no) -> str:
    """Writes the slices in one job, each as one file, or as several if one has more than ``FILE_ROWS`` rows,
    in order of time if there is one; file times follow the order, which is that of a stream. A batch costs the same state
    and commits however few rows it has, so files are large. For file systems that let a file's time be
    set, as the landing folder of a replay is on one of ours."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "landing")
    sliced = df.withColumn("_slice", slice_no)
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    slices, most = sizes.agg(F.count("*"), F.max("_n")).first()
    parts = max(1, math.ceil((most or 0) / FILE_ROWS))
    times = [c for c, kind in df.dtypes if kind.startswith("timestamp")][:1]
    part = F.lit(0)
    if parts > 1 and times:
        # A slice is cut where its share of rows has passed; a few times for each slice are broadcast.
        at = F.unix_micros(F.col(times[0]).cast("timestamp"))
        cuts = sliced.groupBy(F.col("_slice").alias("_of")).agg(F.percentile_approx(
            at, [i / parts for i in range(1, parts)]).alias("_cuts"))
        sliced = sliced.join(
            F.broadcast(cuts), F.col("_slice").eqNullSafe(F.col("_of")), "left").withColumn("_at", at)
        part = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_at"))), F.lit(0))
    sliced = sliced.withColumn("_part", part).select(*df.columns, "_slice", "_part")
    folder, order = ["_slice", "_part"], ["_slice", "_part", *times]
    sliced.repartition(max(1, slices * parts), *folder).sortWithinPartitions(*order).write.partitionBy(
        *folder).option("parquet.block.size", GROUP_BYTES).parquet(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_slice=*/_part=*/part-*")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    landed = [status.getPath() for status in fs.globStatus(root)]

    def number(p):
        return *(int(x.getName().split("=")[1])
                 for x in (p.getParent().getParent(), p.getParent())), p.getName()

    began = int(time.time() * 1000) - 1000 * (len(landed) + 60)
    for i, at in enumerate(sorted(landed, key=number)):
        fs.setTimes(at, began + 1000 * i, -1)
    return f"{path}/_slice=*/_part=*"


def _days(width: int, late_seconds: int):
    """Slices of days; some rows of the last minutes of a slice come with the next one."""
    shift = F.when(F.col("event_id") % 3 == 0, F.lit(late_seconds)).otherwise(F.lit(0))
    day = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 + shift
    return F.floor(day / F.lit(86_400 * width))


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Zoned columns back to zone-less ones for comparison."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_sessions", f"""WITH {A.ACCESS_SQL}, stepped AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {A.IDLE} SECOND THEN 1 ELSE 0 END AS opens
  FROM access WINDOW w AS (PARTITION BY ip, store ORDER BY ts, seq)),
 n AS (SELECT *, sum(opens) OVER (PARTITION BY ip, store ORDER BY ts, seq) AS session_no FROM stepped)
SELECT ip, store, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_chunks, sum(size)::BIGINT AS n_bytes FROM n
GROUP BY ip, store, session_no HAVING max(ts) + INTERVAL {A.IDLE} SECOND < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_sessions_query(t):
    """Sessions the watermark has closed; those still open at the end of the input are not out yet."""
    log = A.access(_Stream(t))
    closed = stream_sessions.closed_sessions(log, idle=A.IDLE, delay="1 hour")
    return _plain(ingest.run_to_table(closed, "sessions"), "session_start", "session_end")


@query("stream_passports", f"""WITH {A.SESSIONS_SQL}
SELECT CASE WHEN ip LIKE '%:%' THEN array_to_string(string_split(ip, ':')[1:3], ':') || '::/48'
            ELSE array_to_string(string_split(ip, '.')[1:3], '.') || '.0/24' END AS network, count(*) AS n_documents, sum(n)::BIGINT AS n_chunks FROM (
  SELECT ip, store, session_no, count(*) AS n FROM numbered GROUP BY ip, store, session_no
  HAVING max(ts) + INTERVAL {A.IDLE} SECOND < (SELECT max(ts) FROM tracked) - INTERVAL 1 HOUR) GROUP BY ALL""")
def stream_passports(t):
    """A checksummed document per session the stream has closed."""
    from ..operators import sessions

    provenance = t.nation.select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("group"),
        F.col("n_name").alias("source_doi"), F.col("n_name").alias("citation"),
    )
    path, state = shared_dir(t.spark, "passports"), shared_dir(t.spark, "passports-state")
    requests = sessions.tracked(A.access(_Stream(t)))
    closed = stream_sessions.closed_sessions(requests, idle=A.IDLE, delay="1 hour")
    stored = A.access(t).withColumn("ts", F.col("ts").cast("timestamp"))
    write = stream_sessions.passport_writer(stored, provenance, path, idle=A.IDLE)
    ingest.start(closed, write, state).awaitTermination()
    docs = t.spark.read.schema("document STRING").json(path)
    node = F.from_json("document", "`@graph` ARRAY<STRUCT<agent: STRUCT<ipAnonymised: STRING>, "
                       "accessedArrays: ARRAY<STRING>, totalChunks: BIGINT>>")["@graph"][1]
    total = docs.select(
        node["agent"]["ipAnonymised"].alias("network"), node["totalChunks"].alias("n")
    )
    return total.groupBy("network").agg(
        F.count("*").alias("n_documents"), F.sum("n").alias("n_chunks")
    )


@query("stream_closing_sessions", f"""WITH {A.ACCESS_SQL},
 inst AS (SELECT ip, store, ts, count(*) FILTER (WHERE event <> 'close') AS n,
   sum(CASE WHEN event <> 'close' THEN size ELSE 0 END) AS b, max(CASE WHEN event = 'close' THEN 1 ELSE 0 END) AS c
   FROM access GROUP BY ALL),
 x AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY ip, store ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM inst),
 r AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {IDLE} SECOND OR epoch <> lag(epoch) OVER w THEN 1 ELSE 0 END AS opens
   FROM x WHERE n > 0 WINDOW w AS (PARTITION BY ip, store ORDER BY ts)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY ip, store ORDER BY ts) AS session_no FROM r),
 g AS (SELECT ip, store, min(ts) AS session_start, max(ts) AS session_end, sum(n)::BIGINT AS n_chunks, sum(b)::BIGINT AS n_bytes
   FROM s GROUP BY ip, store, session_no),
 k AS (SELECT g.*, i.ts AS closed FROM g ASOF LEFT JOIN (SELECT ip, store, ts FROM inst WHERE c = 1) i
   ON g.ip = i.ip AND g.store = i.store AND g.session_end <= i.ts)
SELECT ip, store, session_start, session_end, n_chunks, n_bytes,
  CASE WHEN closed <= session_end + INTERVAL {IDLE} SECOND THEN 'close' ELSE 'idle' END AS ended_by
FROM k WHERE CASE WHEN closed <= session_end + INTERVAL {IDLE} SECOND THEN closed ELSE session_end + INTERVAL {IDLE} SECOND END
  < (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 HOUR""")
def stream_closing_sessions(t):
    """Sessions ended by a close event or by silence, from files of five days in micro-batches of
    their own, some rows late; those still open at the end are not out yet."""
    log = A.access(_Stream(t, events=_days(5, 1800)))
    ended = stream_sessions.closing_sessions(log, idle=IDLE, delay="1 hour")
    return _plain(ingest.run_to_table(ended, "closing"), "session_start", "session_end")


@query("stream_daily_means", f"""WITH {A.OBS_SQL}
SELECT * FROM (SELECT variable, date_trunc('day', time)::TIMESTAMP AS period_start, round(avg(value), 6) AS mean_value, count(value) AS n_obs FROM obs GROUP BY ALL)
WHERE period_start + INTERVAL 1 DAY <= (SELECT max(time) FROM obs) - INTERVAL 1 HOUR""")
def stream_daily_means(t):
    o = A.obs(_Stream(t))
    daily = ingest.tumbling_mean(o, ["variable"], "time", "value", "1 day", "1 hour")
    out = ingest.run_to_table(daily, "daily").withColumn("mean_value", F.round("mean_value", 6))
    return _plain(out, "period_start")


@query("stream_distinct", f"""WITH {A.OBS_SQL}
SELECT station_id, variable, date_trunc('hour', time)::TIMESTAMP AS hour, count(*) AS n FROM (
  SELECT DISTINCT station_id, variable, date_trunc('hour', time) AS time FROM obs) GROUP BY ALL""")
def stream_distinct(t):
    """Hour-floored rows with repeats of the same hour suppressed."""
    o = A.obs(_Stream(t)).select(
        "station_id", "variable", F.date_trunc("HOUR", "time").alias("hour")
    )
    # The sample is one unordered file, so the delay covers its whole month.
    kept = ingest.first_per_key(o, ["station_id", "variable", "hour"], "hour", "31 days")
    out = ingest.run_to_table(kept, "distinct")
    return _plain(out, "hour").groupBy("station_id", "variable", "hour").agg(
        F.count("*").alias("n")
    )


@query("stream_tiles", f"""WITH {A.TILES_SQL}
SELECT date, tile_row, tile_col, max(file) AS file FROM tiles GROUP BY ALL""")
def stream_tiles(t):
    """Daily tiles in micro-batches that each hold some tiles of every date, then all once more."""
    path = shared_dir(t.spark, "tiles")
    tiles = A.tiles(_Stream(t, embeddings=-(F.col("vec_id") % 3)))
    for _ in range(2):
        ingest.start(
            tiles, ingest.append_days(path), shared_dir(t.spark, "tiles-state")
        ).awaitTermination()
    return t.spark.read.parquet(path).select("date", "tile_row", "tile_col", "file")


def _gas_stream(t, slice_no) -> DataFrame:
    """Gas rows as a stream of files, each row with the file it came in."""
    events = _Stream(t, events=slice_no).events.withColumn("landed", F.col("_metadata.file_path"))

    class Landed(Tables):
        def __getattr__(self, name: str) -> DataFrame:
            return events if name == "events" else super().__getattr__(name)

    source = A.gas_rows(Landed(t.spark, t.sf_dir), "landed").filter("gas IS NOT NULL")
    return source.withColumnRenamed("landed", "source_file")


_GAS_STORED_SQL = f"""WITH {A.GAS_SQL}
SELECT gas, station_id, count(*) AS n, round(avg(value * 1e6), 6) AS mean_value FROM gas_rows WHERE gas IS NOT NULL GROUP BY ALL"""


def _gas_stored(t, path: str) -> DataFrame:
    return sinks.gas_store(path).read(t.spark).groupBy("gas", "station_id").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("value") * 1e6), 6).alias("mean_value")
    )


@query("stream_partition_replace", _GAS_STORED_SQL)
def stream_partition_replace(t):
    """Gas files of one micro-batch each, rows of a station in all of them, ingested twice: the
    second run replaces the rows of the first."""
    path = shared_dir(t.spark, "gas")
    write = ingest.append_to(sinks.gas_store(path))
    rows = _gas_stream(t, -(F.col("event_id") % 4))
    for _ in range(2):
        ingest.start(rows, write, shared_dir(t.spark, "gas-state")).awaitTermination()
    return _gas_stored(t, path)


@query("stream_gas_ingest", f"""WITH {A.GAS_SQL}
SELECT gas, count(*) AS n, count(DISTINCT station_id) AS n_stations, round(avg(value * 1e6), 6) AS mean_value
FROM gas_rows WHERE gas IS NOT NULL GROUP BY ALL""")
def stream_gas_ingest(t):
    """The gas sink over files in any order, then merged into one folder and cleared of old ones."""
    path = shared_dir(t.spark, "gas-stations")
    rows = _gas_stream(t, F.col("event_id") % 2)
    ingest.start(
        rows, ingest.writer(sinks.write_gas, path), shared_dir(t.spark, "gas-state")
    ).awaitTermination()
    store = sinks.gas_store(path)
    store.compact(t.spark)
    store.vacuum(t.spark)
    return store.read(t.spark).groupBy("gas").agg(
        F.count("*").alias("n"), F.countDistinct("station_id").alias("n_stations"),
        F.round(F.avg(F.col("value") * 1e6), 6).alias("mean_value"),
    )


# Rows that come this many days after their time, and rows whose time cannot be read.
_LATE_DAYS, _LATE, _UNREADABLE = 6, 11, 13


@query("stream_left_out", f"""
WITH x AS (SELECT event_id, CASE WHEN event_id % {_UNREADABLE} = 0 THEN NULL ELSE ts END AS ts,
    CAST(floor((epoch(ts) + CASE WHEN event_id % {_LATE} = 0 THEN {_LATE_DAYS} * 86400 ELSE 0 END) / 172800) AS BIGINT) AS slice FROM events),
 seen AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x GROUP BY slice),
 y AS (SELECT x.*, CASE WHEN ts IS NULL THEN 'unreadable' WHEN ts <= date_trunc('milliseconds', before) - INTERVAL 1 HOUR THEN 'late' ELSE 'kept' END AS fate
   FROM x JOIN seen USING (slice))
SELECT fate, count(*) AS n FROM y GROUP BY fate""")
def stream_left_out(t):
    """What became of the rows of a stream in many micro-batches: late and unreadable ones are counted
    by batch in the report table, the others are stored."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    late = F.when(F.col("event_id") % _LATE == 0, _LATE_DAYS * 86_400).otherwise(0)
    rows = _Stream(t, events=F.floor((seconds + late) / F.lit(172_800))).events
    rows = rows.withColumn("ts", F.when(F.col("event_id") % _UNREADABLE != 0, F.col("ts")))
    rows = report.observed(rows.select("event_id", "ts"), unreadable=F.col("ts").isNull())
    kept = ingest.first_per_key(rows.filter("ts IS NOT NULL"), ["event_id"], "ts", "1 hour")
    path, table = shared_dir(t.spark, "kept"), shared_dir(t.spark, "left-out")
    with report.counted(t.spark) as counts:
        run = (
            kept.writeStream.format("parquet").option("path", path).outputMode("append")
            .option("checkpointLocation", shared_dir(t.spark, "kept-state"))
            .trigger(availableNow=True).start()
        )
        run.awaitTermination()
        counts.wait(run)
        counts.write(t.spark, run, table)
    left = t.spark.read.parquet(table).groupBy(
        F.when(F.col("reason") == report.LATE, "late").otherwise(F.col("reason")).alias("fate")
    ).agg(F.sum("n_rows").alias("n"))
    stored = t.spark.read.schema(kept.schema).parquet(path).agg(F.count("*").alias("n"))
    return stored.select(F.lit("kept").alias("fate"), "n").filter("n > 0").unionByName(left)


# Scans of an inventory: at these quarters of the span of days, each of the last third of it.
_QUARTERS = 4


@query("inventory_rescans", f"""WITH {A.HOURLY_SQL}, ticks AS (
  SELECT q - 1 AS scan, {A.FIRST_SQL} + to_days(CAST({A.DAYS_SQL} * q // {_QUARTERS} AS INTEGER)) AS scan_at, CAST({A.DAYS_SQL} // 3 AS INTEGER) AS back FROM (SELECT unnest(range(1, {_QUARTERS + 1})) AS q)),
 l AS (SELECT scan, station_id, variable, count(*) AS n FROM ticks JOIN obs ON time < scan_at AND time >= scan_at - to_days(back) GROUP BY ALL),
 s AS (SELECT k.scan, k.station_id, k.variable, b.n AS before, a.n AS now FROM (
   SELECT t.scan, u.station_id, u.variable FROM ticks t, (SELECT DISTINCT station_id, variable FROM l) u) k
   LEFT JOIN l a USING (scan, station_id, variable) LEFT JOIN l b ON b.scan = k.scan - 1 AND b.station_id = k.station_id AND b.variable = k.variable)
SELECT CAST(scan AS INTEGER) AS scan, change, variable, count(*) AS n, sum(station_id)::BIGINT AS stations FROM (
  SELECT *, CASE WHEN before IS NULL AND now IS NOT NULL THEN 'added' WHEN before IS NOT NULL AND now IS NULL THEN 'removed' WHEN before <> now THEN 'changed' END AS change FROM s)
WHERE change IS NOT NULL GROUP BY ALL""")
def inventory_rescans(t):
    """Series with observations in a sliding window of days, scanned by four ticks of a stream."""
    first, _, days = A.span(t)
    ticks = t.spark.range(1, _QUARTERS + 1).select(F.timestamp_add(
        "DAY", F.floor(F.col("id") * days / _QUARTERS).cast("int"),
        F.lit(first).cast("timestamp_ntz")).alias("at"))
    stream = ingest.read_landing(
        t.spark, _land(ticks, F.unix_seconds(F.col("at").cast("timestamp"))), ticks.schema,
        maxFilesPerTrigger="1",
    )
    rows = A.obs(t)

    def listing(batch):
        at = batch.agg(F.max("at").alias("at"))  # one tick
        seen = rows.join(F.broadcast(at), (F.col("time") < F.col("at")) & (
            F.col("time") >= F.col("at") - F.expr(f"INTERVAL {days // 3} DAYS")))
        return seen.groupBy("station_id", "variable").agg(F.count("*").alias("n"))

    path = shared_dir(t.spark, "inventory")
    scan = rescan.scanner(listing, path, ["station_id", "variable"], ["n"])
    ingest.start(stream, scan, shared_dir(t.spark, "inventory-state")).awaitTermination()
    return rescan.read_changes(t.spark, path).groupBy("scan", "change", "variable").agg(
        F.count("*").alias("n"), F.sum("station_id").alias("stations")
    )
