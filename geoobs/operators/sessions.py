"""Access sessions and their totals.

Requests of one client never gather as raw rows: they are first added up per time cell of a tenth of
the idle timeout (two requests in one cell always belong together), which leaves at most ten rows
per timeout and client, and only these cells are ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.clean import micros
from .keys import join_null_safe

IDLE_SECONDS = 300
CLIENT = ["ip", "store"]


def tracked(log: DataFrame) -> DataFrame:
    """Chunk requests with the array and group they belong to.

    A key of one component counts as a chunk but names no group or array.
    """
    path = F.col("array_path")
    two_parts = F.contains("key", F.lit("/"))
    name = F.substring_index(path, "/", -1)
    above = F.substring(path, F.lit(1), F.length(path) - F.length(name) - 1)
    return (
        log.filter(names.is_tracked("key"))
        .withColumn("array_path", names.array_path("key"))
        .withColumns({"array": F.when(two_parts, name), "group": F.when(two_parts, above)})
    )


def with_cell(log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS) -> DataFrame:
    return log.withColumn("cell", F.floor(micros(ts) / F.lit(idle * 100_000)))


def session_cells(log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS, size="size"):
    """Cells of each client with the number of the session they fall in (1, 2, ...)."""
    cells = with_cell(log, ts, idle).groupBy(*CLIENT, "cell").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.count("*").alias("n_chunks"), F.sum(size).alias("n_bytes"),
    )
    w = Window.partitionBy(*CLIENT).orderBy("cell")
    pause = micros("first_ts") - F.lag(micros("last_ts")).over(w)
    opens = F.when(pause.isNull() | (pause > idle * 1_000_000), 1).otherwise(0)
    return cells.withColumn("_open", opens).withColumn(
        "session_no", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_open")


def sessions(log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS, size="size") -> DataFrame:
    """One row per session: start, end, chunks and bytes. A pause of exactly ``idle`` continues it."""
    return session_cells(log, ts, idle, size).groupBy(*CLIENT, "session_no").agg(
        F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end"),
        F.sum("n_chunks").cast("bigint").alias("n_chunks"),
        F.sum("n_bytes").cast("bigint").alias("n_bytes"),
    )


def with_session(log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS, size="size"):
    """Requests with their session number.

    Joined on (client, cell), so a busy client is spread over its cells.
    """
    cells = session_cells(log, ts, idle, size).select(*CLIENT, "cell", "session_no")
    return join_null_safe(with_cell(log, ts, idle), cells, [*CLIENT, "cell"]).drop("cell")


def session_members(chunks: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Distinct groups or arrays per session with their chunk counts, one row each."""
    return chunks.filter(F.col(member).isNotNull()).groupBy(*keys, member).agg(
        F.count("*").alias("n_chunks")
    )


def sessions_with_close(
    log: DataFrame, ts: str = "ts", seq: str = "seq", event: str = "event",
    idle: int = IDLE_SECONDS, size: str = "size",
) -> DataFrame:
    """Sessions that end on an idle timeout or on an explicit close event.

    Rows are first added up per client and microsecond, then cells are cut at close events. Requests
    at the instant of a close belong to the session it ends; a close with nothing before it, and a
    session without chunks, yield no row.
    """
    close = F.col(event) == "close"
    instants = log.groupBy(*CLIENT, ts).agg(
        F.count_if(~close).alias("n"), F.sum(F.when(~close, F.col(size))).alias("b"),
        (F.count_if(close) > 0).alias("closes"),
    )
    celled = with_cell(instants, ts, idle)
    inside = Window.partitionBy(*CLIENT, "cell").orderBy(ts)
    earlier = F.coalesce(
        F.sum(F.col("closes").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    has_rows = F.col("n") > 0
    pieces = celled.withColumn("part", earlier).groupBy(*CLIENT, "cell", "part").agg(
        F.min(F.when(has_rows, F.col(ts))).alias("first_ts"),
        F.max(F.when(has_rows, F.col(ts))).alias("last_ts"),
        F.sum("n").alias("n_chunks"), F.sum("b").alias("n_bytes"),
        F.bool_or("closes").alias("closed"),
    )
    w = Window.partitionBy(*CLIENT).orderBy("cell", "part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last_seen = F.last(F.col("last_ts"), ignorenulls=True).over(before)
    # A close between the last request and this one also opens a new session.
    closes = F.sum(F.col("closed").cast("int")).over(before)
    numbered = pieces.withColumn("_seen", last_seen).withColumn(
        "_epoch", F.coalesce(closes, F.lit(0))
    ).filter(F.col("n_chunks") > 0)
    pause = micros("first_ts") - micros("_seen")
    opens = F.when(
        pause.isNull() | (pause > idle * 1_000_000)
        | (F.col("_epoch") != F.lag("_epoch").over(w)), 1,
    ).otherwise(0)
    return (
        numbered.withColumn("_open", opens)
        .withColumn("session_no", F.sum("_open").over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*CLIENT, "session_no")
        .agg(
            F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end"),
            F.sum("n_chunks").cast("bigint").alias("n_chunks"),
            F.sum("n_bytes").cast("bigint").alias("n_bytes"),
            F.bool_or("closed").alias("closed"),
        )
    )
