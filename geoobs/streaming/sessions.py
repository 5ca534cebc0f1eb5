"""Access sessions on a stream of requests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.clean import micros
from ..operators import passport
from ..operators.sessions import CLIENT, IDLE_SECONDS, tracked


def closed_sessions(log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS, size="size",
                    delay: str | None = None) -> DataFrame:
    """Sessions as the watermark closes them (append mode).

    State per session is a handful of sums; distinct names and chunk manifests are computed from the
    stored log once a session is closed. Partial sessions are merged before the shuffle, so a busy
    client sends sums, not requests, where the session sets
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``.
    """
    marked = log.withWatermark(ts, delay or f"{idle} seconds")
    # session_window ends a session when the pause reaches the gap; one more microsecond keeps a
    # pause of exactly ``idle`` inside.
    gap = f"{idle} seconds 1 microsecond"
    return marked.groupBy(*CLIENT, F.session_window(ts, gap).alias("w")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
        F.count("*").alias("n_chunks"), F.sum(size).alias("n_bytes"),
    ).drop("w")


_INSTANT = (
    "ip string, store string, ts timestamp, us bigint, n bigint, bytes bigint, closes boolean"
)
_SESSION = (
    "ip string, store string, session_start timestamp, session_end timestamp, n_chunks bigint, "
    "n_bytes bigint, ended_by string"
)

# What a state holds of an instant.
_HELD = [*CLIENT, "us", "n", "bytes", "closes"]
_HELD_TYPES = pa.schema(
    [(c, pa.string()) for c in CLIENT] + [(c, pa.int64()) for c in _HELD[len(CLIENT):]])


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Requests of one client at one instant as one row, before the shuffle."""
    for b in batches:
        if not b.empty:
            yield b.groupby([*CLIENT, "ts", "us"], as_index=False, sort=False, dropna=False).agg(
                n=("n", "sum"), bytes=("size", "sum"), closes=("is_close", "any")
            )


def chunks_of(closed: DataFrame, log: DataFrame, ts: str = "ts", idle: int = IDLE_SECONDS):
    """Chunk requests of closed sessions, taken from the stored log, with a ``session_id``.

    Sessions are laid out over their time cells and joined on (client, cell), so a busy client is
    spread over its cells and a request meets only sessions of its own cell. A cell is as long as the
    idle time, so at most two sessions of a client touch it. The join is never broadcast: laid out,
    sessions are many times the rows that the planner expects.
    """
    spans = closed.select(
        *CLIENT, F.col("session_start").alias("_from"), F.col("session_end").alias("_to"),
        F.sha2(F.concat_ws("|", *CLIENT, micros("session_start").cast("string")), 256).alias(
            "session_id"),
    )
    cell = F.lit(idle * 1_000_000)
    cells = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(micros("_from") / cell), F.floor(micros("_to") / cell)
    )))
    requests = tracked(log).withColumn("cell", F.floor(micros(ts) / cell))
    rows = requests.join(cells.hint("merge"), [*CLIENT, "cell"])
    return rows.filter(F.col(ts).between(F.col("_from"), F.col("_to"))).drop(
        "cell", "_from", "_to"
    )


def passport_writer(
    log: DataFrame, provenance: DataFrame, path: str, ts: str = "ts", idle: int = IDLE_SECONDS
) -> Callable[[DataFrame, int], None]:
    """Batch writer: one self-checksummed document per closed session.

    Each micro-batch has a folder of its own that a retry overwrites. Sessions without chunks match
    no request and yield nothing.
    """
    keys = [*CLIENT, "session_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = passport.detailed_manifest(chunks_of(batch, log, ts, idle), keys, ts)
        named = passport.assemble(rows, provenance, keys).withColumn(
            "id", F.concat(F.lit("urn:session:"), "session_id")
        )
        docs = passport.graph_document(named, "id")
        docs.select("id", passport.file_name().alias("file_name"), "sha256", "total_chunks",
                    "document").write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return write


def _finished(clients: pd.DataFrame, runs: list[tuple]) -> pd.DataFrame:
    first, last, n, size, by = zip(*runs)
    return pd.DataFrame({
        "ip": clients["ip"].to_numpy(), "store": clients["store"].to_numpy(),
        "session_start": np.array(first, "datetime64[us]"),
        "session_end": np.array(last, "datetime64[us]"),
        "n_chunks": n, "n_bytes": size, "ended_by": by,
    })


def _settled(us, n, size, closes, idle_us: int, watermark_us: int):
    """Sessions that no request at or after the watermark can change, and the instants still open.

    Instants are in time order, one row each. A session ends at the first close at or after its last
    request and within the idle time, or with the idle time; a pause counts in both directions, so
    it does not matter in which batch a request came.
    """
    done, start = [], 0
    at = 0
    while at < len(us):
        if not n[at]:  # a close without an open session ends nothing
            at = start = at + 1
            continue
        first = last = at
        ended, by, final_us = at + 1, "idle", None
        for k in range(at, len(us)):
            if us[k] - us[last] > idle_us:
                break
            if n[k]:
                last = k
            ended = k + 1
            if closes[k]:
                by, final_us = "close", us[k]
                break
        final_us = us[last] + idle_us if final_us is None else final_us
        if final_us >= watermark_us:
            return done, start, final_us
        run = slice(first, last + 1)
        done.append((us[first], us[last], int(n[run].sum()), int(size[run].sum()), by))
        at = start = ended
    return done, start, None


def closing_sessions(
    log: DataFrame, idle: int = IDLE_SECONDS, delay: str | None = None, shares: int = 1024
):
    """Sessions that end on idle time or on an explicit close event.

    ``log`` needs ``ts, ip, store, size, event``. A client's instants stay in its state until the
    watermark has passed the end of their session, so requests may come late and in any order within
    the delay; the result is that of one batch. Requests at the instant of a close belong to the
    session it ends. A close without an open session, or after the idle time, ends nothing. Silence
    is measured in event time, so a replay gives the same sessions. Clients are dealt into ``shares``
    with one state each, since a call and a state for every client cost far more than its instants.
    What a task holds of a share is bounded by the instants of the delay and one micro-batch;
    ``maxFilesPerTrigger`` of the source bounds the latter.
    """
    idle_us = idle * 1_000_000
    is_close = F.col("event") == "close"
    rows = log.select(
        "ip", "store", "ts", F.unix_micros("ts").alias("us"), is_close.alias("is_close"),
        F.when(is_close, 0).otherwise(1).cast("bigint").alias("n"),
        F.when(is_close, 0).otherwise(F.coalesce("size", F.lit(0))).cast("bigint").alias("size"),
    )

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [pa.ipc.open_stream(state.get[0]).read_pandas()] if state.exists else []
        if not state.hasTimedOut:
            parts += [b[_HELD] for b in batches]
        seen = pd.concat(parts, ignore_index=True)
        # Clients by number in any order, their instants in order of time, one row each.
        client = seen.groupby(CLIENT, sort=False, dropna=False).ngroup().to_numpy()
        rows = seen[_HELD[2:]].to_numpy("int64")
        order = np.lexsort((rows[:, 0], client))
        client, rows = client[order], rows[order]
        new = np.flatnonzero(np.r_[True, (np.diff(client) != 0) | (np.diff(rows[:, 0]) != 0)])
        us, client, source = rows[new, 0], client[new], order[new]
        n, size = np.add.reduceat(rows[:, 1], new), np.add.reduceat(rows[:, 2], new)
        closes = np.maximum.reduceat(rows[:, 3], new)
        watermark = state.getCurrentWatermarkMs()
        starts = np.flatnonzero(np.r_[True, np.diff(client) != 0])
        held, finals, done, owner = np.zeros(len(us), bool), [], [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(us)]):
            ended, start, final_us = _settled(
                us[lo:hi], n[lo:hi], size[lo:hi], closes[lo:hi], idle_us, watermark * 1000)
            # A close the watermark has not passed may still meet a late request that came before it.
            held[lo:hi] = (np.arange(hi - lo) >= start) | (us[lo:hi] >= watermark * 1000)
            if final_us is None and held[lo:hi].any():
                final_us = us[lo:hi][held[lo:hi]][0]
            if final_us is not None:
                finals.append(int(final_us))
            done += ended
            owner += [source[lo]] * len(ended)
        if finals:
            kept = seen.iloc[source[held]][CLIENT].assign(
                us=us[held], n=n[held], bytes=size[held], closes=closes[held])
            table = pa.Table.from_pandas(kept, _HELD_TYPES, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(max(min(finals) // 1000, watermark))
        elif state.exists:
            state.remove()
        if done:
            yield _finished(seen.iloc[owner], done)

    instants = rows.mapInPandas(_add_up, _INSTANT).withWatermark("ts", delay or f"{idle} seconds")
    dealt = instants.withColumn("share", F.pmod(F.xxhash64(*CLIENT), F.lit(shares)))
    return dealt.groupBy("share").applyInPandasWithState(
        step, _SESSION, "instants binary", "append", GroupStateTimeout.EventTimeTimeout
    )
