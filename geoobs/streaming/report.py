"""What a stream left out, by micro-batch.

A listener keeps the counts of every progress event, so none is lost however many batches a run has
(``recentProgress`` only holds the last ones). Late rows are counted by the stateful operators, rows
that could not be read by ``observe`` on the stream itself.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

LATE = "later than the watermark"
COUNTS = "run STRING, batch BIGINT, reason STRING, n_rows BIGINT"


def observed(df: DataFrame, **reasons: Column) -> DataFrame:
    """``df`` with counts of the rows that meet each condition, to be found under ``rows``."""
    named = [F.count_if(c).alias(name) for name, c in reasons.items()]
    return df.observe("left_out", *named)


class Counts(StreamingQueryListener):
    """Rows left out of the streams of a session, by run, batch and reason."""

    def __init__(self):
        self._lock = threading.Condition()
        self._batches: dict[tuple[str, int], dict[str, int]] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = {LATE: sum(op.numRowsDroppedByWatermark for op in p.stateOperators)}
        for row in p.observedMetrics.values():
            found.update(row.asDict())
        with self._lock:
            held = self._batches.setdefault((str(p.runId), p.batchId), {})
            # An idle trigger may report a batch again without rows.
            for reason, n in found.items():
                held[reason] = max(held.get(reason, 0), n or 0)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all events of an ended run have arrived."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the end of the stream was not reported")

    def total(self, query: StreamingQuery, reason: str = LATE) -> int:
        with self._lock:
            return sum(found.get(reason, 0) for (run, _), found in self._batches.items()
                       if run == str(query.runId))

    def rows(self, spark: SparkSession, query: StreamingQuery) -> DataFrame:
        """``run``, ``batch``, ``reason`` and ``n_rows`` of every batch that left rows out: a few
        numbers for each micro-batch."""
        with self._lock:
            found = [
                (run, batch, reason, n) for (run, batch), held in sorted(self._batches.items())
                if run == str(query.runId) for reason, n in sorted(held.items()) if n
            ]
        return spark.createDataFrame(found, COUNTS)

    def write(self, spark: SparkSession, query: StreamingQuery, path: str) -> None:
        """Adds the counts of a run to the report table."""
        self.rows(spark, query).coalesce(1).write.mode("append").parquet(path)


@contextmanager
def counted(spark: SparkSession) -> Iterator[Counts]:
    """Counts of the streams that run inside."""
    counts = Counts()
    spark.streams.addListener(counts)
    try:
        yield counts
    finally:
        spark.streams.removeListener(counts)
