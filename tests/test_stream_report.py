"""Counts of rows that streams leave out, over many micro-batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from geoobs.streaming import ingest, report

T0 = datetime(2024, 1, 1)
KIND = "id INT, ts TIMESTAMP"


def _landing(spark, path, batches):
    import os
    import time

    began = time.time() - 10_000
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, KIND).coalesce(1).write.parquet(f"{path}/b={i}")
    for i in range(len(batches)):
        for name in os.listdir(f"{path}/b={i}"):
            os.utime(f"{path}/b={i}/{name}", (began + i, began + i))
    return ingest.read_landing(spark, f"{path}/b=*", KIND, maxFilesPerTrigger="1")


def test_more_batches_than_the_recent_progress_holds(spark, tmp_path):
    """Late and unreadable rows come early in a run of more batches than progress is kept of."""
    batches = []
    for i in range(8):
        rows = [(i, T0 + timedelta(hours=3 * i))]
        if i in (3, 4):  # late rows are told by the watermark of the batch before the last
            rows += [(1000 + i, T0 - timedelta(days=9)), (2000 + i, T0 - timedelta(days=9))]
        if i == 5:
            rows.append((3000 + i, None))
        batches.append(rows)
    stream = _landing(spark, str(tmp_path / "in"), batches)
    conf = {"spark.sql.shuffle.partitions": "1", "spark.sql.streaming.numRecentProgressUpdates": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        seen = report.observed(stream, unreadable=F.col("ts").isNull())
        kept = ingest.first_per_key(seen.filter("ts IS NOT NULL"), ["id"], "ts", "1 hour")
        found = []
        out = ingest.run_to_table(kept, "many", found)
        assert out.count() == 8
        assert found == [("skipped", report.LATE, 4), ("skipped", "unreadable", 1)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_report_table(spark, tmp_path):
    stream = _landing(spark, str(tmp_path / "in"), [
        [(1, T0), (2, None)], [(3, T0 + timedelta(days=1))], [(7, T0 + timedelta(days=2))],
        [(4, T0), (5, None), (6, None)]])
    seen = report.observed(stream, unreadable=F.col("ts").isNull(), odd=F.col("id") % 2 == 1)
    kept = ingest.first_per_key(seen.filter("ts IS NOT NULL"), ["id"], "ts", "1 hour")
    with report.counted(spark) as counts:
        run = kept.writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        run.awaitTermination()
        counts.wait(run)
        for _ in range(2):
            counts.write(spark, run, str(tmp_path / "report"))
    rows = spark.read.parquet(str(tmp_path / "report")).distinct()
    got = sorted((r["batch"], r["reason"], r["n_rows"]) for r in rows.collect())
    assert got == [(0, "odd", 1), (0, "unreadable", 1), (1, "odd", 1), (2, "odd", 1), (3, report.LATE, 1),
                   (3, "odd", 1), (3, "unreadable", 2)]
