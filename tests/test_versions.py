"""Append-only stores: versions, removal, compaction, clearing, and what a write costs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from geoobs.sources.versions import Store, history
from geoobs.streaming import ingest

KIND = "site STRING, source_file STRING, t INT, v DOUBLE"


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"), "site", ["site"], ["t"])


def rows(spark, *values):
    return spark.createDataFrame(list(values), KIND)


def table(spark, store, **at):
    return sorted((tuple(r) for r in store.read(spark, **at).collect()), key=repr)


def bytes_below(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def test_files_replace_what_they_brought(spark, store):
    a = rows(spark, ("x", "f", 1, 1.0), ("x", "f", 2, 2.0), ("y", "f", 1, 3.0), (None, "f", 1, 4.0),
             ("x", None, 1, 5.0), (None, None, None, None))
    assert store.append(a) == 1
    assert store.append(a) == 2
    assert table(spark, store) == sorted((tuple(r) for r in a.collect()), key=repr)
    # A file with fewer rows of a site replaces that site's rows only.
    store.append(rows(spark, ("x", "f", 1, 9.0), ("x", "g", 1, 8.0)))
    assert table(spark, store) == sorted(
        [("x", "f", 1, 9.0), ("x", "g", 1, 8.0), ("y", "f", 1, 3.0), (None, "f", 1, 4.0),
         ("x", None, 1, 5.0), (None, None, None, None)], key=repr)
    assert table(spark, store, version=2) == sorted((tuple(r) for r in a.collect()), key=repr)


def test_repeated_rows_of_one_write_stay(spark, store):
    store.append(rows(spark, *[("x", "f", 1, 1.0)] * 3))
    assert len(table(spark, store)) == 3


def test_write_without_rows_leaves_no_trace(spark, store):
    assert store.append(rows(spark, ("x", "f", 1, 1.0)).filter("false")) == 0
    assert not store.exists(spark)
    store.append(rows(spark, ("x", "f", 1, 1.0)))
    assert store.append(rows(spark, ("x", "f", 1, 1.0)).filter("false")) == 0
    assert len(table(spark, store)) == 1


def test_removal_is_one_commit_row(spark, store):
    store.append(rows(spark, ("x", "f", 1, 1.0), ("x", "g", 1, 1.0), ("y", "f", 1, 2.0),
                      (None, "f", 1, 3.0)))
    before, size = store.commits(spark).count(), bytes_below(store.path + "/rows")
    store.remove(rows(spark, ("x", "any", 0, 0.0), ("x", "any", 1, 0.0)))
    assert store.commits(spark).count() == before + 1
    assert bytes_below(store.path + "/rows") == size
    assert table(spark, store) == sorted([("y", "f", 1, 2.0), (None, "f", 1, 3.0)], key=repr)
    store.append(rows(spark, ("x", "g", 5, 5.0)))  # what comes later is there again, alone
    assert ("x", "g", 5, 5.0) in table(spark, store) and len(table(spark, store)) == 3
    store.remove(rows(spark, (None, None, 0, 0.0)))
    assert table(spark, store) == [("x", "g", 5, 5.0), ("y", "f", 1, 2.0)]
    assert len(table(spark, store, version=1)) == 4


def test_failed_write_is_never_seen(spark, store):
    store.append(rows(spark, ("x", "f", 1, 1.0)))

    fail = F.when(F.col("t") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    with pytest.raises(Exception, match="lost"):
        store.append(rows(spark, ("x", "f", 1, 2.0), ("x", "f", 7, 2.0)).withColumn("v", fail))
    # Rows that were written without their commits do not count either.
    rows(spark, ("x", "f", 9, 9.0)).write.parquet(store.path + "/rows/attempt=alost")
    assert table(spark, store) == [("x", "f", 1, 1.0)]
    assert store.vacuum(spark) >= 1
    assert table(spark, store) == [("x", "f", 1, 1.0)]


def test_batches_cost_what_they_weigh(spark, store):
    """The bytes that a small batch writes do not depend on what is stored."""
    big = spark.range(200_000).select(
        (F.col("id") % 50).cast("string").alias("site"), F.lit("big").alias("source_file"),
        F.col("id").cast("int").alias("t"), F.rand(1).alias("v"))
    small = [(str(i), "small", i, 1.0) for i in range(50)]  # touches every site

    def cost(batch):
        before = bytes_below(store.path)
        store.append(batch)
        return bytes_below(store.path) - before

    alone = cost(rows(spark, *small))
    whole = cost(big)
    again = [cost(rows(spark, *small)) for _ in range(3)]
    assert whole > 50 * alone
    assert max(again) < 1.5 * alone
    assert store.read(spark).count() == 200_050


def test_compaction_and_clearing(spark, store):
    for k in range(6):
        store.append(rows(spark, *[(s, f"f{k % 4}", k, float(k)) for s in "xyz"]))
    store.remove(rows(spark, ("z", None, 0, 0.0)))
    want = table(spark, store)
    assert len(want) == 8
    attempts = {r["attempt"]: (r["n_rows"], r["n_live"]) for r in store.attempts(spark).collect()}
    assert sorted(attempts.values()) == [(3, 0)] * 2 + [(3, 2)] * 4
    assert store.compact(spark) == 4
    assert table(spark, store) == want
    # A write that came between reading and committing a compaction has the higher version.
    assert [r["version"] for r in store.live(spark).select("version").distinct()
            .orderBy("version").collect()] == [3, 4, 5, 6]
    assert store.vacuum(spark) == 6
    assert table(spark, store) == want
    assert store.compact(spark) == 0 and store.vacuum(spark) == 0
    store.append(rows(spark, ("z", "f0", 1, 1.0)))
    assert len(table(spark, store)) == 9


def test_history(spark, store):
    store.append(rows(spark, ("x", "f", 1, 1.0), ("y", "g", 1, 1.0), ("y", "g", 2, 1.0)))
    store.remove(rows(spark, ("x", None, 0, 0.0)))
    got = [(r["version"], r["action"], r["n_entities"], r["n_files"], r["n_rows"])
           for r in history(store, spark).orderBy("version").collect()]
    assert got == [(1, "write", 2, 2, 3), (2, "remove", 1, 0, 0)]


def test_schema_of_the_caller(spark, store):
    """Columns that only later writes have."""
    store.append(rows(spark, ("x", "f", 1, 1.0)))
    later = rows(spark, ("x", "g", 1, 1.0)).withColumn("unit", F.lit("m"))
    store.append(later)
    got = store.read(spark, later.schema).orderBy("source_file").collect()
    assert [r["unit"] for r in got] == [None, "m"]


def test_stream_over_many_batches(spark, store, tmp_path):
    landing = tmp_path / "landing"
    for k in range(5):
        rows(spark, *[(s, f"f{k}", t, float(k)) for s in "xy" for t in range(3)]).coalesce(1).write.mode(
            "append").parquet(str(landing))
    stream = ingest.read_landing(spark, str(landing), rows(spark, ("x", "f", 1, 1.0)).schema,
                                 maxFilesPerTrigger="1")
    for run in range(2):
        ingest.start(stream, ingest.append_to(store), str(tmp_path / f"state{run}")).awaitTermination()
    assert store.read(spark).count() == 30
    assert store.commits(spark).agg(F.max("version")).first()[0] == 10
    skipped = store.read(spark).filter("site = 'x'")
    assert skipped.count() == 15
