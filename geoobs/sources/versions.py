"""Append-only stores: a file that comes again replaces what it brought, and nothing is rewritten.

A store is a folder of two Parquet tables. ``rows`` holds one folder for each write (``attempt``), with
exactly the rows of that write. ``commits`` says what became of them: a row for each file of an entity
(site, station, deployment) that a write brought, or one row that removes an entity. A write appends
its rows first and its commits last, so it becomes visible as a whole or not at all, and costs what
its own rows weigh however large the store is.

What is current is resolved on read: of each file of an entity the highest version counts, unless the
entity was removed later. Rows meet their commits in a semi join on the folder they lie in, which lets
Spark skip folders that nothing refers to any more. ``compact`` merges small or mostly outdated folders
into one, and ``vacuum`` deletes those that are no longer referred to.

One job writes to a store at a time, as one stream does; readers may come at any time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keys import join_null_safe

FILE = "source_file"
# Names of the store's own columns; rows must not have them.
ATTEMPT, VERSION = "attempt", "version"
SORT_KEY = "_sort_key"
# Bits of a sort key that hold seconds since year 1; the others hold a hash.
SECOND_BITS = 39


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at ``path``, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


@dataclass(frozen=True)
class Store:
    """A store at ``path``. ``entity`` names the key column of what can be removed as a whole, ``file``
    the one with the name of the file that a row came in. Rows of equal ``cluster`` lie together and
    are ordered by ``order``, so that filters on these skip files and row groups; a dominant cluster is
    still spread over several files. Where the last column of ``order`` is a timestamp, rows of equal
    columns before it lie together, ordered by its second; two such groups may rarely share a hash, and
    then lie mixed."""

    path: str
    entity: str
    cluster: list[str] = field(default_factory=list)
    order: list[str] = field(default_factory=list)
    file: str = FILE

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _commits(self) -> str:
        return f"{self.path}/commits"

    def _unit(self) -> list[str]:
        return [self.entity, self.file]

    def _laid_out(self, df: DataFrame) -> DataFrame:
        if not self.cluster:
            return df
        dealt = df.hint("rebalance", *self.cluster)
        *before, last = [*self.cluster, *self.order]
        if not self.order or df.schema[last].dataType.typeName() not in ("timestamp", "timestamp_ntz"):
            return dealt.sortWithinPartitions(*before, last)
        # One number, which Spark sorts by its digits; strings would be compared row by row.
        hashed = F.pmod(F.xxhash64(*before), F.lit(1 << (62 - SECOND_BITS)))
        second = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'0001-01-01 00:00:00'"),
                                  F.col(last).cast("timestamp_ntz"))
        key = F.shiftleft(hashed, SECOND_BITS) + F.coalesce(second, F.lit(0).cast("bigint"))
        return dealt.withColumn(SORT_KEY, key).sortWithinPartitions(SORT_KEY).drop(SORT_KEY)

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self._commits)

    def commits(self, spark: SparkSession) -> DataFrame:
        """All commits: entity, file (null where an entity was removed), version, attempt, when and why.

        Of a store that was never written this fails; ask ``exists`` first.
        """
        return spark.read.parquet(self._commits)

    def _next_version(self, spark: SparkSession) -> int:
        if not self.exists(spark):
            return 1
        return self.commits(spark).agg(F.max(VERSION)).first()[0] + 1

    def append(self, df: DataFrame) -> int:
        """Adds the rows of ``df``, which replace those of the same files of the same entities.

        Rows with a null entity or file are kept like any other. Running the same write again gives the
        same table: its rows come under a new version of the same files. Returns the version, 0 for a
        write without rows, which leaves no trace.
        """
        spark = df.sparkSession
        attempt = f"a{uuid.uuid4().hex}"
        folder = f"{self._rows}/{ATTEMPT}={attempt}"
        self._laid_out(df).write.parquet(folder)
        units = spark.read.schema(df.schema).parquet(folder).groupBy(*self._unit()).agg(
            F.count("*").alias("n_rows"))
        return self._commit(units, attempt, "write")

    def _commit(self, units: DataFrame, attempt: str | None, action: str) -> int:
        spark = units.sparkSession
        version = self._next_version(spark)
        rows = units.select(
            *self._unit(), F.lit(version).cast("bigint").alias(VERSION),
            F.lit(attempt).cast("string").alias(ATTEMPT), F.lit(action).alias("action"),
            F.col("n_rows").cast("bigint").alias("n_rows"),
            F.current_timestamp().alias("committed_at"),
        )
        if rows.isEmpty():
            return 0
        rows.coalesce(1).write.mode("append").parquet(self._commits)
        return version

    def remove(self, entities: DataFrame) -> int:
        """Hides all that the listed entities hold now; what is written later is theirs again.

        One commit row for each entity, no row of the store is read or written. Returns the version.
        """
        spark = entities.sparkSession
        kind = self.commits(spark).schema[self.file].dataType
        units = entities.select(F.col(self.entity)).distinct().select(
            self.entity, F.lit(None).cast(kind).alias(self.file), F.lit(0).alias("n_rows"))
        return self._commit(units, None, "remove")

    def live(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The commit that counts for each file of each entity, as of ``version`` if given."""
        commits = self.commits(spark)
        if version is not None:
            commits = commits.filter(F.col(VERSION) <= version)
        # A compaction keeps the version it found and only says where the rows lie now.
        last = commits.filter("action <> 'remove'").groupBy(*self._unit()).agg(
            F.max(F.struct(VERSION, "committed_at", ATTEMPT, "n_rows")).alias("_last")
        ).select(*self._unit(), f"_last.{VERSION}", f"_last.{ATTEMPT}", "_last.n_rows")
        gone = commits.filter("action = 'remove'").groupBy(
            F.col(self.entity).alias("_gone")).agg(F.max(VERSION).alias("_removed"))
        on = last[self.entity].eqNullSafe(gone["_gone"]) & (last[VERSION] <= gone["_removed"])
        return last.join(gone, on, "left_anti")

    def read(
        self, spark: SparkSession, schema: StructType | None = None, version: int | None = None
    ) -> DataFrame:
        """Current rows, or those as of an earlier ``version`` that has not been vacuumed."""
        live = self.live(spark, version).select(*self._unit(), ATTEMPT)
        return join_null_safe(
            self._all(spark, schema), live, [*self._unit(), ATTEMPT], "left_semi"
        ).drop(ATTEMPT)

    def _all(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(StructType(schema.fields).add(ATTEMPT, "string"))
        return reader.parquet(self._rows)

    def attempts(self, spark: SparkSession) -> DataFrame:
        """Folders of the store by ``attempt``: rows committed in each and how many still count."""
        written = self.commits(spark).filter(F.col(ATTEMPT).isNotNull()).groupBy(ATTEMPT).agg(
            F.sum("n_rows").alias("n_rows"))
        now = self.live(spark).groupBy(F.col(ATTEMPT).alias("_attempt")).agg(
            F.sum("n_rows").alias("n_live"))
        return written.join(now, F.col(ATTEMPT) == F.col("_attempt"), "left").select(
            ATTEMPT, "n_rows", F.coalesce("n_live", F.lit(0)).alias("n_live"))

    def compact(
        self, spark: SparkSession, small: int = 1_000_000, dead_share: float = 0.5,
        schema: StructType | None = None,
    ) -> int:
        """Writes the current rows of folders with fewer than ``small`` rows, or of which at least
        ``dead_share`` no longer counts, into one new folder. Returns the number of folders merged.

        Versions stay, so a write that is committed meanwhile is not undone. Nothing is deleted, and
        rows of other folders are neither read nor written.
        """
        now = self.attempts(spark).filter("n_live > 0")
        dead = 1 - F.col("n_live") / F.col("n_rows")
        chosen = now.filter((F.col("n_rows") < small) | (dead >= dead_share))
        n = chosen.count()
        if n < 2 and now.filter(dead >= dead_share).isEmpty():
            return 0
        moved = join_null_safe(self.live(spark), chosen.select(ATTEMPT), [ATTEMPT], "left_semi")
        keys = [*self._unit(), ATTEMPT]
        rows = join_null_safe(self._all(spark, schema), moved.select(*keys), keys, "left_semi")
        attempt = f"a{uuid.uuid4().hex}"
        self._laid_out(rows.drop(ATTEMPT)).write.parquet(f"{self._rows}/{ATTEMPT}={attempt}")
        commits = moved.select(
            *self._unit(), VERSION, F.lit(attempt).alias(ATTEMPT), F.lit("compact").alias("action"),
            "n_rows", F.current_timestamp().alias("committed_at"),
        )
        commits.write.mode("append").parquet(self._commits)
        return n

    def vacuum(self, spark: SparkSession) -> int:
        """Deletes folders that no current commit refers to, failed writes included; versions before
        the last can then no longer be read in full. Returns the number of folders deleted.

        No write may be under way, and readers must have begun after the last commit. The names of the
        folders, one for each write since the last vacuum, pass through the driver, which deletes them.
        """
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        root = fs_path(self._rows)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        live = {r[0] for r in self.live(spark).select(ATTEMPT).distinct().collect()}
        gone = 0
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(f"{ATTEMPT}=") and name.split("=", 1)[1] not in live:
                fs.delete(status.getPath(), True)
                gone += 1
        return gone


def history(store: Store, spark: SparkSession) -> DataFrame:
    """One row for each version: what it did, files and entities it touched, rows it brought."""
    entity: Column = F.countDistinct(F.struct(F.col(store.entity)))
    return store.commits(spark).filter("action <> 'compact'").groupBy(VERSION, "action").agg(
        entity.alias("n_entities"), F.count(store.file).alias("n_files"),
        F.sum("n_rows").alias("n_rows"), F.min("committed_at").alias("committed_at"),
    )
