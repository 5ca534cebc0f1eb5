"""Zip archives of any size on any file system that Spark reads, member by member.

Spark's text reader is also a reader of raw bytes: cut at line feeds, a file becomes many short rows,
dealt over tasks by splits, and each row's offset follows from the lengths of the rows before it. The
end of an archive names its directory, the directory names the members, and only bytes of wanted
members are shuffled, to one task for each member, which inflates them as they come. So no value and no
task holds an archive, and no list of paths reaches the driver.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The end record, its longest comment, and the records of archives beyond 4 GB before it.
TAIL = 22 + 65_535 + 20 + 56
# Bytes by which rows and members are matched.
BUCKET = 1 << 22
# Lines of a member that are handed on at a time.
LINES = 1 << 14


def byte_rows(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``archive``, ``size``, ``offset`` and ``bytes``: files cut after every line feed.

    A stretch without a line feed is one row; compressed data has one every 256 bytes or so.
    """
    rows = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("bytes"),
    ).withColumn("n", F.octet_length("bytes") + F.lit(1).cast("bigint"))
    # One row for each split is ordered along a file.
    earlier = (Window.unboundedPreceding, -1)
    splits = rows.groupBy("archive", "block").agg(F.sum("n").alias("_n")).select(
        F.col("archive").alias("_a"), F.col("block").alias("_b"),
        F.sum("_n").over(Window.partitionBy("archive").orderBy("block").rowsBetween(*earlier))
        .alias("_before"),
    )
    inside = Window.partitionBy("archive", "block").orderBy("id").rowsBetween(*earlier)
    placed = rows.withColumn("_inside", F.sum("n").over(inside)).join(
        splits, (F.col("archive") == F.col("_a")) & (F.col("block") == F.col("_b"))
    )
    offset = F.coalesce("_inside", F.lit(0)) + F.coalesce("_before", F.lit(0))
    placed = placed.withColumn("offset", offset.cast("bigint"))
    # Only what ends a file may lack the line feed.
    ended = F.col("offset") + F.col("n") <= F.col("size")
    return placed.select("archive", "size", "offset", F.when(
        ended, F.concat("bytes", F.lit(b"\n"))).otherwise(F.col("bytes")).alias("bytes"))


def _end_of(rows: DataFrame) -> DataFrame:
    """``archive`` with offset and bytes of its directory, from the last bytes of the file."""
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64())])

    @F.arrow_udf("struct<start:bigint,length:bigint>")
    def find(tails: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tails:
            out = []
            for parts in batch.to_pylist():
                tail = b"".join(p["bytes"] for p in sorted(parts, key=lambda p: p["offset"]))
                at = tail.rfind(b"PK\x05\x06")
                if at < 0 or len(tail) < at + 22:
                    raise ValueError("not a zip archive: it has no end record")
                length, start = struct.unpack_from("<II", tail, at + 12)
                if 0xFFFFFFFF in (length, start):
                    at = tail.rfind(b"PK\x06\x06", 0, at)
                    length, start = struct.unpack_from("<QQ", tail, at + 40)
                out.append({"start": start, "length": length})
            yield pa.array(out, kind)

    tail = rows.filter(F.col("offset") + F.octet_length("bytes") > F.col("size") - TAIL)
    tails = tail.groupBy("archive").agg(F.collect_list(F.struct("offset", "bytes")).alias("parts"))
    return tails.select("archive", find("parts").alias("d")).select("archive", "d.*")


def _reach(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of bytes with the keys of every range (``archive``, ``start``, ``stop``) that they touch."""

    def spread(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
        return df.withColumns({"_lo": F.floor(lo / BUCKET), "_hi": F.floor(hi / BUCKET)}).withColumn(
            "_bucket", F.explode(F.sequence("_lo", "_hi")))

    end = F.col("offset") + F.octet_length("bytes")
    left = spread(rows.drop("size"), F.col("offset"), end - 1)
    right = spread(ranges, F.col("start"), F.col("stop") - 1).select(
        F.col("archive").alias("_archive"), F.col("_lo").alias("_from"),
        F.col("_bucket").alias("_b"), "start", "stop", *keys,
    )
    met = left.join(
        right, (F.col("archive") == F.col("_archive")) & (F.col("_bucket") == F.col("_b"))
    )
    # A row and a range that share several buckets meet in the first of them only.
    return met.filter(
        (F.col("_bucket") == F.greatest("_lo", "_from"))
        & (F.col("offset") < F.col("stop")) & (end > F.col("start"))
    ).select("archive", "offset", "bytes", "start", "stop", *keys)


def _stream(rows: DataFrame, keys: list[str], schema: str, begin: Callable) -> DataFrame:
    """Feeds the bytes of every group of ``keys`` in order to an object of ``begin`` and hands on what it
    yields; a task holds one group's unread bytes at a time."""
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != now:
                    if reader is not None:
                        yield from reader.end()
                    now, reader = key, begin(row)
                skip = max(0, row["start"] - row["offset"])
                yield from reader.feed(row["bytes"][skip:row["stop"] - row["offset"]])
        if reader is not None:
            yield from reader.end()

    return ordered.mapInArrow(run, schema)


class _Directory:
    """Central directory: one entry for each member."""

    fields = [("archive", pa.string()), ("member", pa.string()), ("method", pa.int32()),
              ("crc", pa.int64()), ("packed", pa.int64()), ("start", pa.int64())]
    ddl = "archive string, member string, method int, crc bigint, packed bigint, start bigint"

    def __init__(self, row: dict):
        self.archive, self.held, self.found = row["archive"], b"", []

    def feed(self, piece: bytes) -> Iterator[pa.RecordBatch]:
        self.held += piece
        at = 0
        while len(self.held) >= at + 46:
            fixed = struct.unpack_from("<4s6H3I5H2I", self.held, at)
            name, extra, comment = fixed[10:13]
            if fixed[0] != b"PK\x01\x02" or len(self.held) < at + 46 + name + extra + comment:
                break
            flags, method, crc, packed, plain, start = (
                fixed[3], fixed[4], fixed[7], fixed[8], fixed[9], fixed[16])
            raw = self.held[at + 46:at + 46 + name]
            more = self.held[at + 46 + name:at + 46 + name + extra]
            while len(more) >= 4 and 0xFFFFFFFF in (packed, plain, start):
                kind, length = struct.unpack_from("<HH", more)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", more, 4))
                    plain, packed, start = (
                        next(wide) if x == 0xFFFFFFFF else x for x in (plain, packed, start))
                more = more[4 + length:]
            text = raw.decode("utf-8" if flags & 0x800 else "cp437")
            self.found.append((self.archive, text, method, crc, packed, start))
            at += 46 + name + extra + comment
        self.held = self.held[at:]
        return iter(())

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            raise ValueError(f"{self.archive}: the directory is damaged")
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in self.found], kind) for i, (_, kind) in enumerate(self.fields)],
            names=[name for name, _ in self.fields],
        )


class _Member:
    """Lines of a member, inflated as its bytes come."""

    ddl = "archive string, member string, line_no bigint, line string"

    def __init__(self, row: dict):
        self.row, self.left, self.held = row, row["packed"], b""
        self.plain = zlib.decompressobj(-15) if row["method"] == 8 else None
        if row["method"] not in (0, 8):
            raise ValueError(f"{row['member']}: unknown compression {row['method']}")
        self.inside, self.crc, self.rest, self.n = False, 0, b"", 0

    def _lines(self, last: bool) -> Iterator[pa.RecordBatch]:
        *whole, rest = self.rest.split(b"\n")
        if last and rest:
            whole, rest = [*whole, rest], b""
        self.rest = rest
        for at in range(0, len(whole), LINES):
            part = [x.rstrip(b"\r").decode("utf-8", "replace") for x in whole[at:at + LINES]]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(self.row["archive"], len(part)), pa.repeat(self.row["member"], len(part)),
                 pa.array(range(self.n, self.n + len(part)), pa.int64()),
                 pa.array(part, pa.string())], names=["archive", "member", "line_no", "line"])
            self.n += len(part)

    def feed(self, piece: bytes) -> Iterator[pa.RecordBatch]:
        if not self.inside:
            self.held += piece
            if len(self.held) < 30:
                return
            name, extra = struct.unpack_from("<HH", self.held, 26)
            if self.held[:4] != b"PK\x03\x04":
                raise ValueError(f"{self.row['member']}: no member begins where the directory says")
            if len(self.held) < 30 + name + extra:
                return
            piece, self.held, self.inside = self.held[30 + name + extra:], b"", True
        piece = piece[:self.left]
        self.left -= len(piece)
        data = piece if self.plain is None else self.plain.decompress(piece)
        self.crc = zlib.crc32(data, self.crc)
        self.rest += data
        if len(self.rest) > 1 << 20:
            yield from self._lines(False)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.plain is not None:
            data = self.plain.flush()
            self.crc = zlib.crc32(data, self.crc)
            self.rest += data
        if self.left or self.crc != self.row["crc"]:
            raise ValueError(f"{self.row['archive']}: {self.row['member']} is damaged")
        yield from self._lines(True)


def members(rows: DataFrame) -> DataFrame:
    """Directory of all archives in ``rows`` (from ``byte_rows``): ``archive``, ``member`` (its path),
    ``method``, ``crc``, ``packed`` bytes and ``start`` of its header. A file that is no archive, or a
    damaged one, fails the job."""
    found = _end_of(rows)
    ranges = found.select(
        "archive", "start", (F.col("start") + F.col("length")).alias("stop")
    ).filter("stop > start")
    inside = _reach(rows, ranges, [])
    return _stream(inside, ["archive"], _Directory.ddl, _Directory)


def member_lines(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``archive``, ``member``, ``line_no`` from 0 and ``line`` of the ``wanted`` rows of ``members``.

    Lines end at line feeds, with or without a carriage return; bytes that are not UTF-8 become U+FFFD.
    Checksums are verified. A member is read by one task, since its bytes only make sense in order.
    """
    # A header's own extra field may be longer than the directory's; what is too much is not read.
    ranges = wanted.withColumn("stop", F.col("start") + 30 + 2 * 65_535 + F.col("packed"))
    met = _reach(rows, ranges, ["member", "method", "crc", "packed"])
    return _stream(met, ["archive", "member"], _Member.ddl, _Member)
