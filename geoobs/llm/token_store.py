"""Token ids in files with random access: directly addressable codes.

An id is split into 8-bit chunks. Level 0 holds the lowest chunk of every id and one continuation bit
for each; level 1 holds the next chunk of those ids that continue, and so on. The place of an id in
the next level is the number of continuation bits set before it, which a rank directory (one count
for every 512 bits) gives without decoding anything in between.

A store is a folder: ``segments`` holds blobs of these codes in ascending document order, with the
documents each one covers, and ``directory`` the number of ids before each written part. Both are
Parquet, so they lie on any file system that Spark writes to and a lost task is simply written again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import bytes_of, col, rows_of
from .units import Remembered, split_units

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_IDS = 1 << 18
# Positions of one list of lookups.
LIST = 1 << 12
# Units and pre-tokens whose ids a worker remembers, and their characters; bounds its memory, not what
# is encoded.
REMEMBERED = 300_000
REMEMBERED_CHARACTERS = 1 << 23


# --- codes -----------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """Codes of unsigned 32-bit ids: header, then chunks, bits and rank directory of each level."""
    rest = np.ascontiguousarray(ids, dtype=np.uint32)
    head, body = [], []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))
        ones = np.unpackbits(bits).reshape(-1, RANK_BITS).sum(1, dtype=np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        chunks = (rest & 255).astype(np.uint8)
        head.append(struct.pack("<QQ", len(rest), len(bits)))
        body += [chunks.tobytes(), bits.tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
        if not len(rest):
            break
    return MAGIC + struct.pack("<I", len(head)) + b"".join(head) + b"".join(body)


class Codes:
    """Reads packed ids in place."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a block of addressable codes")
        (levels,) = struct.unpack_from("<I", blob, 4)
        at = 8 + 16 * levels
        self.levels = []
        for k in range(levels):
            n, n_bits = struct.unpack_from("<QQ", blob, 8 + 16 * k)
            chunks = np.frombuffer(blob, np.uint8, n, at)
            bits = np.frombuffer(blob, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(blob, "<u4", n_bits * 8 // RANK_BITS, at + n + n_bits)
            at += n + n_bits + ranks.nbytes
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Bits set before position ``i``: a directory entry and at most 64 bytes."""
        block = i // RANK_BITS
        if block == len(ranks):
            return int(ranks[-1]) + int(np.unpackbits(bits[-(RANK_BITS // 8):]).sum()) if block else 0
        first = block * RANK_BITS
        part = np.unpackbits(bits[first // 8:(i + 7) // 8], bitorder="little")[: i - first]
        return int(ranks[block]) + int(part.sum())

    def __getitem__(self, i: int) -> int:
        """One id by its position, without decoding any other."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self.rank(bits, ranks, i), shift + 8
        return value

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi``, exclusive, as unsigned 32-bit integers."""
        out = np.zeros(max(0, hi - lo), dtype="<u4")
        where = np.arange(len(out))
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= chunks[lo:hi].astype(np.uint32) << (8 * k)
            part = np.unpackbits(bits[lo // 8:(hi + 7) // 8], bitorder="little")
            more = part[lo % 8:lo % 8 + hi - lo].astype(bool)
            where = where[more]
            lo = self.rank(bits, ranks, lo)
            hi = lo + len(where)
        return out


# --- encoding --------------------------------------------------------------------------------


class Kept(Remembered):
    """Remembered ids that count the characters of their keys."""

    held = 0

    def __missing__(self, key):
        self.held += len(key)
        value = self[key] = self.make(key)
        return value

    def clear(self) -> None:
        super().clear()
        self.held = 0


class Encoder:
    """Ids of the tokenizers library as packed little-endian 32-bit integers.

    Pre-tokens are encoded independently of each other by byte-level BPE, so the library is asked once
    for each that recurs. Texts of Latin characters are cut into pre-tokens at once, others first into
    units. Vocabularies of another kind, and texts that hold an added token, go to the library whole.
    """

    def __init__(self, path: str):
        from .token_counts import Counter

        self.counter = Counter(path)
        self.library = self.counter.library
        if self.counter.direct:
            size = self.library.get_vocab_size()
            self.bytes = [i.to_bytes(4, "little") for i in range(size)]
            self.merges = self.library.model.tokenize
            self.latin = Kept(self.merge_latin, REMEMBERED)
            self.merged = Kept(self.merge, REMEMBERED)
            self.units = Kept(self.after_blank, REMEMBERED)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def merge(self, pretoken: str) -> bytes:
        ids = self.bytes
        return b"".join([ids[t.id] for t in self.merges(pretoken)])

    def merge_latin(self, pretoken: str) -> bytes:
        return self.merge(self.counter.pretokens.in_bytes(pretoken))

    def after_blank(self, unit: str) -> bytes:
        found = self.counter.pretokens.after_blank(unit)
        if len(found) == 1:
            return self.merge(found[0])
        return b"".join(map(self.merged.__getitem__, found))

    def trim(self) -> None:
        every = self.latin, self.merged, self.units
        for kept in every:
            kept.trim()
        if sum(kept.held for kept in every) > REMEMBERED_CHARACTERS:
            for kept in every:
                kept.clear()

    def encode(self, text: str) -> bytes:
        if not self.counter.direct or any(s in text for s in self.counter.special):
            return self.whole(text)
        self.trim()
        pretokens = self.counter.pretokens.latin(text)
        if pretokens is not None:
            return b"".join(map(self.latin.__getitem__, pretokens))
        first, *rest = split_units(text)
        head = b"".join(map(self.merge, self.counter.pretokens(first)))
        return head + b"".join(map(self.units.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- store -----------------------------------------------------------------------------------

_SEGMENT = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("codes", pa.binary()),
])
_SEGMENT_DDL = (
    "part int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, "
    "doc_tokens array<bigint>, codes binary"
)


def write(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary: str, end_id: int,
    path: str | None = None, segment_ids: int = SEGMENT_IDS,
) -> str:
    """Writes the ids of every whole text, then ``end_id``, in ascending ``doc_id`` order.

    ``path`` is a folder that every executor reaches (default: a fresh one below
    ``spark.checkpoint.dir``); it is returned. A null text counts as empty, so its document holds
    only ``end_id``. A null ``doc_id`` comes first. Rows with equal ids keep all their copies, ordered
    by their text's hash, so one id that holds many rows is still dealt over many tasks. An empty
    table gives an empty store. Other columns are not read.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark, "token-store")
    rows = df.select(col(doc_id).cast("long").alias("doc_id"), bytes_of(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        number, first, held, docs = 0, 0, [], []

        def flush():
            nonlocal number, first, held, docs
            ids = np.frombuffer(b"".join(held), "<u4")
            lengths = [len(h) // 4 for h in held]
            row = [part, number, first, len(ids), docs, lengths, pack(ids)]
            out = pa.RecordBatch.from_arrays(
                [pa.array([v], type=f.type) for v, f in zip(row, _SEGMENT)], schema=_SEGMENT
            )
            number, first, held, docs = number + 1, first + len(ids), [], []
            return out

        size = 0
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), rows_of(batch.column(1))):
                ids = enc.encode(raw.decode("utf-8", "replace")) + end
                held.append(ids)
                docs.append(doc)
                size += len(ids) // 4
                if size >= segment_ids:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    dealt.select("doc_id", "text").mapInArrow(segments, _SEGMENT_DDL).write.parquet(
        f"{path}/segments"
    )
    written = spark.read.schema(_SEGMENT_DDL).parquet(f"{path}/segments")
    # One row for each written part, so the running sum is over as many rows as there were tasks.
    parts = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    ).write.parquet(f"{path}/directory")
    return path


def _segments(spark: SparkSession, path: str) -> DataFrame:
    written = spark.read.schema(_SEGMENT_DDL).parquet(f"{path}/segments")
    directory = spark.read.schema("part int, before bigint").parquet(f"{path}/directory")
    placed = written.join(F.broadcast(directory), "part")
    return placed.withColumn("first", F.col("first") + F.col("before")).drop("before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a store: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (binary, little-endian unsigned 32-bit)."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, docs, lengths, blob = (batch.column(k)[i].as_py() for k in range(4))
                codes, at = Codes(blob), np.cumsum([0, *lengths])
                ids = codes.slice(0, len(codes)).tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, type=pa.int64()),
                    pa.array(at[:-1] + first, type=pa.int64()),
                    pa.array(lengths, type=pa.int64()),
                    pa.array([ids[4 * a:4 * b] for a, b in zip(at, at[1:])], type=pa.binary()),
                ], schema=out)

    held = _segments(spark, path).select("first", "doc_ids", "doc_tokens", "codes")
    return held.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_at(positions: DataFrame, path: str, position: str = "position") -> DataFrame:
    """Adds ``token_id``, the id at each position of the whole store; null outside of it.

    Positions are first gathered in lists of one stretch of ``LIST`` positions each, so a segment's bytes
    meet at most as many lists as it has stretches, however many positions are asked for; only the
    bytes of the asked ids are decoded.
    """
    spark = positions.sparkSession
    block = lambda c: F.floor(c / SEGMENT_IDS).cast("long")
    held = _segments(spark, path).filter("n_tokens > 0").withColumn(
        "block", F.explode(F.sequence(block(F.col("first")),
                                      block(F.col("first") + F.col("n_tokens") - 1)))
    ).select("block", "first", "n_tokens", "codes")
    asked = positions.select(col(position).cast("long").alias("position")).distinct()
    lists = asked.groupBy(
        block(F.col("position")).alias("block"), F.floor(F.col("position") / LIST).alias("stretch")
    ).agg(F.collect_list("position").alias("positions"), F.min("position").alias("low"),
          F.max("position").alias("high"))
    met = lists.join(held, "block").filter(
        (F.col("high") >= F.col("first")) & (F.col("low") < F.col("first") + F.col("n_tokens"))
    )

    @F.arrow_udf("array<struct<position:bigint,token_id:bigint>>")
    def pick(codes: pa.Array, first: pa.Array, positions: pa.Array) -> pa.Array:
        out = []
        for blob, start, asked in zip(codes, first.to_pylist(), positions.to_pylist()):
            held = Codes(blob.as_buffer())
            out.append([{"position": p, "token_id": held[p - start]} for p in asked
                        if 0 <= p - start < len(held)])
        kind = pa.struct([("position", pa.int64()), ("token_id", pa.int64())])
        return pa.array(out, pa.list_(kind))

    found = met.select(F.explode(pick("codes", "first", "positions")).alias("f")).select("f.*")
    keyed = positions.withColumn("position", col(position).cast("long"))
    return keyed.join(found, "position", "left")
