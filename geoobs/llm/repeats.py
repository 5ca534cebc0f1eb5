"""Passages that repeat across documents, by seed and extend.

Every stretch of ``window`` words holds one anchor: the run of ``gram`` words with the least hash. The
same stretch in two documents has the same anchor (winnowing), so anchors are the seeds, and only
those of two documents and more are followed up. Each occurrence of an anchor stands for the
consecutive stretches that it was chosen for, its surroundings.

Matches are extended from the seeds both ways in two joins, for all occurrences at once instead of
pair by pair, so a passage of any number of documents costs one row for each occurrence. The first
join extends over the whole surroundings: where these are those of a smaller document, they are
repeated in full. What is left is the smallest occurrence of each different surroundings; where an
anchor has several, the second join extends them stretch by stretch. Repeated stretches that overlap
or touch are then put together, which gives the maximal repeats of ``window`` words and more.

Anchors and surroundings, and anchors and stretches, are compared by two independent 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, col, stored

WINDOW = 50

_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stretches(words: np.ndarray, length: int) -> np.ndarray:
    """One hash for every ``length`` consecutive words, from hashes of half the length."""
    out, have = words, 1
    while have < length:
        step = min(have, length - have)
        out = _mixed(out[:len(out) - step] * _ODD[0] + out[step:] * _ODD[1])
        have += step
    return out


def _least_at(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of every ``width`` consecutive values, the first one among equals."""
    at, have = np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def _gram(window: int) -> int:
    """Words of an anchor: half a stretch, so that chance matches are few."""
    return (window + 1) // 2


class Seeds:
    """Anchors of a few texts, and the stretches that each was chosen for.

    The words of all texts are hashed as one sequence; stretches that run over an end do not count.
    """

    def __init__(self, raws: list[bytes], window: int):
        split = [raw.split() for raw in raws]
        words = b"".join(map(xxhash.xxh3_64_digest, chain.from_iterable(split)))
        each = np.frombuffer(words, ">u8").astype(np.uint64)
        size = np.array([len(w) for w in split], dtype=np.int64)
        ends = np.cumsum(size)
        gram = _gram(window)
        if len(each) < window:
            at = np.empty(0, np.int64)
        else:
            grams = _stretches(each, gram)
            self.stretches = _stretches(_mixed(each ^ _ODD[2]), window)
            owner = _least_at(grams, window - gram + 1)
            left = np.repeat(ends, size) - np.arange(len(each))
            at = np.flatnonzero(left[:len(owner)] >= window)
        if not len(at):
            self.first = self.last = at
            self.anchors = self.around = at.astype(np.uint64)
        else:
            owner = owner[at]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            self.first, self.last = at[starts], at[np.append(starts[1:], len(at)) - 1]
            owner = owner[starts]
            self.anchors = grams[owner]
            self.around = _mixed(
                self.stretches[self.first] * _ODD[0] + self.stretches[self.last] * _ODD[1]
                + (self.last - self.first).astype(np.uint64) * _ODD[3]
                + (owner - self.first).astype(np.uint64) * _ODD[4]
            )
        # Where each text's words and anchors begin.
        self.words = np.concatenate([[0], ends])
        self.bounds = np.searchsorted(self.first, self.words)


def _few(texts: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about ``most`` bytes, one text at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = (np.cumsum(sizes) - sizes) // most
    starts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
    yield from zip(starts, [*starts[1:], len(texts)])


def _joined(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.array(flat.astype(kind.to_pandas_dtype(), copy=False))


def _seeds(text, window: int):
    @F.arrow_udf("struct<anchors:array<bigint>,around:array<bigint>,first:array<int>,"
                 "last:array<int>>")
    def seeds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, counts = ([], [], [], []), [np.zeros(1, np.int64)]
            for lo, hi in _few(batch):
                s = Seeds(batch.slice(lo, hi - lo).to_pylist(), window)
                n = np.diff(s.bounds)
                counts.append(n)
                begin = np.repeat(s.words[:-1], n)
                for into, values in zip(found, (s.anchors.view(np.int64), s.around.view(np.int64),
                                                s.first - begin, s.last - begin)):
                    into.append(values)
            ends = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(ends, _joined(f, k)) for f, k in zip(found, kinds)],
                names=["anchors", "around", "first", "last"],
            )

    return seeds(text)


def _followed(text, firsts, window: int):
    """Stretches of a text that belong to the anchors at ``firsts``, with these anchors."""
    fields = [("anchor", pa.int64()), ("stretch", pa.int64()), ("at", pa.int32())]

    @F.arrow_udf("array<struct<anchor:bigint,stretch:bigint,at:int>>")
    def followed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, given in batches:
            found, counts = ([], [], []), [np.zeros(1, np.int64)]
            for lo, hi in _few(texts):
                s = Seeds(texts.slice(lo, hi - lo).to_pylist(), window)
                mine = given.slice(lo, hi - lo)
                begin = np.repeat(s.words[:-1], np.diff(mine.offsets.to_numpy()))
                chosen = np.isin(s.first, mine.flatten().to_numpy() + begin)
                first, size = s.first[chosen], (s.last - s.first + 1)[chosen]
                places = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                doc = np.searchsorted(s.words, places, "right") - 1
                found[0].append(np.repeat(s.anchors[chosen], size).view(np.int64))
                found[1].append(s.stretches[places].view(np.int64) if len(places) else places)
                found[2].append(places - s.words[doc])
                counts.append(np.bincount(doc, minlength=hi - lo))
            flat = pa.StructArray.from_arrays(
                [_joined(f, kind) for f, (_, kind) in zip(found, fields)],
                fields=[pa.field(*f) for f in fields],
            )
            ends = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
            yield pa.ListArray.from_arrays(ends, flat)

    return followed(text, firsts)


def _without(text, ranges, window: int):
    """Counts, repeated spans and what is left of each text."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("spans", pa.list_(span)), ("kept_text", pa.string())])

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,"
                 "spans:array<struct<start:int,end:int>>,kept_text:string>")
    def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, given in batches:
            parts = []
            for at in range(0, len(texts), 64):
                rows = []
                for raw, mine in zip(texts.slice(at, 64).to_pylist(),
                                     given.slice(at, 64).to_pylist()):
                    words, spans, removed = raw.split(), [], 0
                    if mine:
                        first, last = np.array([(r["first"], r["last"]) for r in mine]).T
                        step = np.zeros(len(words) + 1, dtype=np.int32)
                        np.add.at(step, first, 1)
                        np.add.at(step, last + window, -1)
                        covered = np.cumsum(step[:-1]) > 0
                        edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
                        spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                        removed = int(covered.sum())
                        kept = compress(words, (~covered).tolist())
                    else:
                        kept = words
                    rows.append({"n_words": len(words), "n_removed": removed, "spans": spans,
                                 "kept_text": b" ".join(kept).decode("utf-8", "replace")})
                parts.append(pa.array(rows, kind))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return without(text, ranges)


def _in_two(rows: DataFrame, key: str, doc: str = "doc", keys: tuple = ()) -> DataFrame:
    """Keys that rows of two documents and more have, with the ``least`` of these."""
    ends = rows.groupBy(key, *keys).agg(F.min(doc).alias("least"), F.max(doc).alias("_most"))
    return ends.filter("least < _most").drop("_most")


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, window: int = WINDOW,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` and ``kept_text`` for every row.

    Words are runs of anything but ASCII blanks. A word is removed if it lies in a stretch of
    ``window`` consecutive words whose sequence also starts in a document with a smaller id; stretches
    are judged on the input, not on what is left. ``spans`` are the maximal removed runs (word
    positions, end exclusive), ``kept_text`` the other words joined by one blank.

    A null, blank or shorter text has no stretch and loses nothing. A row without an id neither loses
    words nor makes others lose any. Rows with one id are documents of their own whose ids are not
    smaller than each other's, so repeated rows get equal answers. Within a document nothing counts
    as repeated. Bytes that are not UTF-8 become U+FFFD in ``kept_text``. Columns other than the two
    are not read, whatever their names. Empty in, empty out.
    """
    docs = df.select(col(doc_id).alias("doc"), bytes_of(text).alias("raw")).withColumn(
        "part", F.xxhash64("raw")  # tells different texts of one id apart
    )
    seeds = stored(
        docs.filter("doc IS NOT NULL").select("doc", "part", _seeds(F.col("raw"), window).alias("s"))
        .select("doc", "part", "s.*").filter(F.size("anchors") > 0),
        "repeat-seeds",
    )
    seen = seeds.select(
        "doc", "part",
        F.explode(F.arrays_zip("anchors", "around", "first", "last")).alias("o"),
    ).select("doc", "part", F.col("o.anchors").alias("anchor"), "o.around", "o.first", "o.last")
    # Seeds of two documents and more. Tables that are joined are stored first: a side that is still
    # to be aggregated by the key would keep Spark from splitting the rows of a frequent one.
    shared = stored(
        _in_two(seen, "anchor").select(F.col("anchor").alias("_anchor")), "repeat-anchors"
    )
    matched = stored(
        seen.join(shared, F.col("anchor") == F.col("_anchor")).drop("_anchor"), "repeat-matches"
    )
    # First extension: the whole surroundings of an anchor.
    least = stored(
        matched.groupBy("anchor", "around").agg(F.min("doc").alias("least")), "repeat-least"
    )
    several = stored(
        _in_two(least, "anchor", "least").select(F.col("anchor").alias("_anchor")),
        "repeat-several",
    )
    least = least.join(several, F.col("anchor") == F.col("_anchor"), "left").select(
        F.col("anchor").alias("_a"), F.col("around").alias("_s"), "least",
        F.col("_anchor").isNotNull().alias("several"),
    )
    extended = stored(
        matched.join(least, (F.col("anchor") == F.col("_a")) & (F.col("around") == F.col("_s")))
        .select("doc", "part", "first", "last", (F.col("doc") > F.col("least")).alias("repeated"),
                "several").filter("repeated OR several"),
        "repeat-extended",
    )
    # Second extension, for the smallest of each surroundings: stretch by stretch.
    follow = extended.filter("NOT repeated").groupBy(
        F.col("doc").alias("_doc"), F.col("part").alias("_part")
    ).agg(F.collect_set("first").alias("follow"))
    both = (F.col("doc") == F.col("_doc")) & (F.col("part") == F.col("_part"))
    stretches = stored(
        docs.join(follow, both)
        .select("doc", "part", _followed(F.col("raw"), F.col("follow"), window).alias("w"))
        .select("doc", "part", F.explode("w").alias("w")).select("doc", "part", "w.*"),
        "repeat-stretches",
    )
    again = stored(
        _in_two(stretches, "anchor", keys=("stretch",)).select(
            F.col("anchor").alias("_a"), F.col("stretch").alias("_s"), "least"
        ),
        "repeat-starts",
    )
    again = stretches.join(
        again, (F.col("anchor") == F.col("_a")) & (F.col("stretch") == F.col("_s"))
    ).filter(F.col("doc") > F.col("least")).select(
        "doc", "part", F.col("at").alias("first"), F.col("at").alias("last")
    )
    found = extended.filter("repeated").select("doc", "part", "first", "last").unionAll(again)
    found = found.groupBy(F.col("doc").alias("_doc"), F.col("part").alias("_part")).agg(
        F.collect_set(F.struct("first", "last")).alias("ranges")
    )
    out = docs.join(found, both, "left").select(
        "doc", _without(F.col("raw"), F.col("ranges"), window).alias("r")
    )
    return out.select(F.col("doc").alias("doc_id"), "r.*")
