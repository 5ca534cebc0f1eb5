"""Alignment of the tokens that two tokenizers make of the same texts.

Both token sequences of a text end at byte offsets of the same bytes. One NumPy state vector holds a
pointer into the first and one into the second sequence for every document of a batch, and all of them
move in lockstep: a step emits the link of each pointer pair, emits a cut where both tokens end, moves
the pointer of the token that ends first, or both, and drops the documents that are finished. Long
documents enter as several lanes, from offsets where both sequences are known to cut.

How often an id pair is linked in all documents comes from a grouped sum. The most frequent pairs, at
most ``SHARED_PAIRS``, go to every task; links of all others meet their counts in a join.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .common import bytes_of, col, stored

# Bytes of text whose documents move in lockstep together, and tokens after which a lane may end.
BATCH_BYTES = 1 << 20
LANE = 256
SHARED_PAIRS = 1 << 19
# Blanks in a row from which on tiktoken's pattern goes too deep.
_BLANKS = re.compile(r"\s{1024}")
BLANK = "▁"


def _byte_letters() -> dict[str, int]:
    """Bytes by the letters of byte-level vocabularies: printable ones stand for themselves, the others
    follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def _unsure() -> re.Pattern:
    """Characters that two libraries may split differently: those whose class (letter, number, blank or
    other) has changed or come since Unicode 3.2, or may yet come."""

    def kind(category: str) -> str:
        return category[0] if category[0] in "LNZ" else "other"

    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    codes = [
        c for c in range(0x110000)
        if (now := new(chr(c))) == "Cn" or kind(now) != kind(old(chr(c)))
    ]
    codes += [*range(0x1C, 0x20), 0x85, 0x180E, 0x200B]
    ranges, codes = [], sorted(set(codes))
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    listed = "".join(f"\\U{lo:08x}-\\U{hi:08x}" for lo, hi in ranges)
    return re.compile(f"[{listed}]")


class Pair:
    """Ids that both tokenizers give for blank and text, and the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.quick = self._ranked(a_path)

    def _ranked(self, path: str):
        """The first vocabulary as ranks, which tiktoken encodes faster; None if it is not known to give
        the same ids.

        It merges any two neighbours whose bytes are a token, the library only the pairs it lists, both
        by rank. Where a token's own bytes encode as that token alone, its listed pair is the only one
        that can ever stand there; tokens that do not are never made by the library and are left out.
        """
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, split = given["model"], given["pre_tokenizer"] or {}
        if (given["normalizer"] is not None or model["type"] != "BPE" or model.get("dropout")
                or model.get("ignore_merges") or split.get("type") != "ByteLevel"
                or not split.get("use_regex", True) or split.get("add_prefix_space", True)):
            return None
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocabulary["".join(p)] for p in pairs]
        single = [t for t in vocabulary if len(t) == 1]
        if (merged != sorted(set(merged)) or len(single) != 256
                or len(single) + len(merged) != len(vocabulary)
                or max(vocabulary[t] for t in single) > min(merged)):
            return None
        alone = [
            t for t, i in vocabulary.items()
            if [x.id for x in self.a.model.tokenize(t)] == [i]
        ]
        return tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={self.a_bytes[vocabulary[t]]: vocabulary[t] for t in alone},
        )

    def _first(self, text: str) -> list[int] | None:
        """Ids of the first side; None if they do not give the bytes back."""
        if self.quick is not None and _BLANKS.search(text) is None and (
            text.isascii() or _unsure().search("".join(set(text))) is None
        ):
            # Every byte is a token, so these ids always give the text again.
            return self.quick.encode_ordinary(" " + text)
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        alike = b"".join(map(self.a_bytes.__getitem__, ids)) == b" " + text.encode()
        return ids if alike else None

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none unless both give the bytes of blank and text."""
        none = (np.empty(0, np.int64),) * 2
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            given = b" " + text.encode()
            if not text or b"".join(map(self.b_bytes.__getitem__, b)) != given:
                out.append(none)
                continue
            a = self._first(text)
            out.append(none if a is None else tuple(np.array(x, dtype=np.int64) for x in (a, b)))
        return out


@lru_cache(maxsize=1)
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, lane: int = LANE):
    """Links and cuts of token sequences over the same bytes, whose offsets run on over documents.

    Returns token positions (first, second side) of every link, in the order of the steps, and those
    of the last tokens before every cut, ascending.
    """
    # Lanes begin at the start and after shared ends that follow every ``lane`` tokens.
    near = np.arange(lane, len(a_ends), lane, dtype=np.int32)[:, None] + np.arange(
        min(lane, 32), dtype=np.int32)
    near = near[near < len(a_ends)]
    at = np.searchsorted(b_ends, a_ends[near])
    shared = b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends[near]
    near, at = near[shared], at[shared]
    first = np.flatnonzero(np.diff(near // lane, prepend=0)) if len(near) else near
    a = np.concatenate([[0], near[first] + 1]).astype(np.int32)
    b = np.concatenate([[0], at[first] + 1]).astype(np.int32)
    stop = np.append(a[1:], len(a_ends)).astype(np.int32)
    a, b, stop = (x[a < stop] for x in (a, b, stop))
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        a_end, b_end = a_ends[a], b_ends[b]
        both = a_end == b_end
        cuts_a.append(a[both])
        cuts_b.append(b[both])
        a, b = a + (a_end <= b_end), b + (b_end <= a_end)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    parts = [np.concatenate(x) if x else np.empty(0, np.int64)
             for x in (links_a, links_b, cuts_a, cuts_b)]
    return parts[0], parts[1], np.sort(parts[2]), np.sort(parts[3])


def _labels(n_a: int, n_b: int) -> list[bytes]:
    """Every id with what follows it: inside its side of a group, or at its end."""
    return [b"%d%s" % (i, end) for n, last in ((n_a, b"|"), (n_b, b";")) for i in range(n)
            for end in (b",", last)]


class Aligned:
    """Alignment of the documents of one batch."""

    def __init__(self, tokens: list, both: Pair, labels: list[bytes], texts: bool):
        n = len(tokens)
        self.n_a, self.n_b = (
            np.array([len(t[side]) for t in tokens], dtype=np.int64) for side in (0, 1)
        )
        a_ids, b_ids = (np.concatenate([t[side] for t in tokens]) for side in (0, 1))
        doc = np.repeat(np.arange(n), self.n_a)
        if len(a_ids):
            links_a, links_b, cuts_a, cuts_b = lockstep(
                np.cumsum(both.a_size[a_ids]), np.cumsum(both.b_size[b_ids])
            )
        else:
            links_a = links_b = cuts_a = cuts_b = np.empty(0, np.int64)
        self.n_links = np.bincount(doc[links_a], minlength=n)
        self.n_groups = np.bincount(doc[cuts_a], minlength=n)
        # Different id pairs of each document, and how many links hold them.
        size = len(both.a_bytes) * len(both.b_bytes)
        named = doc[links_a] * size + a_ids[links_a] * len(both.b_bytes) + b_ids[links_b]
        named, self.times = np.unique(named, return_counts=True)
        self.pairs = named % size
        self.pair_ends = np.searchsorted(named, np.arange(n + 1) * size)
        # Groups in writing: the first side's tokens, then the second's, group by group.
        a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_last[cuts_a], b_last[cuts_b] = True, True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        codes = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        codes[np.arange(len(a_ids)) + np.concatenate([[0], cuts_b + 1])[a_group]] = a_ids * 2 + a_last
        codes[np.arange(len(b_ids)) + (cuts_a + 1)[b_group]] = (
            2 * len(both.a_bytes) + b_ids * 2 + b_last
        )
        ends = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        self.digests, self.groups = [], []
        for i in range(n):
            written = b"".join(map(labels.__getitem__, codes[ends[i]:ends[i + 1]].tolist()))[:-1]
            self.digests.append(hashlib.sha256(written).hexdigest() if written else "")
            if texts:
                self.groups.append(written.decode())


_TYPES = (
    StructType().add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long")
    .add("groups_sha256", "string").add("pairs", ArrayType(LongType()))
    .add("times", ArrayType(IntegerType())).add("groups", "string")
)


def _aligned(given: DataFrame, a_path: str, b_path: str, texts: bool) -> DataFrame:
    """The column ``row`` with the alignment of ``raw``, in batches of about ``BATCH_BYTES`` of text."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        labels = _labels(len(both.a_bytes), len(both.b_bytes))
        for batch in batches:
            size = pc.binary_length(batch["raw"]).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = (np.cumsum(size) - size) // BATCH_BYTES
            starts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                raws = part["raw"].to_pylist()
                found = Aligned(
                    both([raw.decode("utf-8", "replace") for raw in raws]), both, labels, texts
                )
                ends = pa.array(found.pair_ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part["row"], pa.array(found.n_a), pa.array(found.n_b),
                    pa.array(found.n_groups, pa.int64()), pa.array(found.n_links, pa.int64()),
                    pa.array(found.digests, pa.string()),
                    pa.ListArray.from_arrays(ends, pa.array(found.pairs, pa.int64())),
                    pa.ListArray.from_arrays(ends, pa.array(found.times, pa.int32())),
                    pa.array(found.groups if texts else [None] * len(raws), pa.string()),
                ], names=["row", *_TYPES.names])

    schema = StructType([given.schema["row"], *_TYPES.fields])
    return given.mapInArrow(align, schema)


def _totals(rows: DataFrame, n_b: int) -> DataFrame:
    """``pair``, ``n`` links in all documents, and whether that is the most for its second id."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                pairs, times = (batch.column(i).flatten().to_numpy() for i in (0, 1))
                held.append((pairs, times.astype(np.int64)))
            if held and (batch is None or sum(len(p) for p, _ in held) > 1 << 21):
                names, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
                sums = np.bincount(place, np.concatenate([t for _, t in held])).astype(np.int64)
                held = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(sums)], names=["pair", "n"])

    parts = rows.select("pairs", "times").mapInArrow(add, "pair bigint, n bigint")
    totals = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    second = F.col("pair") % n_b
    most = totals.groupBy(second.alias("_b")).agg(F.max("n").alias("most"))
    return stored(totals.join(most, second == F.col("_b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    ), "align-totals")


def _frequent(totals: DataFrame, most: int):
    """The most frequent pairs, at most ``most`` of them: all that have some number of links."""
    by_size = totals.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).count().collect()
    taken, least = 0, None
    for e, n in sorted(((r["e"], r["count"]) for r in by_size), reverse=True):
        if taken + n > most:
            break
        taken, least = taken + n, e
    if least is None:
        return (np.empty(0, np.int64),) * 2
    rows = totals.filter(F.col("n") >= F.lit(1 << least)).toArrow()
    names = rows["pair"].to_numpy()
    order = np.argsort(names)
    # The count, and in its lowest bit whether it is the best.
    values = rows["n"].to_numpy() * 2 + rows["best"].to_numpy()
    return names[order], values[order]


def _counted(pairs, times, frequent):
    """Sums over a document's links, and the pairs whose counts were not at hand."""
    kind = pa.struct([("n_best", pa.int64()), ("count_sum", pa.int64()),
                      ("rest", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int32())])))])

    def few(pairs: pa.Array, times: pa.Array) -> pa.Array:
        names, values = frequent.value
        found, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(pairs)), np.diff(pairs.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(names, found), max(0, len(names) - 1))
        known = names[at] == found if len(names) else np.zeros(len(found), bool)
        value = values[at[known]]
        sums = [np.zeros(len(pairs), np.int64) for _ in range(2)]
        np.add.at(sums[0], doc[known], n[known] * (value & 1))
        np.add.at(sums[1], doc[known], n[known] * (value >> 1))
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc[~known], minlength=len(pairs)))])
        rest = pa.StructArray.from_arrays(
            [pa.array(found[~known], pa.int64()), pa.array(n[~known], pa.int32())],
            names=["pair", "times"])
        return pa.StructArray.from_arrays(
            [*map(pa.array, sums), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
            fields=list(kind),
        )

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint,"
                 "rest:array<struct<pair:bigint,times:int>>>")
    def counted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pairs, times in batches:
            parts = [few(pairs.slice(at, 256), times.slice(at, 256))
                     for at in range(0, len(pairs), 256)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return counted(pairs, times)


def align_tokens(
    df: DataFrame, text: str = "text", *, a_path: str, b_path: str, groups: bool = False,
    shared_pairs: int = SHARED_PAIRS,
) -> DataFrame:
    """Adds ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``
    to every row, and ``groups`` itself if asked for.

    ``a_path`` is a byte-level vocabulary of the tokenizers library, which encodes blank and text,
    ``b_path`` a sentencepiece model that adds the blank itself; strings of special tokens are ordinary
    text. A text that is null, empty or not given back byte by byte by both has no tokens: zeros, and
    empty ``groups`` with an empty digest. Groups lie between offsets where tokens of both end, written
    ``a1,a2|b1;a3|b2,b3``. A link is two tokens that share a byte; its count is the number of links of
    the same two ids in all rows, repeated rows included, and it is best if no other first id has more
    links with its second one.

    Other columns pass through, input columns of the new names are replaced. Bytes that are not UTF-8
    become U+FFFD. Empty in, empty out.
    """
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * groups
    added = ["n_best", "count_sum", *names]
    kept = [c for c in df.columns if c.lower() not in added]
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)] or [F.lit(0).alias("c0")])
    given = df.select(row.alias("row"), bytes_of(text).alias("raw"))
    rows = stored(
        _aligned(given, a_path, b_path, groups)
        .withColumn("key", F.monotonically_increasing_id()), "align-rows",
    )
    n_b = _pieces(b_path)
    totals = _totals(rows, n_b)
    frequent = df.sparkSession.sparkContext.broadcast(_frequent(totals, shared_pairs))
    summed = rows.select("row", "key", *names, _counted(F.col("pairs"), F.col("times"), frequent)
                         .alias("s"))
    summed = stored(summed.select("row", "key", *names, "s.*"), "align-sums")
    rare = summed.select("key", F.explode("rest").alias("r")).join(
        totals, F.col("r.pair") == F.col("pair")
    ).groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.col("r.times") * F.col("best").cast("bigint")).alias("_best"),
        F.sum(F.col("r.times") * F.col("n")).alias("_sum"),
    )
    done = summed.join(rare, F.col("key") == F.col("_key"), "left")
    return done.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], *names,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def _pieces(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
