"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library encodes inside Arrow batches. A long text is first cut at safe boundaries so
that no call holds more than a bounded piece; the ids are those of the whole text. Decoding joins the
raw bytes of the tokens, so ids that end inside a character also decode.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from .common import bytes_of, col, fresh, replace_columns, rows_of

LONG_TEXT = 1 << 16

# No match of the pattern runs from a visible character into a following blank, and what follows the
# blank is matched alike with or without the text before it. The class names every character that any
# Unicode version calls white space.
_SAFE_CUT = re.compile("[^\\s\\x1c-\\x1f\u180e](?= )")


def pieces(text: str, limit: int) -> Iterator[str]:
    """Cuts ``text`` at safe boundaries into pieces of about ``limit`` characters.

    A stretch without a safe boundary stays whole, however long it is.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE_CUT.search(text, start + limit - 1)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


@lru_cache(maxsize=4)
def encoding(ranks_path: str):
    """The tiktoken encoding of a rank file, one for each worker process."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding(
        "local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encode_text(text: str, ranks_path: str, limit: int = LONG_TEXT) -> np.ndarray:
    enc = encoding(ranks_path)
    parts = [np.array(enc.encode_ordinary(p), dtype=np.int32) for p in pieces(text, limit)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(
    df: DataFrame, text: str = "text", out: str = "token_ids", *, ranks_path: str,
    long_text: int = LONG_TEXT,
) -> DataFrame:
    """Adds the token ids of every whole text as ``array<int>``.

    A null text counts as empty and gets an empty array. Strings of special tokens are ordinary text.
    Repeated rows are encoded one by one, an empty table stays empty, other columns pass through, and
    an input column called ``out`` is replaced. Bytes that are not UTF-8 become U+FFFD.
    """

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = [
                encode_text(raw.decode("utf-8", "replace"), ranks_path, long_text)
                for raw in rows_of(batch)
            ]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return replace_columns(df, **{out: ids_of(bytes_of(text))})


def decode(
    df: DataFrame, ids: str = "token_ids", out: str = "decoded", *, ranks_path: str
) -> DataFrame:
    """Adds the raw bytes that the ids stand for as ``binary``.

    A null array gives null, an empty one no bytes. An id outside the rank file fails the job, since
    no bytes would be right for it; so does a null id. An input column called ``out`` is replaced.
    """

    @F.arrow_udf("binary")
    def bytes_for(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(ranks_path)
        for batch in batches:
            flat = batch.values
            if flat.null_count:
                raise ValueError("a null is no token id")
            values, ends = flat.to_numpy(), batch.offsets.to_numpy()
            valid = batch.is_valid().to_pylist()
            yield pa.array(
                [
                    enc.decode_bytes(values[a:b].tolist()) if ok else None
                    for ok, a, b in zip(valid, ends, ends[1:])
                ],
                type=pa.binary(),
            )

    return replace_columns(df, **{out: bytes_for(col(ids))})


# Bytes of text whose ids make one output batch.
OUT_BYTES = 1 << 22


def encode_verified(
    df: DataFrame, text: str = "text", ids: str = "token_ids", same: str = "round_trip", *,
    ranks_path: str, keep: list[str], long_text: int = LONG_TEXT,
) -> DataFrame:
    """The columns ``keep``, the token ids of every whole text, and whether their bytes give it again.

    One pass encodes, decodes and compares a row at a time and hands on bounded batches, so that no
    ids wait for a second Python worker. Null texts, special strings, repeated rows and empty tables as
    in ``encode``; ``same`` compares with the text's bytes as given, so it is false where they are not
    UTF-8. Kept columns are passed through under any name but ``ids`` and ``same``.
    """
    kept = [c for c in keep if c.lower() not in (ids.lower(), same.lower())]
    given = df.select(*[col(c) for c in kept], bytes_of(text).alias(fresh(df, "raw")[0]))
    schema = StructType(
        list(given.schema.fields[:-1])
        + [StructField(ids, ArrayType(IntegerType())), StructField(same, BooleanType())]
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path)
        for batch in batches:
            raws = batch.column(batch.num_columns - 1)
            size = pc.binary_length(raws).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = (np.cumsum(size) - size) // OUT_BYTES
            starts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                found, alike = [], []
                for raw in rows_of(raws.slice(lo, hi - lo), 16):
                    found.append(encode_text(raw.decode("utf-8", "replace"), ranks_path, long_text))
                    alike.append(enc.decode_bytes(found[-1].tolist()) == raw)
                ends = pa.array(np.cumsum([0, *map(len, found)], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:-1]),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found))),
                     pa.array(alike, pa.bool_())],
                    names=[*kept, ids, same],
                )

    return given.mapInArrow(verify, schema)
