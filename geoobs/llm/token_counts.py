"""Token counts with a whole-token shortcut.

Before any text is read, every string of the vocabulary is run through the merges alone; those that
come back as one token form the proven set. A pre-token of that set counts one without any merging;
only the rest goes through the library's merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, col, replace_columns, rows_of
from .units import Pretokens, Remembered, split_units

# Units whose count is remembered by a worker; bounds its memory, not what is counted.
REMEMBERED = 300_000


class Counter:
    """Counts tokens as the tokenizers library does for a vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"] if t["content"]]
        pre = spec["pre_tokenizer"] or {}
        self.direct = (
            spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        if self.direct:
            self.pretokens = Pretokens(self.library)
            self.proven = self.prove()
            self.units = Remembered(self.after_blank, REMEMBERED)

    def prove(self) -> frozenset[str]:
        """Vocabulary strings that encode alone as exactly one token."""
        merges = self.library.model.tokenize
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        return frozenset(s for s in vocabulary if len(merges(s)) == 1)

    def tokens(self, pretokens: list[str]) -> int:
        merges = self.library.model.tokenize
        return sum(1 if p in self.proven else len(merges(p)) for p in pretokens)

    def after_blank(self, unit: str) -> int:
        return self.tokens(self.pretokens.after_blank(unit))

    def count(self, text: str) -> int:
        if not self.direct or any(s in text for s in self.special):
            # Added tokens are taken out of the text before it is split; the library does that.
            return len(self.library.encode(text, add_special_tokens=False).ids)
        first, *rest = split_units(text)
        self.units.trim()
        return self.tokens(self.pretokens(first)) + sum(map(self.units.__getitem__, rest))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


@lru_cache(maxsize=2)
def _pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_text(text: str, path: str) -> int:
    if path.endswith(".model"):
        return len(_pieces_model(path).encode(text))
    return counter(path).count(text)


def with_token_counts(
    df: DataFrame, text: str = "text", *, vocabulary: str, limit: int,
    n_tokens: str = "n_tokens", n_bytes: str = "n_bytes", over_limit: str = "over_limit",
) -> DataFrame:
    """Adds bytes, tokens and whether the tokens exceed ``limit``, over whole texts.

    Counts equal those of the tokenizers library (``.json``) or sentencepiece (``.model``, without a
    shortcut) with no special tokens added and nothing truncated; special strings inside a text are
    handled as the library does by default. A null text counts as empty: 0 tokens. Vocabularies that
    are not plain byte-level BPE are counted by the library alone. Repeated rows are counted one by
    one, empty tables stay empty, and input columns with an output's name are replaced.
    """

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(
                [count_text(raw.decode("utf-8", "replace"), vocabulary)
                 for raw in rows_of(batch)],
                type=pa.int64(),
            )

    raw = bytes_of(text)
    counted = replace_columns(
        df, **{n_bytes: F.octet_length(raw).cast("long"), n_tokens: tokens(raw)}
    )
    return replace_columns(counted, **{over_limit: col(n_tokens) > limit})
