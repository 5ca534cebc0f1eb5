"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams of a language by rank. A document's own list is
compared with each: every n-gram adds how far out of place it is, a missing one the most possible.
The nearest profile names the language.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, col, replace_columns, stored

LONGEST = 3
RANKS = 400
# Labelled rows of a language that a profile is learned from, about.
LEARN_ROWS = 5000
UNKNOWN = "und"
# Far more than there are; a column with more values is no language label.
MOST_LANGUAGES = 10_000
# Rows taken out of a batch at a time, so that it is not held twice.
SLICE = 256
# Characters whose n-grams are counted at a time; bounds memory on very long texts.
CHUNK = 1 << 18



_WORDS = re.compile(r"[^\W\d_]+")


def _check(longest: int) -> None:
    if not 1 <= longest <= 3:
        raise ValueError("n-grams have one to three letters")


def _bounded(languages: int) -> None:
    """What is sent to every task grows with the languages alone; their number has a limit."""
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages; at most {MOST_LANGUAGES} can be told apart")


def words_in(raw: bytes) -> list[str]:
    """Runs of letters, Unicode category L, in lower case."""
    text = raw.decode("utf-8", "replace").lower()
    if not text.isascii():
        # Numbers that count as word characters without being digits, such as fractions and numerals.
        others = [c for c in set(text) if c.isalnum() and unicodedata.category(c)[0] != "L"]
        if others:
            text = text.translate({ord(c): " " for c in others})
    return _WORDS.findall(text)


def gram_counts(words: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Letter n-grams of words in blanks, all lengths up to ``longest``, as codes with their counts.

    A code is the gram's characters, 21 bits each. Words stand one blank apart, so every pair of
    neighbours is a gram and every three but those with the blank in the middle; a lone blank is none.
    """
    found = []
    step = max(1, CHUNK // 8)
    for at in range(0, len(words), step):
        text = f" {' '.join(words[at:at + step])} "
        c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        blank = c == 32
        codes = [c[~blank]]
        if longest > 1:
            codes.append(c[:-1] << 21 | c[1:])
        if longest > 2:
            codes.append((c[:-2] << 42 | c[1:-1] << 21 | c[2:])[~blank[1:-1]])
        found.append(np.unique(np.concatenate(codes), return_counts=True))
    if len(found) == 1:
        return found[0]
    return _added(found)


def _added(parts) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several parts as one."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(codes), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([p[1] for p in parts]))
    return codes, counts


def code_of(gram: str) -> int:
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def gram_of(code: int) -> str:
    out = ""
    while code:
        out, code = chr(code & 0x1FFFFF) + out, code >> 21
    return out


def profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", *, longest: int = LONGEST,
    ranks: int = RANKS, rows_per_language: int = LEARN_ROWS,
) -> DataFrame:
    """The ``ranks`` most frequent n-grams of each language: ``lang``, ``gram``, ``rank`` (from 0).

    A language with more than ``rows_per_language`` labelled rows is learned from about that many,
    chosen by a hash of the text; smaller ones from all their rows. Rows without a language or a text
    teach nothing, repeated rows count each time. Ties go to the smaller n-gram. Tasks add up n-grams
    before the shuffle, so a language with most of the rows is no hot key. More than
    ``MOST_LANGUAGES`` languages are refused.
    """
    _check(longest)
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list] = {}
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                for language, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    parts.setdefault(language, []).append(gram_counts(words_in(raw), longest))
                for language, found in parts.items():
                    parts[language] = [_added(found)]
            for language, (found,) in parts.items():
                codes, counts = found
                yield pa.RecordBatch.from_arrays([
                    pa.array([language] * len(codes), pa.string()),
                    pa.array([gram_of(c) for c in codes.tolist()], pa.string()),
                    pa.array(counts, pa.int64()),
                ], schema=schema)

    rows = df.filter(col(lang).isNotNull() & col(text).isNotNull()).select(
        col(lang).cast("string").alias("lang"), bytes_of(text).alias("text")
    )
    sizes = stored(
        rows.groupBy(F.col("lang").alias("_l")).agg(F.count("*").alias("_n")), "language-sizes"
    )
    _bounded(sizes.count())
    chance = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003
    rows = rows.join(F.broadcast(sizes), F.col("lang") == F.col("_l")).filter(
        chance * F.col("_n") < rows_per_language
    ).select("lang", "text")
    counts = rows.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order) - 1)
    return ranked.filter(F.col("rank") < ranks).select("lang", "gram", "rank")


class Profiles:
    """Ranks of the known n-grams in every language."""

    def __init__(self, rows, longest: int, ranks: int):
        self.longest, self.ranks = longest, ranks
        self.langs = sorted({r["lang"] for r in rows})
        at = {x: i for i, x in enumerate(self.langs)}
        self.codes = np.array(sorted({code_of(r["gram"]) for r in rows}), dtype=np.int64)
        self.rank = np.full((len(self.codes), len(self.langs)), -1, dtype=np.int32)
        for r in rows:
            self.rank[np.searchsorted(self.codes, code_of(r["gram"])), at[r["lang"]]] = r["rank"]

    def predict(self, words: list[str]) -> tuple[str, float]:
        """Nearest language and its share of the places that could have been lost.

        The score is 1 for a document with the very order of the profile, 0 for one that shares
        nothing with it. Ties go to the smaller language name.
        """
        if not words or not self.langs:
            return UNKNOWN, 0.0
        codes, counts = gram_counts(words, self.longest)
        if len(codes) > self.ranks:
            least = np.partition(counts, -self.ranks)[-self.ranks]
            codes, counts = codes[counts >= least], counts[counts >= least]
        # Ties as in the profiles, by the gram's characters from the left.
        written = np.where(codes < 1 << 21, codes << 42, np.where(codes < 1 << 42, codes << 21, codes))
        top = codes[np.lexsort((written, -counts))][: self.ranks]
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        theirs = np.where((self.codes[at] == top)[:, None], self.rank[at], -1)
        own = np.arange(len(top))[:, None]
        total = np.where(theirs < 0, self.ranks, np.abs(theirs - own)).sum(0)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (self.ranks * len(top)))


def with_language(
    df: DataFrame, learned: DataFrame, text: str = "text", out: str = "lang_pred",
    score: str = "score", *, longest: int = LONGEST, ranks: int = RANKS,
) -> DataFrame:
    """Adds the nearest language of ``learned`` (made by ``profiles``) and a score from 0 to 1.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Whole texts
    count. Repeated rows get equal answers; input columns with an output's name are replaced. The
    profiles hold ``ranks`` rows a language; they alone are sent to the tasks.
    """
    _check(longest)
    learned = stored(learned, "language-profiles")
    _bounded(learned.select("lang").distinct().count())
    rows = learned.collect()
    known = df.sparkSession.sparkContext.broadcast(
        Profiles([r.asDict() for r in rows], longest, ranks)
    )
    both = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = known.value
        for batch in batches:
            found = [
                model.predict(words_in(raw))
                for at in range(0, len(batch), SLICE)
                for raw in batch.slice(at, SLICE).to_pylist()
            ]
            yield pa.array([{"lang": x, "score": s} for x, s in found], type=both)

    # Not to be repeated where a caller filters by the answer and also keeps it.
    predict = predict.asNondeterministic()
    guess = F.when(col(text).isNotNull(), predict(bytes_of(text)))
    with_guess = replace_columns(df, **{out: guess})
    return replace_columns(
        with_guess,
        **{score: F.coalesce(col(out)["score"], F.lit(0.0)),
           out: F.coalesce(col(out)["lang"], F.lit(UNKNOWN))},
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
