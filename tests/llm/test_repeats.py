"""Repeated passages against a plain search of all stretches."""

import hashlib
import random

import pytest

from geoobs.llm import repeats


def brute(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for at in range(len(words) - window + 1):
                seq = tuple(words[at:at + window])
                first[seq] = min(i, first.get(seq, i))
    out = []
    for i, words in split:
        gone = set()
        if i is not None:
            for at in range(len(words) - window + 1):
                if first[tuple(words[at:at + window])] < i:
                    gone.update(range(at, at + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        spans, at = [], 0
        for k in sorted(gone):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((i, len(words), len(gone), spans, kept))
    return sorted(out, key=repr)


def found(spark, rows, window, columns="doc_id long, text string"):
    df = spark.createDataFrame(rows, columns).repartition(3)
    got = repeats.remove_repeats(df, window=window).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, [[s.start, s.end] for s in r.spans], r.kept_text)
         for r in got), key=repr)


@pytest.mark.parametrize("window", [1, 2, 5, 8])
def test_few_words(spark, window):
    """A small vocabulary: matches of all lengths, overlapping and within documents."""
    some = random.Random(window)
    rows = [(i, " ".join(some.choices("abcd", k=some.randrange(40)))) for i in range(60)]
    assert found(spark, rows, window) == brute(rows, window)


def test_planted_passages(spark):
    some = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    passage, other = some.choices(words, k=80), some.choices(words, k=50)
    rows = []
    for i in range(80):
        own = some.choices(words, k=some.randrange(120))
        middle = (passage, other, passage[10:60], passage[:49], other + passage, [])[i % 6]
        at = some.randrange(len(own) + 1)
        rows.append((i, "\t\n ".join(own[:at] + middle + own[at:])))
    copies = [(100 + i, rows[3][1]) for i in range(40)]
    near = [(200 + i, rows[4][1].replace(f"w{i}", "x", 1)) for i in range(40)]
    assert found(spark, rows + copies + near, 50) == brute(rows + copies + near, 50)


def test_edge_rows(spark):
    long = " ".join(f"v{i % 997}" for i in range(60_000))
    rows = [
        (None, "a b c d e f"), (1, None), (2, ""), (3, " \x0b\x0c\n"), (4, "a b c d e f"),
        (4, "a b c d e f"), (4, "x a b c d e f y"), (5, "a b c d e f"), (5, "b c d e f"),
        (6, "A b c d e f"), (7, "a b c d e f g"), (8, "é a b c d e"), (9, long), (10, long + " z"),
        (-3, "c d e f"),
    ]
    assert found(spark, rows, 4) == brute(rows, 4)


def test_clashing_columns_and_empty(spark):
    rows = [(i, "p q r s", "anchor", 1, 2, 3) for i in (2, 1)]
    got = found(spark, rows, 3, "doc_id long, text string, raw string, part int, doc int, ranges int")
    assert [(r[0], r[2]) for r in got] == [(1, 0), (2, 4)]
    assert found(spark, [], 3) == []


def test_query_digest(spark, tmp_path):
    from geoobs.llm import repeat_queries

    text = " ".join(f"w{i}" for i in range(55))
    spark.createDataFrame([(1, text), (2, "x " + text)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = repeat_queries.op11_substring_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 55, 0, hashlib.sha256(text.encode()).hexdigest()),
        (2, 56, 55, hashlib.sha256(b"x").hexdigest()),
    ]
