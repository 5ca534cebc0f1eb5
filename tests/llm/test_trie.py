"""Prefix tries against rebuilt conversations held in memory."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from geoobs.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def head_of(c):
    return zlib.crc32(str(c).encode()) % 9


def base_of(c):
    return c - (abs(c) % 5) * (1 if c >= 0 else -1)


def brute(rows):
    given = {}
    for c, turn, role, text in rows:
        if c is not None:
            given.setdefault(c, []).append(
                (turn is not None, turn or 0, role or "", text or ""))
    for c in given:
        given[c] = [t[2:] for t in sorted(given[c], key=lambda t: (
            t[0], t[1], t[2].encode(), t[3].encode()))]
    built = {c: given.get(base_of(c), [])[:head_of(c)] + own[head_of(c):]
             for c, own in given.items()}
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for seq, convs in members.items():
        below = [s for s in members if s[:len(seq)] == seq]
        children = [s for s in below if len(s) == len(seq) + 1]
        ends = sorted(c for c in convs if len(built[c]) == len(seq))
        out[min(convs), len(seq)] = (
            min(members[seq[:-1]]) if seq else None, len(convs), len(children),
            sum(not any(len(t) == len(s) + 1 and t[:len(s)] == s for t in below) for s in below),
            sum((len(members[s]) - 1) * len(s[-1][1].encode()) for s in below if s),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return out


def nodes(spark, rows, schema=SCHEMA):
    conv = F.col("conv")
    got = prefix_trie.prefix_trie(
        spark.createDataFrame(rows, schema), base=conv - conv % 5,
        head=F.crc32(conv.cast("string").cast("binary")) % 9, most_head=8,
    ).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                                  r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out, got


def test_random_conversations(spark):
    some = random.Random(3)
    rows = [(c, t, some.choice(["user", "assistant"]), some.choice(["a", "é", "", "long text"]))
            for c in range(-7, 40) if c % 7 for t in range(some.randrange(1, 12))]
    assert nodes(spark, rows)[0] == brute(rows)


def test_hot_conversation_and_common_turns(spark):
    """One conversation holds most turns, and many start alike."""
    rows = [(5, t, "user", f"t{t % 3}") for t in range(700)]
    rows += [(c, t, "user", "same" if t < 9 else f"own{c}") for c in range(10, 60) for t in range(10)]
    assert nodes(spark, rows)[0] == brute(rows)


def test_conversation_over_many_ranges(spark):
    """Products of ranges are put together in order."""
    rows = [(c, t, "user", f"{c % 2}-{t}") for c in (0, 5, 6) for t in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set(coalesce, "false")
    try:
        assert nodes(spark, rows)[0] == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(coalesce)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, "user", "null turn first"), (1, 0, None, None),
        (1, 0, None, None), (1, 2, "b", "x"), (1, 2, "a", "y"), (1, 2, "a", "x" * 50_000),
        (10, 0, "user", ""), (11, 0, "user", "late"), (13, 5, "|", "a"), (14, 5, "|a", ""),
        (12, 0, "user", "é"), (12, 0, "user", "z"), (12, 0, "user", "Z"),
    ]
    assert nodes(spark, rows)[0] == brute(rows)
    wide = [(*r, "n", 1, "v") for r in rows]
    got, _ = nodes(spark, wide, SCHEMA + ", node string, CONV int, value string")
    assert got == brute(rows)


def test_stored_turns_and_empty(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(9)] + [(1, t, "user", f"u{t}") for t in range(9)]
    _, got = nodes(spark, rows)
    for r in got:
        if r.depth:
            h = head_of(r.conv_id)
            assert r.stored_conv == (0 if r.depth <= h else r.conv_id)
            assert r.stored_position == r.depth
    assert nodes(spark, [])[0] == {}


def test_pieces_of_a_long_list_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(c, 0, "user", "hi") for c in range(0, 200, 5)] + [(1, 0, "user", "hi")]
    assert nodes(spark, rows)[0] == brute(rows)
