"""Clashing columns, very long texts and empty tables: operators and every stage of the pipeline."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from geoobs.llm import bpe, minhash, mixing, neighbours, secret_scan, token_counts, token_store, vector_dedup
from geoobs.llm.common import fresh

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
_SOME = random.Random(1)
LONG = " ".join(_SOME.choice(["alpha", "beta", "gamma", "delta", "über"]) + str(i % 7919)
                for i in range(80_000))


def test_token_columns_clash(spark):
    df = spark.createDataFrame([(1, "a b c", "n", 5, 7)],
                               "doc_id long, text string, N_Bytes string, token int, part int")
    counted = token_counts.with_token_counts(df, "text", vocabulary=VOCABULARY, limit=2).first()
    assert (counted["n_tokens"], counted["over_limit"], counted["token"], counted["part"]) == (3, True, 5, 7)
    wide = df.withColumnsRenamed({"N_Bytes": "segment", "token": "codes", "part": "first"})
    path = token_store.write(wide, vocabulary=VOCABULARY, end_id=0)
    (row,) = token_store.read_documents(spark, path).collect()
    assert (row.doc_id, row.start, row.n_tokens) == (1, 0, 4)


def test_vector_columns_clash(spark):
    rows = [(i, [float(i), 1.0], 7, "x", 0.5) for i in range(6)]
    df = spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, id int, vector string, AWAY double")
    got = vector_dedup.near_vectors(df).collect()
    assert sorted(r.vec_id for r in got) == list(range(6))
    near = neighbours.nearest_neighbours(df, top=2).collect()
    assert {(r.query_id, r.vec_id) for r in near if r["rank"] == 1} >= {(0, 1), (5, 4)}


def test_long_texts_are_near_duplicates(spark):
    other = LONG.replace("alpha77 ", "changed ")
    assert other != LONG
    df = spark.createDataFrame(
        [(1, LONG), (2, other), (3, LONG[: len(LONG) // 2]), (4, LONG)], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (1, False)}


def test_secrets_of_a_long_text(spark):
    (spans,) = fresh(spark.createDataFrame([], "x int"), "secrets")
    text = LONG + " password=hunter2222 " + LONG + " AKIA" + "Q" * 20
    df = spark.createDataFrame([(1, text), (2, LONG)], "doc_id long, text string")
    got = {r.doc_id: r[spans] for r in secret_scan.scan(df, "text", spans, key="doc_id").collect()}
    assert [text[s.start:s.end] for s in got[1]][:2] == ["password=hunter2222", "AKIA" + "Q" * 20] or [
        s.start for s in got[1]][:2] == [len(LONG) + 1, len(text) - 24]
    assert got[2] == []


def test_verified_encoding(spark):
    library = Tokenizer.from_file(VOCABULARY)
    texts = [None, "", "a b", "ünï 日本 🙂", "<|endoftext|>", LONG, "a b"]
    rows = [(i, t, i * 2, "kept", "raw") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TOKEN_IDS int, lang string, _raw string")
    done = bpe.encode_verified(df, ranks_path=RANKS, keep=["doc_id", "lang", "_raw", "TOKEN_IDS"])
    assert done.columns == ["doc_id", "lang", "_raw", "token_ids", "round_trip"]
    library.encode_special_tokens = True
    for r in done.collect():
        assert r.round_trip and r.lang == "kept"
        assert r.token_ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
    odd = df.selectExpr("doc_id", "cast(X'ff41' AS string) AS text").limit(1)
    assert bpe.encode_verified(odd, ranks_path=RANKS, keep=["doc_id"]).first()["round_trip"] is False
    assert bpe.encode_verified(df.limit(0), ranks_path=RANKS, keep=["doc_id"]).count() == 0


def test_mix_reports_the_sizes_that_sql_gives(spark):
    import duckdb

    some = random.Random(9)
    rows = [(i, " ".join(["w"] * some.randrange(40)) if i % 7 else None, some.choice(["a", "b", "é", None]))
            for i in range(300)]
    got = sorted((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in mixing.mix(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?)", rows)
    # Targets: rounds of sharing what is left by weight, each source up to twice its size.
    sizes = con.execute("""
        SELECT source, sum(n), row_number() OVER (ORDER BY source NULLS LAST) - 1 FROM (
          SELECT source, len(list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '')) AS n
          FROM d) GROUP BY source""").fetchall()
    weight = {s: (5, 2, 1)[k % 3] for s, _, k in sizes}
    size = {s: int(n) for s, n, _ in sizes}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(size)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    want = sorted((i, len((t or "").split()), size[s], round(target[s], 6)) for i, t, s in rows)
    assert got == want


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_an_empty_table(spark, name, stage):
    docs = spark.createDataFrame([], DOCS)
    out = stage(spark, docs, "")
    assert out.count() == 0
    assert name == "encode" or out.columns == docs.columns


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_with_odd_rows_and_clashing_columns(spark, name, stage):
    """Nulls, repeated rows, a very long text, and columns with names that the stages use inside."""
    text = "the quick brown fox jumps over the lazy dog and runs away from the old house again "
    rows = [(i, f"{text}{'xyz' * (i + 1)} " * 3, "en", "s", 1, "c", 2, "r") for i in range(6)]
    rows += [(2, rows[2][1], "en", "s", 1, "c", 2, "r"), (50, LONG, "en", None, 5, None, None, None),
             (60, None, None, None, None, None, None, None), (None, text, "en", "s", 1, "c", 2, "r"),
             (70, "", "en", "s", 0, "c", 2, "r")]
    docs = spark.createDataFrame(rows, DOCS + ", Lang_Pred string, component_id int, _secrets string")
    out = stage(spark, docs, "")
    got = out.collect()
    if name == "encode":
        assert len(got) == len(rows) and all(r.round_trip for r in got)
        assert {r.doc_id for r in got if r.n_tokens == 0} == {60, 70}
        return
    assert out.columns == docs.columns
    ids = [r.doc_id for r in got]
    assert 50 in ids and next(r.text for r in got if r.doc_id == 50) == LONG
    if name == "language":
        assert 60 not in ids and 70 not in ids and ids.count(2) == 2
    if name == "near_duplicates":
        assert sorted(i for i in ids if i is not None and i < 6) == list(range(6))
        assert {60, 70, None} <= set(ids)
    if name == "secrets":
        assert len(got) == len(rows)


def test_jittered_groups(spark):
    """A third of all vectors is one vector but for noise of several sizes."""
    rng = np.random.default_rng(2)
    n, dim = 1500, 32
    for noise in (1e-2, 1e-4, 1e-6):
        x = rng.normal(size=(n, dim))
        x[: n // 3] = x[0] + noise * rng.normal(size=(n // 3, dim))
        x[n - 1] = 1e9  # one far vector must not blur the others
        kind = "vec_id long, embedding array<double>"
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], kind)
        asked = df.filter("vec_id % 25 = 0")
        found = {}
        for r in neighbours.nearest_neighbours(df, asked).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        hits = []
        for i in range(0, n, 25):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            hits.append(len(found[i] & set(np.argsort(d, kind="stable")[:10].tolist())) / 10)
        assert np.mean(hits) >= 0.95, noise


def test_graph_does_not_switch_at_a_size():
    assert [neighbours.degree(n) for n in (1, 2_000, 10_000, 50_000, 1_000_000)] == [16, 18, 24, 28, 36]
    assert neighbours.orders(50_000) < neighbours.orders(50_000_000)
    assert neighbours.beam_width(10**4) < neighbours.beam_width(10**8)
