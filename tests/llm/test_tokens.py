"""Encoding, counting and storing tokens against the libraries themselves."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geoobs.llm import bpe, token_counts, token_store, units

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
TEXTS = [
    None, "", " ", "a", "two  blanks\n\n and lines ", "Größe, élan; niño's 12345", "中文字 😀😀",
    "<|endoftext|> is text <|endoftext|>", "x" * 3000, "wörd " * 4000, "\x1c \x85 \xa0  z",
]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def frame(spark, texts=TEXTS):
    rows = [(i, t, f"kept {i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, Token_IDs string")


def test_encode_and_decode(spark, reference):
    docs = frame(spark).unionAll(frame(spark).limit(3))
    ids = bpe.encode(docs, ranks_path=RANKS, long_text=100)
    assert ids.columns == ["doc_id", "text", "token_ids"]  # the clashing column is replaced
    rows = bpe.decode(ids, ranks_path=RANKS).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = r.text or ""
        assert r.token_ids == reference.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_decode_null_and_partial_characters(spark):
    half = bpe.encode(frame(spark, ["😀"]), ranks_path=RANKS).first().token_ids[:1]
    df = spark.createDataFrame([(half,), (None,), ([],)], "token_ids array<int>")
    got = [r.decoded for r in bpe.decode(df, ranks_path=RANKS).collect()]
    assert got[1] is None and bytes(got[2]) == b""
    assert "😀".encode().startswith(bytes(got[0]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1' \n\t.é\xa0\x1c\x85,中"), max_size=40), st.integers(1, 9))
def test_pieces_never_change_the_ids(reference, text, limit):
    cut = list(bpe.pieces(text, limit))
    assert "".join(cut) == text
    assert sum((reference.encode_ordinary(p) for p in cut), []) == reference.encode_ordinary(text)


def test_empty_table(spark):
    none = frame(spark, [])
    assert bpe.encode(none, ranks_path=RANKS).count() == 0
    assert token_counts.with_token_counts(none, vocabulary=VOCABULARY, limit=3).count() == 0
    path = token_store.write(none, vocabulary=VOCABULARY, end_id=0)
    assert token_store.read_documents(spark, path).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=st.sampled_from("ab1' \n.éßĀ½ªº中😀\xa0"), max_size=60))
def test_units_equal_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert token_counts.count_text(text, VOCABULARY) == len(ids)
    packed = token_store.encoder(VOCABULARY).encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids


def test_proven_tokens_are_single():
    proven = token_counts.counter(VOCABULARY).proven
    assert 40_000 < len(proven) <= LIBRARY.get_vocab_size()


def test_counts(spark):
    got = token_counts.with_token_counts(frame(spark), vocabulary=VOCABULARY, limit=512).collect()
    for r in got:
        n = len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_other_vocabularies(name):
    path, text = public_tokenizers.path(name), "Hello  wörld, again 😀"
    if name.endswith(".json"):
        want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    else:
        import sentencepiece

        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    assert token_counts.count_text(text, path) == want


@pytest.mark.parametrize("n", [1, 511, 512, 513, 5000])
def test_codes_give_every_id_alone(n):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    codes = token_store.Codes(token_store.pack(ids))
    assert len(codes) == n
    assert [codes[i] for i in range(n)] == ids.tolist()
    for _ in range(20):
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert codes.slice(int(a), int(b)).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        codes[n]


def test_store_round_trip_and_random_access(spark):
    texts = TEXTS + ["again"] * 5
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = spark.createDataFrame([(10 * i, texts[i]) for i in order], "doc_id long, text string")
    path = token_store.write(docs, vocabulary=VOCABULARY, end_id=0, segment_ids=64)
    read = {r.doc_id: r for r in token_store.read_documents(spark, path).collect()}
    at, every = 0, []
    for i, text in enumerate(texts):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]
        raw = np.array(ids, "<u4").tobytes()
        r = read[10 * i]
        assert (r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) == (at, len(ids), zlib.crc32(raw))
        at, every = at + len(ids), every + ids
    asked = [0, 1, 70, len(every) - 1, len(every), -1]
    positions = spark.createDataFrame([(p,) for p in asked], "position long")
    got = {r.position: r.token_id for r in token_store.token_at(positions, path).collect()}
    assert got == {p: every[p] if 0 <= p < len(every) else None for p in asked}


def test_store_keeps_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")],
                                 "doc_id long, text string")
    path = token_store.write(docs, vocabulary=VOCABULARY, end_id=0)
    rows = sorted(token_store.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 1]
    assert [r.start for r in rows] == [0, 2, 4, 6]


def test_store_asks_for_a_pretoken_once(monkeypatch):
    asked, merge = [], token_store.Encoder.merge

    def counted(self, pretoken):
        asked.append(pretoken)
        return merge(self, pretoken)

    monkeypatch.setattr(token_store.Encoder, "merge", counted)
    encoder = token_store.Encoder(VOCABULARY)
    for text in ("so aqua aqua, niño (aqua", "so niño! aqua. aqua; (niño"):
        assert encoder.encode(text) == encoder.whole(text)
    assert len(asked) == len(set(asked))


def test_store_remembers_few_characters():
    rng, encoder = random.Random(5), token_store.Encoder(VOCABULARY)
    for letters in ("abcde", "абвгд"):
        encoder.encode(" ".join("".join(rng.choices(letters, k=3000)) for _ in range(1500)))
    encoder.encode("end")
    held = [d for d in vars(encoder).values() if isinstance(d, units.Remembered)]
    assert sum(len(key) for d in held for key in d) < 1 << 23


def test_store_cuts_texts_with_marks_at_once():
    encoder = token_store.Encoder(VOCABULARY)
    for mark in map(chr, range(0x2010, 0x2028)):
        text = f"{mark}a {mark}é{mark}{mark} 1{mark}s \n{mark} .{mark}'s{mark} {mark}"
        assert encoder.encode(text) == encoder.whole(text)
    assert not encoder.units
    for other in "\u2000\u200b\u200f\u2028\u2029\u202f\u2030あ":
        text = f"a {other}é{other} 1{other}\n"
        assert encoder.encode(text) == encoder.whole(text)
