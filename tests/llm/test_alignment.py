"""Token alignment against the libraries on whole texts and a plain pairwise walk."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from geoobs.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """All columns of ``align_tokens``, from whole encodings and byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {}
    for code in (*range(128), *range(0x80, 0x800)):
        for byte, letter in zip(chr(code).encode(),
                                ByteLevel(add_prefix_space=False, use_regex=False)
                                .pre_tokenize_str(chr(code))[0][0]):
            letters[letter] = byte
    letters |= {chr(b): b for b in range(0xE0, 0x100) if chr(b) not in letters}

    def ranges(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    docs = []
    for text in texts:
        given = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_parts = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_parts = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode() for i in b
        ]
        if not text or b"".join(a_parts) != given or b"".join(b_parts) != given:
            docs.append(([], [], 0, [], ""))
            continue
        ra, rb = ranges(a_parts), ranges(b_parts)
        owner = [[j for _ in range(y[0], y[1])] for j, y in enumerate(rb)]
        owner = [j for js in owner for j in js]  # the second side's token of every byte
        links = [(a[i], b[j]) for i, x in enumerate(ra) for j in sorted(set(owner[x[0]:x[1]]))]
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        sides = [([*zip(t, r)], [e for _, e in r]) for t, r in ((a, ra), (b, rb))]
        written = ";".join(
            "|".join(
                ",".join(str(t) for t, _ in ends[bisect_right(by, lo):bisect_right(by, hi)])
                for ends, by in sides
            ) for lo, hi in zip([0, *cuts], cuts)
        )
        docs.append((a, b, len(cuts), links, written))
    count = Counter(p for d in docs for p in d[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (len(a), len(b), cuts, len(links), sum(count[p] == best[p[1]] for p in links),
         sum(count[p] for p in links),
         hashlib.sha256(written.encode()).hexdigest() if written else "", written)
        for a, b, cuts, links, written in docs
    ]


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "Hello world, hello  world.\n\nTwo lines\tand tabs ",
    "naïve café – ﬁne Å Å 日本語 🙂🙂 Привет мир", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "blank▁mark", "x" * 300, "word " * 700, " \n \n", "　wide blank", "1234567890 3.14159",
    "don't DON'T we'll", "Hello world, hello  world.\n\nTwo lines\tand tabs ", "\x00nul\x00",
    "a" + " " * 40 + "b", "naïve café – ﬁne Å Å 日本語 🙂🙂 Привет мир",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def answers(spark, texts, shared_pairs=alignment.SHARED_PAIRS):
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_A int, row string").repartition(3)
    got = alignment.align_tokens(
        df, "text", a_path=A, b_path=B, groups=True, shared_pairs=shared_pairs
    )
    assert got.columns[:3] == ["doc_id", "text", "row"]
    return [tuple(r[c] for c in COLUMNS) for r in got.orderBy("doc_id").collect()]


@pytest.mark.parametrize("shared_pairs", [alignment.SHARED_PAIRS, 5, 0])
def test_against_whole_encodings(spark, shared_pairs):
    """Counts are the same however many pairs are sent to the tasks."""
    got, want = answers(spark, TEXTS, shared_pairs), brute(TEXTS)
    for text, g, w in zip(TEXTS, got, want):
        assert g == w, text


def test_random_texts(spark):
    some = random.Random(5)
    letters = "ab é日\n\t  .,'1<▁  🙂Ωß"
    texts = ["".join(some.choices(letters, k=some.randrange(60))) for _ in range(150)]
    assert answers(spark, texts) == brute(texts)


def test_long_text(spark):
    """Several lanes, and a stretch without blanks."""
    some = random.Random(6)
    words = ["alpha", "überlang", "x" * 90, "don't", "42", "日本", "tokenization", "\n"]
    text = " ".join(some.choices(words, k=4000)) + "y" * 20000
    assert answers(spark, [text, "short"]) == brute([text, "short"])


def test_lanes_do_not_show():
    some = random.Random(7)
    bounds = [sorted(some.sample(range(1, 5000), 900) + [5000]) for _ in range(2)]
    ends = [np.array(b, dtype=np.int64) for b in bounds]
    whole = alignment.lockstep(*ends, lane=10**6)
    for lane in (1, 7, 64):
        parts = alignment.lockstep(*ends, lane=lane)
        assert sorted(zip(*whole[:2])) == sorted(zip(*parts[:2]))
        assert [x.tolist() for x in whole[2:]] == [x.tolist() for x in parts[2:]]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokens(none, a_path=A, b_path=B).count() == 0
    only = spark.createDataFrame([("a b",)], "text string")
    got = alignment.align_tokens(only.select(F.col("text")), a_path=A, b_path=B).first()
    assert got["text"] == "a b" and got["n_groups"] == 2
