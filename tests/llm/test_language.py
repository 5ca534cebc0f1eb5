"""Language prediction against the out-of-place distance written out plainly."""

import random
import unicodedata
from collections import Counter

import pytest

from geoobs.llm import lang_id


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c)[0] == "L":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_order(counts, ranks):
    return sorted(counts, key=lambda g: (-counts[g], g))[:ranks]


def plain_counts(words):
    out = Counter()
    for w in words:
        p = f" {w} "
        out.update(p[i:i + n] for n in (1, 2, 3) for i in range(len(p) - n + 1) if p[i:i + n] != " ")
    return out


def plain_profiles(rows, ranks):
    counts = {}
    for text, lang in rows:
        if lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(plain_counts(plain_words(text)))
    return {x: plain_order(c, ranks) for x, c in counts.items() if c}


def plain_guess(text, profiles, ranks):
    words = plain_words(text)
    if not words or not profiles:
        return "und", 0.0
    own = plain_order(plain_counts(words), ranks)
    best = min(
        (sum(abs(p.index(g) - i) if g in p else ranks for i, g in enumerate(own)), x)
        for x, p in profiles.items()
    )
    return best[1], 1 - best[0] / (ranks * len(own))


@pytest.mark.parametrize("ranks", [8, 60])
def test_predictions(spark, ranks):
    some = random.Random(ranks)
    letters = {"xx": "abcdeé", "yy": "defghß", "zz": "abgh日本", "ww": "opqr"}

    def text(alphabet):
        words = ["".join(some.choices(alphabet, k=some.randrange(1, 7))) for _ in range(some.randrange(1, 25))]
        return some.choice([" ", ", ", " 12 ", "½"]).join(words)

    rows = [(text(letters[x]), x) for x in letters for _ in range(12)]
    rows += [(None, "xx"), ("12 ½", "yy"), ("lost", None)]
    odd = [None, "", "½ ² ①", "Ⅷ", "123 !!", "Ⅷa½b", "QR op", "é" * 500, "日 本一", "a_b c-d", "ÀÉ ⅷ"]
    asked = odd + [text(letters[some.choice(list(letters))] + "xé") for _ in range(60)]
    learned = lang_id.profiles(spark.createDataFrame(rows, "text string, lang string"), ranks=ranks)
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.with_language(df, learned, ranks=ranks).collect()}
    profiles = plain_profiles(rows, ranks)
    for i, t in enumerate(asked):
        want = plain_guess(t, profiles, ranks)
        assert got[i][0] == want[0] and got[i][1] == pytest.approx(want[1], abs=1e-12), t
    assert [got[i][0] for i in range(5)] == ["und"] * 5


def test_clashing_columns(spark):
    learned = lang_id.profiles(spark.createDataFrame(
        [("ab ab", "x", "n")], "text string, lang string, gram string"))
    df = spark.createDataFrame([(1, "ab", "n", 7, 2.0)],
                               "doc_id long, text string, rank string, Lang_Pred int, SCORE double")
    got = lang_id.with_language(df, learned)
    assert sorted(got.columns) == ["doc_id", "lang_pred", "rank", "score", "text"]
    assert (got.first()["lang_pred"], got.first()["rank"]) == ("x", "n")
