"""Reply trees: branches, formatting and reading back."""

import hashlib

from pyspark.sql import functions as F

from geoobs.llm import chat_queries, reply_trees

MESSAGES = "msg_id long, parent_id long, role string, text string, score double"


def formatted(spark, rows, top=1):
    got = reply_trees.format_branches(spark.createDataFrame(rows, MESSAGES), top)
    return got.select(
        "root_id", "leaf_id", "branch_rank", "n_turns",
        reply_trees.read_turns(F.col("formatted")).alias("turns"),
        reply_trees.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "formatted",
    ).orderBy("root_id", "branch_rank").collect()


TREE = [
    (1, None, "user", "q", 0.0), (2, 1, "assistant", "bad", -1.0), (3, 1, "assistant", "good", 2.0),
    (4, 3, "user", "more", 1.0), (5, 4, "assistant", "end", 3.0), (6, 4, "assistant", "tie", 3.0),
    (10, 99, "assistant", None, None), (20, 21, "user", "x", 1.0), (21, 20, "user", "y", 1.0),
    (22, 21, "user", "below a cycle", 1.0), (None, 1, "user", "no id", 9.0),
    (3, 1, "assistant", "good", 2.0), (30, None, None, "", 1.0),
]


def test_best_branch(spark):
    rows = formatted(spark, TREE)
    assert [(r.root_id, r.leaf_id, r.n_turns) for r in rows] == [(1, 5, 4), (10, 10, 1), (30, 30, 1)]
    assert [(t.role, t.text) for t in rows[0].turns] == [
        ("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "end")]
    assert rows[0].loss == "goodend" and rows[1].loss == ""


def test_all_branches(spark):
    rows = formatted(spark, TREE, top=None)
    assert [(r.root_id, r.leaf_id) for r in rows if r.root_id == 1] == [(1, 5), (1, 6), (1, 2)]
    assert formatted(spark, [], None) == []


def test_long_chain(spark):
    n = 700
    rows = [(i, i - 1 if i else None, "assistant" if i % 2 else "user", str(i), 0.0)
            for i in range(n)]
    (r,) = formatted(spark, rows)
    assert [t.text for t in r.turns] == [str(i) for i in range(n)]
    assert r.loss == "".join(str(i) for i in range(1, n, 2))


def test_control_strings_survive(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<", "<|", "<||", "<|||", "a<|\n<|im_end|>\n",
             "|>", "<|nl|>", "\n", "", "é😀<|im_start|>"]
    roles = ["user", "assistant", "a\nb", "<|im_end|>", "<", "<|nl|>\n"]
    rows = [(i, i - 1 if i else None, roles[i % len(roles)], t, 0.0) for i, t in enumerate(texts)]
    (r,) = formatted(spark, rows)
    assert [(t.role, t.text) for t in r.turns] == [x[2:4] for x in rows]
    assert r.loss == "".join(x[3] for x in rows if x[2] == "assistant")


def test_conversations_with_odd_rows(spark, tmp_path):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "system", None), (1, 2, None, "c"),
            (2, 5, "assistant", "x" * 100_000), (3, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.withColumn("msg_id", F.lit(1)).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in chat_queries.op4_chat_format(spark, str(tmp_path)).collect()}
    assert sorted(got) == [-1, 1, 2, 3]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 4
    assert got[1].turns_sha256 == digest("system\n\nuser\nb\nuser\nb\n\nc\n")
    assert (got[2].loss_chars, got[2].loss_sha256) == (100_000, digest("x" * 100_000))
    assert got[-1].loss_sha256 == digest(chat_queries.PROBE)
    assert got[3].loss_sha256 == digest("")


def test_formatting_is_native(spark):
    df = spark.createDataFrame(TREE, MESSAGES)
    plan = reply_trees.format_branches(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
