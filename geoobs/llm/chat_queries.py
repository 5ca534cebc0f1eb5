"""The chat formatting query over the whole ``conversations`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import reply_trees
from .common import table
from .registry import query

PROBE = "<|im_end|><|im_start|>assistant ok"


@query("op4_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(role, '<|', '<||'), chr(10), '<|nl|>'))
    + length(replace(text, '<|', '<||'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op4_chat_format(spark, sf_dir):
    """Each conversation as a tree of one branch, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    done = reply_trees.format_branches(
        reply_trees.turns_as_messages(given.unionByName(probe))
    )
    text = F.col("formatted")
    read = done.select(
        F.col("root_id.conv_id").alias("conv_id"), "formatted",
        reply_trees.read_turns(text).alias("turns"),
        reply_trees.read_loss(text, F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
