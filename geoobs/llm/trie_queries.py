"""The prefix trie query over the whole ``conversations`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import prefix_trie
from .common import table
from .registry import query


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string in SQL, bit by bit."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    eight = "list_reduce([v] || range(8), lambda c, i: " + step.format("c") + ")"
    return (
        f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split({text}, ''), "
        f"lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: "
        f"list_reduce([xor(a, b)] || range(8), lambda c, i: {step.format('c')})), 4294967295)"
    )


@query("op12_prefix_trie", f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, c - c % 5 AS b, {_crc32_sql('CAST(c AS VARCHAR)')} % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM (
    SELECT k.c, 0 AS part, i, role, text FROM k JOIN t ON t.c = k.b AND t.i <= k.h
    UNION ALL SELECT k.c, 1, i, role, text FROM k JOIN t ON t.c = k.c AND t.i > k.h)),
p AS (
  SELECT c, d, octet_length(encode(text)) AS bytes, list(struct_pack(r := role, t := text))
    OVER (PARTITION BY c ORDER BY d) AS seq FROM r
  UNION ALL SELECT c, 0, 0, [] FROM k),
m AS (SELECT c, d, bytes, min(c) OVER (PARTITION BY d, seq) AS top FROM p),
n AS (SELECT top, d, max(bytes) AS bytes, count(*) AS n_convs FROM m GROUP BY top, d),
up AS (SELECT n.*, m.top AS parent FROM n LEFT JOIN m ON m.c = n.top AND m.d = n.d - 1),
kids AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT up.*, coalesce(n_children, 0) AS n_children
  FROM up LEFT JOIN kids ON kids.parent = up.top AND kids.d = up.d),
sub AS (
  SELECT m.top, m.d, CAST(sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((f.n_convs - 1) * f.bytes) AS BIGINT) AS saved_tokens
  FROM full_ f JOIN m ON m.c = f.top AND m.d <= f.d GROUP BY m.top, m.d),
ends AS (
  SELECT top, d, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM m JOIN (SELECT c, max(d) AS d FROM m GROUP BY c) USING (c, d) GROUP BY top, d)
SELECT f.top AS conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id, f.n_convs,
  f.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_ f JOIN sub USING (top, d) LEFT JOIN ends USING (top, d)""")
def op12_prefix_trie(spark, sf_dir):
    """Nodes of all conversations rebuilt on the heads of every fifth one."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv = F.col("conv")
    nodes = prefix_trie.prefix_trie(
        given, base=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9,
        most_head=8,
    )
    return nodes.drop("stored_conv", "stored_position")
