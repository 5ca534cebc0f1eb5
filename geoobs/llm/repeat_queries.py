"""The query of repeated passages over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import repeats
from .common import table
from .registry import query

WINDOW = 50


@query("op11_substring_dedup", f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS seq FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)),
first AS (SELECT seq, min(doc_id) AS least FROM windows GROUP BY seq),
hit AS (SELECT doc_id, i FROM windows JOIN first USING (seq) WHERE doc_id > least),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM hit)),
removed AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN words ELSE
    list_filter(words, lambda w, k: NOT list_contains(ps, k)) END, ' ')) AS kept_sha256
FROM split LEFT JOIN removed USING (doc_id)""")
def op11_substring_dedup(spark, sf_dir):
    """Words of repeated passages removed from every document but the first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = repeats.remove_repeats(docs, window=WINDOW)
    return done.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
