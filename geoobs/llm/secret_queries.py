"""The secret scan query over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import secret_scan
from .common import table
from .registry import query

KINDS = [r.kind for r in secret_scan.RULES]


def _hits_sql() -> str:
    """Matches of every rule with the pieces before them, one after the other."""
    each = []
    for n, r in enumerate(secret_scan.RULES):
        p = r.pattern.replace("'", "''")
        each.append(
            f"SELECT row, '{r.kind}' AS kind, {n} AS ord, {r.least} AS least, "
            f"generate_subscripts(string_split_regex(t, '{p}'), 1) AS i, "
            f"unnest(string_split_regex(t, '{p}')) AS gap, "
            f"unnest(regexp_extract_all(t, '{p}', 0)) AS hit, "
            f"unnest(regexp_extract_all(t, '{p}', {r.group})) AS value FROM d"
        )
    return " UNION ALL ".join(each)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({_hits_sql()}),
ends AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY row, kind ORDER BY i) AS e
  FROM hits WHERE hit IS NOT NULL),
spans AS (SELECT row, kind, ord, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e
  FROM ends WHERE length(value) >= least)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
  count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord), ''))
    AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord), '') AS spans
FROM d LEFT JOIN spans USING (row) GROUP BY row, doc_id"""


@query("op7_secret_scan", SQL)
def op7_secret_scan(spark, sf_dir):
    """Secrets of every text; the trigram index adds no kinds of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, "text", "secrets", key="doc_id")
    listed = F.array_join(F.transform("secrets", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")
    count = lambda kind: F.size(F.filter(
        "secrets", lambda s: s["kind"] == kind)).cast("long")
    found = found.withColumn("spans", listed)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2("spans", 256).alias("base_sha256"), "spans",
    )
