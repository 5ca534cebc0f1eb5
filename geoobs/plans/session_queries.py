"""Access sessions, delivery records and the query log (E13-E14, F11-F13, J7-J10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import blocks, delivery, passport, sessions, windows
from . import adapters as A
from .registry import query

KEYS = ["ip", "store", "session_no"]


def _tracked(t):
    return sessions.tracked(A.access(t))


def _chunks(t):
    return sessions.with_session(_tracked(t), idle=A.IDLE)


@query("access_sessions", f"""WITH {A.SESSIONS_SQL}
SELECT ip, store, session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_chunks, sum(size)::BIGINT AS n_bytes
FROM numbered GROUP BY ALL""")
def access_sessions(t):
    return sessions.sessions(_tracked(t), idle=A.IDLE)


@query("sessions_with_close", f"""WITH {A.ACCESS_SQL}, x AS (
  SELECT *, coalesce(sum(CASE WHEN event = 'close' THEN 1 ELSE 0 END) OVER (PARTITION BY ip, store ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
  FROM access),
 c AS (SELECT * FROM x WHERE event <> 'close'),
 s AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {A.IDLE} SECOND OR epoch <> lag(epoch) OVER w THEN 1 ELSE 0 END AS opens
  FROM c WINDOW w AS (PARTITION BY ip, store ORDER BY ts, seq)),
 n AS (SELECT *, sum(opens) OVER (PARTITION BY ip, store ORDER BY ts, seq)::BIGINT AS session_no FROM s)
SELECT ip, store, session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_chunks, sum(size)::BIGINT AS n_bytes FROM n GROUP BY ALL""")
def sessions_with_close(t):
    return sessions.sessions_with_close(A.access(t), idle=A.IDLE).drop("closed")


@query("session_groups", f"""WITH {A.SESSIONS_SQL}
SELECT ip, store, session_no, group_path AS "group", count(*) AS n_chunks FROM numbered WHERE group_path IS NOT NULL GROUP BY ALL""")
def session_groups(t):
    return sessions.session_members(_chunks(t), KEYS, "group")


@query("session_arrays", f"""WITH {A.SESSIONS_SQL}
SELECT ip, store, session_no, array_name AS "array", count(*) AS n_chunks FROM numbered WHERE array_name IS NOT NULL GROUP BY ALL""")
def session_arrays(t):
    return sessions.session_members(_chunks(t), KEYS, "array")


@query("chunk_manifest", f"""WITH {A.SESSIONS_SQL}
SELECT ip, store, session_no, array_path, count(*) AS chunk_count, sum(size)::BIGINT AS size_bytes,
  sha256(string_agg(sha256, chr(10) ORDER BY sha256)) AS manifest_sha256 FROM numbered GROUP BY ALL""")
def chunk_manifest(t):
    return passport.bounded_manifest(_chunks(t), KEYS, "array_path", "sha256", "size")


@query("store_manifest", f"""WITH {A.SESSIONS_SQL}
SELECT store, array_path, count(*) AS chunk_count, sum(size)::BIGINT AS size_bytes,
  sha256(string_agg(sha256, chr(10) ORDER BY sha256)) AS manifest_sha256 FROM tracked GROUP BY ALL""")
def store_manifest(t):
    return passport.manifest(_tracked(t), ["store"], "array_path", "sha256", "size")


@query("store_manifest_tree", f"""WITH {A.SESSIONS_SQL}, c AS (
  SELECT store, array_path, sha256, count(*) AS n, sum(size)::BIGINT AS b FROM tracked GROUP BY ALL),
 r AS (SELECT store, array_path, sha256[1:3] AS range, sum(n) AS n, sum(b) AS b, sha256(string_agg(sha256 || ':' || n, chr(10) ORDER BY sha256)) AS d FROM c GROUP BY ALL)
SELECT store, array_path, sum(n)::BIGINT AS chunk_count, sum(b)::BIGINT AS size_bytes, sha256(string_agg(range || ':' || d, chr(10) ORDER BY range)) AS root_sha256
FROM r GROUP BY ALL""")
def store_manifest_tree(t):
    """Digest trees of all arrays: made of the first chunks, then brought up to date with the rest."""
    keys, columns = ["store"], ("array_path", "sha256", "size")
    rows = _tracked(t)
    old, new = rows.filter(F.col("seq") % 5 != 0), rows.filter(F.col("seq") % 5 == 0)
    ranges = passport.range_digests(old, keys, *columns)
    ranges = passport.updated_ranges(ranges, old, new, keys, *columns)
    return passport.root_digests(ranges, keys, "array_path")


def _log(t):
    """A query log: each client's accesses, selections and masks in order."""
    e = A.access(t).withColumn("session", F.col("user_id").cast("string"))
    numbered = blocks.with_position(e, ["session"], "ts", ["seq"], "entry")
    op = (
        F.when(F.col("k") < 40, "access").when(F.col("k") < 60, "sel")
        .when(F.col("k") < 80, "isel").otherwise("where")
    )
    survivors = F.when(
        F.col("k") >= 80,
        F.transform(F.sequence(F.lit(0), F.col("k") % 4), lambda i: (
            (F.col("user_id") + i * 7).cast("string"))),
    )
    return numbered.select(
        "session", F.col("entry").alias("seq"), op.alias("op"),
        F.when(F.col("k") % 2 == 0, "NEE").otherwise("GPP").alias("variable"),
        F.col("store").alias("group"), survivors.alias("surviving_stations"),
    )


_LOG_SQL = f"""{A.ACCESS_SQL}, log AS (
  SELECT user_id::VARCHAR AS session, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) - 1 AS seq,
    CASE WHEN k < 40 THEN 'access' WHEN k < 60 THEN 'sel' WHEN k < 80 THEN 'isel' ELSE 'where' END AS op,
    CASE WHEN k % 2 = 0 THEN 'NEE' ELSE 'GPP' END AS variable, store AS grp, k, user_id FROM access)"""


@query("compact_query_log", f"""WITH {_LOG_SQL}
SELECT session, seq, op, variable, grp AS "group" FROM log WINDOW w AS (PARTITION BY session ORDER BY seq)
QUALIFY NOT (op = 'access' AND coalesce(lead(op) OVER w IN ('sel', 'isel') AND lead(variable) OVER w = variable AND lead(grp) OVER w = grp, false))""")
def compact_query_log(t):
    return windows.compact_queries(_log(t).drop("surviving_stations")).select(
        "session", "seq", "op", "variable", "group"
    )


@query("surviving_stations", f"""WITH {_LOG_SQL}
SELECT session, arg_max(s, seq) AS stations FROM (
  SELECT session, seq, array_to_string(list_transform(range(0, k % 4 + 1), lambda i: (user_id + i * 7)::VARCHAR), ',') AS s FROM log WHERE k >= 80) GROUP BY session
UNION ALL SELECT session, NULL FROM log GROUP BY session HAVING max(k) < 80""")
def surviving_stations(t):
    last = windows.last_surviving(_log(t), "session", "seq", "surviving_stations")
    return last.select("session", F.array_join("surviving_stations", ",").alias("stations"))


def _candidates(t):
    s = A.stations(t)
    return s.select(
        F.col("station_id").cast("string").alias("station"), F.col("name").alias("site_name"),
        "lat", "lon", F.col("height").cast("double").alias("intake_height"),
        F.col("country").cast("string").alias("country"),
        F.concat(F.lit("https://hdl.handle.net/11676/"), F.col("country").cast("string")).alias(
            "source_doi"),
        F.lit("").alias("station_url"), F.concat(F.lit("Citation of "), "name").alias("citation"),
        F.concat("trigram", F.lit(".nc")).alias("dataset_name"),
    )


_ENTITY_SQL = f"""{_LOG_SQL}, {A.STATIONS_SQL}, last AS (
  SELECT session, arg_max(s, seq) AS s FROM (
    SELECT session, seq, list_transform(range(0, k % 4 + 1), lambda i: user_id + i * 7) AS s FROM log WHERE k >= 80) GROUP BY session),
 ent AS (SELECT l.session, s.station_id::VARCHAR AS identifier, s.* FROM (SELECT session, unnest(s) AS id FROM last) l JOIN stations s ON s.station_id = l.id)"""


def _entities(t):
    last = windows.last_surviving(_log(t), "session", "seq", "surviving_stations")
    return passport.station_entities(_candidates(t), last, "session", "surviving_stations")


@query("station_entities", f"""WITH {_ENTITY_SQL}
SELECT session, '#station/' || identifier AS id, identifier, name, lat, lon FROM ent""")
def station_entities(t):
    return _entities(t).select("session", "id", "identifier", "name", "lat", "lon")


@query("source_objects", f"""WITH {_ENTITY_SQL}
SELECT session, 'https://hdl.handle.net/11676/' || country AS id, arg_min('Citation of ' || name, identifier) AS citation,
  arg_min(trigram || '.nc', identifier) AS dataset_name FROM ent GROUP BY ALL""")
def source_objects(t):
    return passport.source_objects(_entities(t), "session", _candidates(t))


def _passports(t):
    provenance = t.nation.select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("group"),
        F.concat(F.lit("https://doi.org/10.1/"), "n_name").alias("source_doi"),
        F.col("n_name").alias("citation"),
    )
    rows = passport.detailed_manifest(_chunks(t), KEYS)
    return passport.assemble(rows, provenance, KEYS)


@query("passport_rows", f"""WITH {A.SESSIONS_SQL}, g AS (
  SELECT ip, store, session_no, arg_min(n_name, group_path) AS citation FROM numbered
  JOIN nation ON 'S' || n_nationkey = split_part(group_path, '/', 1) GROUP BY ALL)
SELECT n.ip, n.store, n.session_no, 'Data access passport — ' || coalesce(array_to_string(list_sort(list(DISTINCT array_name) FILTER (WHERE array_name IS NOT NULL))[1:5], ', '), '')
    || ' (' || strftime(min(ts), '%Y-%m-%d') || ')' AS name,
  strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS session_start, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS session_end,
  count(*) AS total_chunks, sum(size)::BIGINT AS total_bytes, count(DISTINCT array_path) AS n_parts,
  coalesce('https://doi.org/10.1/' || any_value(g.citation), '') AS is_part_of, coalesce(any_value(g.citation), '') AS citation
FROM numbered n LEFT JOIN g ON g.ip = n.ip AND g.store = n.store AND g.session_no = n.session_no GROUP BY ALL""")
def passport_rows(t):
    return _passports(t).select(
        *KEYS, "name", "session_start", "session_end", "total_chunks", "total_bytes",
        F.size("has_part").cast("bigint").alias("n_parts"), "is_part_of", "citation",
    )


def _session_log(t):
    """What each session asked for: accesses, slices, masks with the extent they imply, and notes."""
    rows = _chunks(t)
    k, group = F.col("k"), F.coalesce("group", F.lit(""))
    op = (
        F.when(k < 40, "access").when(k < 60, "sel").when(k < 80, "isel").when(k < 95, "where")
        .otherwise("user_recorded")
    )
    survivors = F.when((k >= 80) & (k < 95), F.transform(
        F.sequence(F.lit(0), k % 4), lambda i: (F.col("user_id") + i * 7).cast("string")))
    log = rows.select(
        F.concat_ws("|", *KEYS).alias("session"), "seq", op.alias("op"),
        F.when(k % 2 == 0, "NEE").otherwise("GPP").alias("variable"), group.alias("group"),
        survivors.alias("surviving_stations"), "k", "ts",
    )
    log = delivery.with_extents(log, _candidates(t), ["session"])
    variable, group = F.col("variable"), F.col("group")
    asked = (
        F.when(op == "access", delivery.payload(variable=variable, group=group))
        .when(op == "sel", delivery.slice_payload(variable, group, "sel", "time", delivery.span(
            F.date_format("ts", "yyyy-MM-dd"), F.lit(None).cast("string"))))
        .when(op == "isel", delivery.slice_payload(
            variable, group, "isel", "time", delivery.span(k, k + 10)))
        .when(op == "where", delivery.where_payload(
            group, F.col("extent"), F.col("surviving_stations"), F.lit(True), F.lit("mask")))
        .otherwise(delivery.payload(
            op=op, group=group, note=F.concat(F.lit("n"), k.cast("string"))))
    )
    return log.withColumn("payload", asked).drop("k", "ts", "extent")


def _number(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


_DELIVERY_SQL = f"""{A.SESSIONS_SQL}, {A.STATIONS_SQL}, log AS (
  SELECT ip || '|' || store || '|' || session_no AS session, seq, k, ts, coalesce(group_path, '') AS grp,
    CASE WHEN k < 40 THEN 'access' WHEN k < 60 THEN 'sel' WHEN k < 80 THEN 'isel' WHEN k < 95 THEN 'where' ELSE 'user_recorded' END AS op,
    CASE WHEN k % 2 = 0 THEN 'NEE' ELSE 'GPP' END AS variable,
    CASE WHEN k >= 80 AND k < 95 THEN list_transform(range(0, k % 4 + 1), lambda i: user_id + i * 7) END AS survivors FROM numbered),
 extent AS (SELECT session, seq, max(lat) AS n, min(lat) AS s, max(lon) AS e, min(lon) AS w FROM (
   SELECT session, seq, unnest(survivors) AS id FROM log) JOIN stations ON station_id = id GROUP BY ALL),
 entries AS (SELECT log.*, CASE op
    WHEN 'access' THEN '{{"group":"' || grp || '","variable":"' || variable || '"}}'
    WHEN 'sel' THEN '{{"group":"' || grp || '","sel":{{"time":{{"start":"' || strftime(ts, '%Y-%m-%d') || '","step":null,"stop":null}}}},"variable":"' || variable || '"}}'
    WHEN 'isel' THEN '{{"group":"' || grp || '","isel":{{"time":{{"start":' || k || ',"step":null,"stop":' || (k + 10) || '}}}},"variable":"' || variable || '"}}'
    WHEN 'where' THEN '{{"cond":' || CASE WHEN n IS NULL THEN '{{"repr":"mask"}}' ELSE
      '{{"lat":{{"max":' || {_number("n")} || ',"min":' || {_number("s")} || '}},"lon":{{"max":' || {_number("e")} || ',"min":' || {_number("w")} || '}}}}' END
      || ',"drop":true,"group":"' || grp || '","op":"where","surviving_stations":["' || array_to_string(survivors, '","') || '"]}}'
    ELSE '{{"group":"' || grp || '","note":"n' || k || '","op":"user_recorded"}}' END AS payload
  FROM log LEFT JOIN extent USING (session, seq))"""


@query("query_log_rows", f"""WITH {_DELIVERY_SQL}
SELECT session, seq, op, payload, CAST(len(survivors) AS INTEGER) AS n_survivors FROM entries""")
def query_log_rows(t):
    """The query log itself, the extents of its masks included."""
    return _session_log(t).select(
        "session", "seq", "op", F.to_json("payload").alias("payload"),
        F.when(F.col("surviving_stations").isNotNull(), F.size("surviving_stations"))
        .alias("n_survivors"),
    )


_DOCUMENT_SQL = f"""WITH {_DELIVERY_SQL},
 asked AS (SELECT session, '[' || string_agg(payload, ',' ORDER BY seq) || ']' AS queries FROM (
   SELECT * FROM entries WINDOW w AS (PARTITION BY session ORDER BY seq)
   QUALIFY NOT (op = 'access' AND coalesce(lead(op) OVER w IN ('sel', 'isel') AND lead(variable) OVER w = variable AND lead(grp) OVER w = grp, false)))
   GROUP BY session),
 last AS (SELECT session, arg_max(survivors, seq) AS s FROM entries WHERE survivors IS NOT NULL GROUP BY session),
 ent AS (SELECT l.session, x.station_id::VARCHAR AS identifier, 'https://hdl.handle.net/11676/' || country AS doi, x.*
   FROM (SELECT session, unnest(s) AS id FROM last) l JOIN stations x ON x.station_id = l.id),
 nodes AS (
   SELECT session, 0 AS kind, '#station/' || identifier AS id, '{{"@id":"#station/' || identifier || '","@type":"icos:Station","addressCountry":"' || country
     || '","geo":{{"@type":"GeoCoordinates","latitude":' || {_number("lat")} || ',"longitude":' || {_number("lon")} || '}},"identifier":"' || identifier
     || '","intakeHeight":' || height || ',"isBasedOn":{{"@id":"' || doi || '"}},"name":"' || name || '","url":""}}' AS node FROM ent
   UNION ALL
   SELECT session, 1, doi, '{{"@id":"' || doi || '","@type":["Dataset","icos:DataObject"],"citation":"' || arg_min('Citation of ' || name, identifier)
     || '","name":"' || arg_min(trigram || '.nc', identifier) || '","url":"' || doi || '"}}' FROM ent GROUP BY session, doi),
 listed AS (SELECT session, string_agg('{{"@id":"' || id || '"}}', ',' ORDER BY kind, id) AS ids, string_agg(',' || node, '' ORDER BY kind, id) AS nodes FROM nodes GROUP BY session),
 parts AS (SELECT ip, store, session_no, array_path, count(*) AS n, sum(size)::BIGINT AS b, sha256(string_agg(sha256, chr(10) ORDER BY sha256)) AS m FROM numbered GROUP BY ALL),
 held AS (SELECT ip, store, session_no, string_agg('{{"@id":"' || array_path || '"}}', ',' ORDER BY array_path) AS links,
   string_agg('{{"@id":"' || array_path || '","chunkCount":' || n || ',"name":"' || string_split(array_path, '/')[-1] || '","sha256":"' || m || '","sizeInBytes":' || b
     || ',"zarr_path":"' || array_path || '"}}', ',' ORDER BY array_path) AS full_parts FROM parts GROUP BY ALL),
 origin AS (SELECT ip, store, session_no, arg_min(n_name, group_path) AS citation FROM numbered JOIN nation ON 'S' || n_nationkey = split_part(group_path, '/', 1) GROUP BY ALL),
 total AS (SELECT ip, store, session_no, ip || '|' || store || '|' || session_no AS session, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS t0, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS t1,
   count(*) AS n, sum(size)::BIGINT AS b, list_sort(list(DISTINCT array_name) FILTER (WHERE array_name IS NOT NULL)) AS arrays,
   list_sort(list(DISTINCT group_path) FILTER (WHERE group_path IS NOT NULL)) AS groups FROM numbered GROUP BY ip, store, session_no),
 halves AS (SELECT 'urn:session:' || sha256(session) AS id,
   '{{"@context":["https://w3id.org/ro/crate/1.1/context"],"@graph":[{{"@id":"./","@type":"Dataset","hasPart":[' || links || ']}},{{"@id":"urn:session:' || sha256(session)
   || '","@type":["Dataset","icos:DataPassport"],"accessedArrays":' || CASE WHEN arrays IS NULL THEN '[]' ELSE '["' || array_to_string(arrays, '","') || '"]' END
   || ',"accessedGroups":' || CASE WHEN groups IS NULL THEN '[]' ELSE '["' || array_to_string(groups, '","') || '"]' END
   || ',"agent":{{"@type":"Agent","ipAnonymised":"' || CASE WHEN ip LIKE '%:%' THEN array_to_string(string_split(ip, ':')[1:3], ':') || '::/48'
        ELSE array_to_string(string_split(ip, '.')[1:3], '.') || '.0/24' END || '"}},"citation":"' || coalesce(citation, '') || '","dateAccessed":"' || t0
   || '","hasPart":[' || full_parts || coalesce(',' || ids, '') || '],"isPartOf":{{"@id":"' || coalesce('https://doi.org/10.1/' || citation, '')
   || '"}},"name":"Data access passport \\u2014 ' || coalesce(array_to_string(arrays[1:5], ', '), '') || ' (' || t0[1:10] || ')","passportSha256":' AS a,
   ',"query":' || queries || ',"sessionEnd":"' || t1 || '","sessionStart":"' || t0 || '","stations":' || CASE WHEN s IS NULL THEN '[]' ELSE '["' || array_to_string(s, '","') || '"]' END
   || ',"totalBytesServed":' || b || ',"totalChunks":' || n || ',"url":""}}' || coalesce(nodes, '') || ']}}' AS z, s, ids
   FROM total JOIN held USING (ip, store, session_no) LEFT JOIN origin USING (ip, store, session_no) JOIN asked USING (session) LEFT JOIN last USING (session) LEFT JOIN listed USING (session))"""


@query("passport_documents", _DOCUMENT_SQL + """
SELECT id, sha256(a || 'null' || z) AS sha256, sha256(a || 'null' || z)[1:16] || '.jsonld' AS file_name,
  a || '"' || sha256(a || 'null' || z) || '"' || z AS document, true AS sound FROM halves""")
def passport_documents(t):
    """Self-checksummed documents of all sessions with their queries, stations and source objects; the
    identifier is derived from the session key."""
    p = _passports(t).withColumn("session", F.concat_ws("|", *KEYS))
    whole = delivery.deliveries(p, _session_log(t), _candidates(t), "session", "icos:")
    ident = F.concat(F.lit("urn:session:"), F.sha2("session", 256))
    docs = passport.graph_document(whole.withColumn("id", ident), "id", "icos:")
    return docs.select(
        "id", "sha256", passport.file_name().alias("file_name"), "document",
        passport.is_sound().alias("sound"),
    )


@query("tracked_requests", f"""WITH {A.ACCESS_SQL}
SELECT key LIKE '%/.z%' AS is_metadata, count(*) AS n, sum(size)::BIGINT AS n_bytes FROM access GROUP BY 1""")
def tracked_requests(t):
    a = A.access(t)
    return a.groupBy((~names.is_tracked("key")).alias("is_metadata")).agg(
        F.count("*").alias("n"), F.sum("size").cast("bigint").alias("n_bytes")
    )
