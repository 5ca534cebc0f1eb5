"""Delivery records: chunk manifests, entities and self-checksummed documents."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, names
from .keys import join_null_safe


def manifest(
    chunks: DataFrame, keys: list[str], array: str, sha: str, size: str,
    carry: dict[str, str] | None = None, texts: list[str] | None = None,
) -> DataFrame:
    """Per array: chunk count, bytes and SHA-256 of its sorted, newline-joined chunk digests.

    Repeated deliveries of a chunk are added up before the shuffle. The digest is defined over one
    byte sequence; it is fed from sorted batches in constant memory, so no list is ever built, and
    the counts are taken in the same pass, so the chunks are read and shuffled once.
    ``carry`` names further numbers to keep by "min" or "max". ``texts`` are columns the array
    implies; they are grouped by, since a text aggregate would sort the raw rows.
    """
    group, carry, texts = [*keys, array], carry or {}, texts or []
    kept = [getattr(F, how)(c).alias(c) for c, how in carry.items()]
    counted = chunks.groupBy(*group, sha, *texts).agg(
        F.count("*").alias("_n"), F.sum(size).cast("bigint").alias("_b"), *kept
    )
    key_type = counted.select(*group).schema
    rows = counted.select(
        F.to_json(F.struct(*group)).alias("_key"), F.col(sha).alias("_item"), "_n", "_b", *carry, *texts
    )
    carry = {**carry, **dict.fromkeys(texts, "max")}
    ordered = rows.repartition("_key").sortWithinPartitions("_key", "_item")
    kept_types = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    names_out = ["_key", "chunk_count", "size_bytes", *carry, "manifest_sha256"]
    pickers = [{"min": min, "max": max}[how] for how in carry.values()]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        key, state, n, size_sum, held = None, None, 0, 0, []
        for batch in batches:
            done = []
            extra = zip(*[batch[c] for c in carry]) if carry else iter(lambda: (), None)
            columns = (batch[c] for c in ("_key", "_item", "_n", "_b"))
            for (k, text, times, size_here), more in zip(zip(*columns), extra):
                if k != key:
                    if key is not None:
                        done.append((key, n, size_sum, *held, state.hexdigest()))
                    key, state, lead, n, size_sum = k, hashlib.sha256(), b"", 0, 0
                    held = [None] * len(pickers)
                for _ in range(times):
                    state.update(lead + text.encode())
                    lead = b"\n"
                n += times
                size_sum += size_here
                held = [
                    new if old is None else old if new is None else pick(old, new)
                    for pick, old, new in zip(pickers, held, more)
                ]
            if done:
                yield pd.DataFrame(done, columns=names_out)
        if key is not None:
            yield pd.DataFrame(
                [(key, n, size_sum, *held, state.hexdigest())], columns=names_out
            )

    out = ordered.mapInPandas(
        fold, f"_key string, chunk_count bigint, size_bytes bigint{kept_types}, "
        "manifest_sha256 string",
    )
    return out.withColumn("_k", F.from_json("_key", key_type)).select("_k.*", *names_out[1:])


def bounded_manifest(
    chunks: DataFrame, keys: list[str], array: str, sha: str, size: str,
    carry: dict[str, str] | None = None, texts: list[str] | None = None,
) -> DataFrame:
    """``manifest`` for groups whose lists have a bound, as the chunks of one session's array do.

    The same rows and digests, by aggregates alone: repeats are added up before the shuffle and written
    out in the digest's text only.
    """
    group, carry, texts = [*keys, array], carry or {}, texts or []
    kept = [getattr(F, how)(c).alias(c) for c, how in carry.items()]
    counted = chunks.groupBy(*group, sha, *texts).agg(
        F.count("*").alias("_n"), F.sum(size).cast("bigint").alias("_b"), *kept
    )
    items = F.array_sort(F.collect_list(F.struct(F.col(sha).alias("s"), "_n")))
    written = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["s"], x["_n"].cast("int"))))
    out = counted.groupBy(*group, *texts).agg(
        F.sum("_n").alias("chunk_count"), F.sum("_b").cast("bigint").alias("size_bytes"), *kept,
        items.alias("_items"),
    )
    return out.select(
        *group, "chunk_count", "size_bytes", *carry, *texts,
        F.sha2(F.array_join(written, "\n"), 256).alias("manifest_sha256"),
    )


def range_digests(
    chunks: DataFrame, keys: list[str], array: str, sha: str, size: str, digits: int = 3
) -> DataFrame:
    """Leaves of the digest tree of each array: one row for each range of chunk digests.

    A range are the digests that begin with the same ``digits`` hex digits, so one array is dealt over
    as many tasks as it has ranges. Its digest covers a line ``sha:count`` for each different chunk in
    order, so a chunk that was delivered often costs as much as one. Columns: the keys, ``array``,
    ``range``, ``chunk_count``, ``size_bytes`` and ``range_sha256``.
    """
    group = [*keys, array]
    counted = chunks.groupBy(*group, sha).agg(
        F.count("*").alias("_n"), F.sum(size).cast("bigint").alias("_b")
    ).withColumn("range", F.substring(sha, 1, digits))
    line = F.concat(F.col(sha), F.lit(":"), F.col("_n").cast("string"))
    return counted.groupBy(*group, "range").agg(
        F.sum("_n").alias("chunk_count"), F.sum("_b").cast("bigint").alias("size_bytes"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("range_sha256"),
    )


def root_digests(ranges: DataFrame, keys: list[str], array: str) -> DataFrame:
    """Root of each array's digest tree: the digest of a line ``range:range_sha256`` for each range in
    order. A tree has at most 16 to the power of ``digits`` ranges, whatever the array holds."""
    line = F.concat("range", F.lit(":"), "range_sha256")
    return ranges.groupBy(*keys, array).agg(
        F.sum("chunk_count").alias("chunk_count"), F.sum("size_bytes").alias("size_bytes"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("root_sha256"),
    )


def updated_ranges(
    ranges: DataFrame, old: DataFrame, new: DataFrame, keys: list[str], array: str, sha: str,
    size: str, digits: int = 3,
) -> DataFrame:
    """``range_digests`` after ``new`` chunks came to the ``old`` ones that ``ranges`` were made of.

    Only ranges that a new chunk falls into are hashed again; all others keep their rows.
    """
    group = [*keys, array, "range"]
    touched = new.withColumn("range", F.substring(sha, 1, digits)).select(*group).distinct()
    within = old.withColumn("range", F.substring(sha, 1, digits))
    again = join_null_safe(within, touched, group, "left_semi").drop("range")
    columns = [*keys, array, sha, size]
    fresh = range_digests(
        again.select(*columns).unionAll(new.select(*columns)), keys, array, sha, size, digits)
    return join_null_safe(ranges, touched, group, "left_anti").unionByName(fresh)


def detailed_manifest(
    chunks: DataFrame, keys: list[str], ts: str = "ts", sha: str = "sha256", size: str = "size"
) -> DataFrame:
    """Manifest rows of sessions that also keep the group, the array name and the time span of each
    array."""
    us = clean.micros(ts)
    timed = chunks.withColumns({"first_us": us, "last_us": us})
    carry = {"first_us": "min", "last_us": "max"}
    return bounded_manifest(timed, keys, "array_path", sha, size, carry, ["group", "array"])


def station_entities(
    candidates: DataFrame, surviving: DataFrame, session: str, stations: str
) -> DataFrame:
    """Station nodes of each session: one row per surviving station that the store knows.

    ``candidates(station, site_name, lat, lon, intake_height, country, source_doi, station_url)``.
    """
    wanted = surviving.select(session, F.explode(stations).alias("station"))
    return wanted.join(candidates, "station").select(
        session,
        F.concat(F.lit("#station/"), "station").alias("id"),
        F.col("station").alias("identifier"),
        F.coalesce("site_name", "station").alias("name"),
        F.coalesce("station_url", F.lit("")).alias("url"),
        "lat", "lon", "intake_height", "country", "source_doi",
    )


def source_objects(entities: DataFrame, session: str, details: DataFrame) -> DataFrame:
    """Source objects of the stations, one per identifier; the first station's text is kept."""
    named = entities.filter(F.coalesce("source_doi", F.lit("")) != "").join(
        details.select("station", "citation", "dataset_name"),
        F.col("identifier") == F.col("station"), "left",
    )
    return named.groupBy(session, "source_doi").agg(
        F.min_by(F.struct("citation", "dataset_name"), "identifier").alias("_d")
    ).select(session, F.col("source_doi").alias("id"), "_d.*")


def assemble(manifest_rows: DataFrame, provenance: DataFrame, keys: list[str]) -> DataFrame:
    """Passport rows from ``detailed_manifest`` rows: totals, accessed names, parts and origin.

    Everything is one aggregate over manifest rows, so chunks are read once. The nested lists hold
    the arrays of one session, bounded by what a store has, never by the number of chunks served.
    ``provenance(group, source_doi, citation)`` describes the groups that have metadata; the first
    such group of a session, in name order, is its origin.
    """
    top = F.element_at(F.split("group", "/"), 1)
    # One origin for each group, the first by its identifier, so that no total is counted twice.
    known = provenance.groupBy(F.col("group").alias("_top")).agg(
        F.min(F.struct("source_doi", "citation")).alias("_origin")
    )
    rows = manifest_rows.withColumn("_top", top).join(known, "_top", "left")
    part = F.struct(
        F.col("array_path").alias("id"), "chunk_count", "size_bytes", "manifest_sha256"
    )
    has_origin = F.when(F.col("_origin").isNotNull(), F.col("group"))
    out = rows.groupBy(*keys).agg(
        F.min("first_us").alias("_first"), F.max("last_us").alias("_last"),
        F.sum("size_bytes").cast("bigint").alias("total_bytes"),
        F.sum("chunk_count").cast("bigint").alias("total_chunks"),
        F.array_sort(F.collect_list(part)).alias("has_part"),
        F.sort_array(F.collect_set("group")).alias("accessed_groups"),
        F.sort_array(F.collect_set("array")).alias("accessed_arrays"),
        F.min_by("_origin", has_origin).alias("_origin"),
    )
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    out = out.withColumns({
        "_start": F.timestamp_add("MICROSECOND", F.col("_first"), epoch),
        "_end": F.timestamp_add("MICROSECOND", F.col("_last"), epoch),
    })
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    shown = F.array_join(F.slice("accessed_arrays", 1, 5), ", ")
    return out.select(
        *keys,
        F.concat(
            F.lit("Data access passport — "), shown, F.lit(" ("),
            F.date_format("_start", "yyyy-MM-dd"), F.lit(")"),
        ).alias("name"),
        F.date_format("_start", iso).alias("session_start"),
        F.date_format("_end", iso).alias("session_end"),
        names.anonymise_ip("ip").alias("ip_anonymised"),
        "accessed_groups", "accessed_arrays", "has_part", "total_bytes", "total_chunks",
        F.coalesce("_origin.source_doi", F.lit("")).alias("is_part_of"),
        F.coalesce("_origin.citation", F.lit("")).alias("citation"),
    )


def ascii_json(text: Column) -> Column:
    """JSON text with every character beyond ASCII written as its UTF-16 escapes."""

    def escaped(c: Column) -> Column:
        return F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")

    # A text has few different ones; each is replaced in one pass of the string.
    others = F.array_distinct(F.regexp_extract_all(text, F.lit("([^\\x00-\\x7f])")))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, text).otherwise(
        F.aggregate(others, text, lambda done, c: F.replace(done, c, escaped(c))))


def canonical_json(text: Column) -> Column:
    """Canonical text of a JSON value: sorted keys, no blanks, numbers without superfluous zeros,
    characters beyond ASCII escaped. Null for a null; a text that is no JSON fails the job."""
    return ascii_json(F.to_json(F.parse_json(text)))


def _listed(*texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.concat(*texts), ","), F.lit("]"))


def _inner(node: Column) -> Column:
    """Members of a JSON object without its braces."""
    return F.substring(node, F.lit(2), F.length(node) - 2)


def _fields(**columns: Column) -> Column:
    """JSON members in the order given; nulls are written."""
    named = F.struct(*[c.alias(k) for k, c in columns.items()])
    return _inner(F.to_json(named, {"ignoreNullFields": "false"}))


def graph_document(passports: DataFrame, id_column: str, vocabulary: str = "") -> DataFrame:
    """``document`` and ``sha256``: the JSON-LD graph of each passport row with its own checksum.

    Optional columns: ``stations`` (array of ids), ``queries`` and ``entities`` (arrays of JSON texts)
    and ``entity_ids``. ``vocabulary`` is the prefix of the passport's own type. Keys are sorted because
    the structs below name them in order. The checksum covers the canonical text with the checksum
    field set to null; ``is_sound`` recomputes it.
    """
    none = F.array().cast("array<string>")

    def optional(name: str):
        return F.coalesce(F.col(name), none) if name in passports.columns else none

    def as_json(items):
        return F.transform(items, lambda x: F.to_json(x))

    parts = F.coalesce("has_part", F.array().cast(passports.schema["has_part"].dataType))
    links = as_json(F.transform(parts, lambda p: F.struct(p["id"].alias("@id"))))
    full = as_json(F.transform(parts, lambda p: F.struct(
        p["id"].alias("@id"),
        p["chunk_count"].alias("chunkCount"),
        F.element_at(F.split(p["id"], "/"), -1).alias("name"),
        p["manifest_sha256"].alias("sha256"),
        p["size_bytes"].alias("sizeInBytes"),
        p["id"].alias("zarr_path"),
    )))
    entity_links = as_json(F.transform(
        optional("entity_ids"), lambda e: F.struct(e.alias("@id"))
    ))
    agent = F.struct(
        F.lit("Agent").alias("@type"), F.col("ip_anonymised").alias("ipAnonymised"))
    before = F.concat(
        F.lit('{"@context":["https://w3id.org/ro/crate/1.1/context"],"@graph":[{"@id":"./",'
              '"@type":"Dataset","hasPart":'), _listed(links), F.lit("},{"),
        _fields(**{
            "@id": F.col(id_column),
            "@type": F.array(F.lit("Dataset"), F.lit(f"{vocabulary}DataPassport")),
            "accessedArrays": F.col("accessed_arrays"),
            "accessedGroups": F.col("accessed_groups"),
            "agent": agent,
            "citation": F.col("citation"),
            "dateAccessed": F.col("session_start"),
        }),
        F.lit(',"hasPart":'), _listed(full, entity_links), F.lit(","),
        _fields(isPartOf=F.struct(F.col("is_part_of").alias("@id")), name=F.col("name")),
        F.lit(',"passportSha256":'),
    )
    # Escaped below, with the rest of their half.
    queries = F.transform(optional("queries"), lambda x: F.to_json(F.parse_json(x)))
    entities = F.transform(optional("entities"), lambda x: F.to_json(F.parse_json(x)))
    after = F.concat(
        F.lit(',"query":'), _listed(queries), F.lit(","),
        _fields(
            sessionEnd=F.col("session_end"), sessionStart=F.col("session_start"),
            stations=optional("stations"), totalBytesServed=F.col("total_bytes"),
            totalChunks=F.col("total_chunks"), url=F.lit(""),
        ),
        F.lit("}"),
        F.array_join(F.transform(entities, lambda e: F.concat(F.lit(","), e)), ""), F.lit("]}"),
    )
    # The texts are columns before they are escaped, so each is written once.
    halves = passports.withColumns({"_before": before, "_after": after}).withColumns(
        {c: ascii_json(F.col(c)) for c in ("_before", "_after")})
    sha = F.sha2(F.concat("_before", F.lit("null"), "_after"), 256)
    return halves.withColumn("sha256", sha).withColumn(
        "document", F.concat("_before", F.lit('"'), "sha256", F.lit('"'), "_after")
    ).drop("_before", "_after")


def is_sound(document: str = "document", sha: str = "sha256") -> Column:
    """Whether a stored document still has the checksum it names."""
    own = F.concat(F.lit('"passportSha256":"'), F.col(sha), F.lit('"'))
    plain = F.replace(F.col(document), own, F.lit('"passportSha256":null'))
    return F.contains(F.col(document), own) & (F.sha2(plain, 256) == F.col(sha))


def verify(document: pd.Series) -> pd.Series:
    """Recomputed checksum of stored documents, for audits."""
    import hashlib
    import json

    def one(text: str) -> str:
        doc = json.loads(text)
        doc["@graph"][1]["passportSha256"] = None
        plain = json.dumps(doc, sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(plain.encode()).hexdigest()

    return document.map(one)


def file_name(sha: str = "sha256"):
    """Name of the stored document: the first 16 digits of its checksum."""
    return F.concat(F.substring(sha, 1, 16), F.lit(".jsonld"))
