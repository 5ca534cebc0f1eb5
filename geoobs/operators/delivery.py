"""The whole delivery record of a session: what was asked, which stations were left, what was served.

Four keyed tables meet in one nested document for each session: the manifest of its chunks, the log of
its selections, the stations that survived them, and the source objects these come from. A log entry
keeps what was asked as a VARIANT, whose JSON text has sorted keys; everything else is written from
structs, so no document passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import passport, windows


def span(start: Column, stop: Column, step: Column | None = None) -> Column:
    """A slice as it is logged."""
    none = F.lit(None).cast("string") if step is None else step
    return F.struct(start.alias("start"), none.alias("step"), stop.alias("stop"))


def payload(**fields: Column) -> Column:
    """What an entry asked for, as a VARIANT without the fields that are null."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())])))


def slice_payload(variable: Column, group: Column, how: str, name: str, taken: Column) -> Column:
    """A selection ``how`` (``sel`` or ``isel``) of a slice; its open ends are written as null."""
    shown = F.to_json(F.struct(taken.alias(name)), {"ignoreNullFields": "false"})
    asked = F.to_json(F.struct(group.alias("group"), variable.alias("variable")))
    return F.parse_json(F.concat(
        F.substring(asked, F.lit(1), F.length(asked) - 1),
        F.when(asked == "{}", "").otherwise(","), F.lit(f'"{how}":'), shown, F.lit("}"),
    ))


def with_extents(
    log: DataFrame, stations: DataFrame, keys: list[str], seq: str = "seq",
    survivors: str = "surviving_stations", station: str = "station",
    coords: tuple[str, ...] = ("lat", "lon"),
) -> DataFrame:
    """Adds ``extent`` to every entry with surviving stations: the smallest and largest value of each
    coordinate among them. Stations that the dimension does not know count for nothing; without any
    known one the extent is null. Lists are as long as a selection's stations, never as the data."""
    wanted = log.filter(F.col(survivors).isNotNull()).select(
        *keys, seq, F.explode(survivors).alias(station)
    )
    pairs = [
        F.struct(F.max(c).alias("max"), F.min(c).alias("min")).alias(c) for c in coords
    ]
    found = wanted.join(stations.select(station, *coords), station).groupBy(*keys, seq).agg(*pairs)
    found = found.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, seq])],
        F.struct(*coords).alias("extent"),
    )
    on = F.lit(True)
    for i, k in enumerate([*keys, seq]):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return log.join(found, on, "left").select(*log.columns, "extent")


def where_payload(
    group: Column, extent: Column, survivors: Column, drop: Column, text: Column | None = None
) -> Column:
    """A mask: the extent it implies where that is known, else its text, and who survives it."""
    shown = F.to_json(extent)
    if text is not None:
        shown = F.coalesce(shown, F.to_json(F.struct(text.alias("repr"))))
    base = F.to_json(F.struct(
        drop.alias("drop"), group.alias("group"), F.lit("where").alias("op"),
        survivors.alias("surviving_stations"),
    ))
    return F.parse_json(F.concat(
        F.lit('{"cond":'), F.coalesce(shown, F.lit("{}")), F.lit(","),
        F.substring(base, F.lit(2), F.length(base) - 1),
    ))


def station_nodes(entities: DataFrame, vocabulary: str = "") -> DataFrame:
    """``node``: the JSON of each station entity; what a station lacks is left out."""
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return entities.withColumn("node", F.to_json(F.struct(
        F.col("id").alias("@id"), F.lit(f"{vocabulary}Station").alias("@type"),
        filled("country").alias("addressCountry"),
        F.when(placed, F.struct(
            F.lit("GeoCoordinates").alias("@type"), F.col("lat").alias("latitude"),
            F.col("lon").alias("longitude"))).alias("geo"),
        "identifier", F.col("intake_height").alias("intakeHeight"),
        F.when(filled("source_doi").isNotNull(), F.struct(F.col("source_doi").alias("@id")))
        .alias("isBasedOn"),
        "name", "url",
    )))


def object_nodes(objects: DataFrame, vocabulary: str = "") -> DataFrame:
    """``node``: the JSON of each source object."""
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    return objects.withColumn("node", F.to_json(F.struct(
        F.col("id").alias("@id"),
        F.array(F.lit("Dataset"), F.lit(f"{vocabulary}DataObject")).alias("@type"),
        filled("citation").alias("citation"), filled("dataset_name").alias("name"),
        F.col("id").alias("url"),
    )))


def deliveries(
    passports: DataFrame, log: DataFrame, candidates: DataFrame, session: str,
    vocabulary: str = "",
) -> DataFrame:
    """``passports`` (from ``assemble``, with a ``session`` key) with ``queries``, ``stations``,
    ``entity_ids`` and ``entities``, ready for ``graph_document``.

    ``log`` has ``session, seq, op, variable, group, payload`` (VARIANT) and ``surviving_stations``. Bare
    accesses that a selection directly follows are left out, entries stand in their order. Stations are
    those of the last entry that lists any; those that ``candidates`` knows become entities, in order of
    their identifier, followed by their source objects. A session without a log has empty lists.
    """
    kept = windows.compact_queries(log, session)
    queries = kept.groupBy(session).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", F.to_json("payload").alias("text")))),
        lambda e: e["text"],
    ).alias("queries"))
    last = windows.last_surviving(log, session, "seq", "surviving_stations")
    stations = passport.station_entities(candidates, last, session, "surviving_stations")
    objects = passport.source_objects(stations, session, candidates)
    nodes = station_nodes(stations, vocabulary).select(
        session, F.lit(0).alias("kind"), "id", "node"
    ).unionByName(object_nodes(objects, vocabulary).select(
        session, F.lit(1).alias("kind"), "id", "node"))
    listed = F.array_sort(F.collect_list(F.struct("kind", "id", "node")))
    entities = nodes.groupBy(session).agg(listed.alias("_nodes")).select(
        session, F.transform("_nodes", lambda n: n["id"]).alias("entity_ids"),
        F.transform("_nodes", lambda n: n["node"]).alias("entities"),
    )
    return passports.join(queries, session, "left").join(
        last.withColumnRenamed("surviving_stations", "stations"), session, "left"
    ).join(entities, session, "left")
