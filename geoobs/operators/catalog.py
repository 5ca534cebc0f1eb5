"""Catalogue and provenance kept as append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def provenance_events(rows: DataFrame, entity: str, existing: DataFrame | None = None) -> DataFrame:
    """Events to append: ``create`` for the first event of an entity, else ``update``.

    Rows carry ``timestamp``, ``file``, ``gas``, ``source_doi`` and ``citation``; of several events
    of a new entity the earliest creates it.
    """
    event = ["timestamp", "file", "gas", "source_doi", "citation"]
    first = rows.groupBy(entity).agg(F.min(F.struct(*event)).alias("_first"))
    if existing is None:
        known = first.withColumn("_known", F.lit(False))
    else:
        seen = existing.select(F.col("entity").alias(entity)).distinct().withColumn(
            "_known", F.lit(True)
        )
        known = first.join(seen, entity, "left").withColumn(
            "_known", F.coalesce("_known", F.lit(False))
        )
    # Of events that are alike in everything one creates the entity.
    alike = Window.partitionBy(entity, *event).orderBy(F.lit(0))
    creates = (
        ~F.col("_known") & F.struct(*event).eqNullSafe(F.col("_first")) & (F.col("_nth") == 1)
    )
    numbered = rows.withColumn("_nth", F.row_number().over(alike))
    return numbered.join(known, entity).select(
        F.col(entity).alias("entity"),
        F.when(creates, "create").otherwise("update").alias("action"), *event,
    )


def provenance_state(events: DataFrame) -> DataFrame:
    """Current state per entity: created, last update, event count and last source."""
    last = F.max_by(F.struct("action", "file", "source_doi", "citation"),
                    F.struct("timestamp", "file"))
    return events.groupBy("entity").agg(
        F.min("timestamp").alias("created"), F.max("timestamp").alias("last_updated"),
        F.count("*").alias("n_events"), last.alias("_l"),
    ).select(
        "entity", "created", "last_updated", "n_events",
        F.col("_l.action").alias("last_action"), F.col("_l.file").alias("last_file"),
        F.col("_l.source_doi").alias("source_doi"), F.col("_l.citation").alias("citation"),
    )


def live_entities(events: DataFrame) -> DataFrame:
    """Entities whose last event is not ``remove``."""
    return provenance_state(events).filter("last_action != 'remove'")


def tombstone(entity: str, spark, at: Column | None = None) -> DataFrame:
    """A removal event; rows of the entity are hidden by ``without_removed``."""
    row = spark.createDataFrame([(entity,)], "entity STRING")
    when = F.current_timestamp() if at is None else at
    blank = F.lit(None).cast("string")
    return row.select(
        "entity", F.lit("remove").alias("action"), when.cast("timestamp").alias("timestamp"),
        blank.alias("file"), blank.alias("gas"), blank.alias("source_doi"),
        blank.alias("citation"),
    )


def without_removed(
    facts: DataFrame, events: DataFrame, key: str, stored_at: str | None = None
) -> DataFrame:
    """Facts that were not removed.

    With ``stored_at``, the time a row was written, a removal hides exactly the rows written up to
    it: a later re-ingest brings its own rows, never the old ones. Without it, all rows of entities
    whose last event is a removal are hidden.
    """
    if stored_at is None:
        gone = provenance_state(events).filter("last_action = 'remove'")
    else:
        gone = events.filter("action = 'remove'").groupBy("entity").agg(
            F.max("timestamp").alias("_removed"))
    on = F.col(key).cast("string") == F.col("_e")
    if stored_at is not None:
        on = on & (F.col(stored_at) <= F.col("_removed"))
    return facts.join(gone.withColumnRenamed("entity", "_e"), on, "left_anti")


def listing(events: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Live entities with last update, gases and row counts.

    ``counts(key, gas, n_rows)`` has one row per entity and gas; gases are at most four.
    """
    from .aggregates import canonical_gases

    per = counts.groupBy(key).agg(
        F.sum("n_rows").alias("n_rows"), canonical_gases("gas").alias("gases")
    )
    live = live_entities(events).select("entity", "created", "last_updated", "n_events")
    return live.join(per.withColumnRenamed(key, "entity"), "entity", "left")


def station_info(station: str, dim: DataFrame, counts: DataFrame, events: DataFrame, key: str):
    """Attributes, sample counts and history of one station as (section, name, text) rows."""
    mine = dim.filter(F.col(key) == station)
    attrs = [c for c in dim.columns if c != key]
    a = mine.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("text")) for c in attrs
        ])).alias("_x")
    ).select(F.lit("attribute").alias("section"), "_x.*").filter("text IS NOT NULL")
    n = counts.filter(F.col(key) == station).select(
        F.lit("samples").alias("section"), F.col("gas").alias("name"),
        F.col("n_rows").cast("string").alias("text"),
    )
    h = events.filter(F.col("entity") == station).select(
        F.lit("history").alias("section"), F.col("timestamp").cast("string").alias("name"),
        F.col("action").alias("text"),
    )
    return a.unionByName(n).unionByName(h)


def merge_attributes(old: DataFrame, new: DataFrame, entity: str) -> DataFrame:
    """(entity, name, text) attributes merged: gas-prefixed names are overwritten, others kept."""
    prefixed = F.regexp_like("name", F.lit("^(" + "|".join(S.GASES) + ")_"))
    o = old.select(entity, "name", F.col("text").alias("_old"))
    n = new.select(entity, "name", F.col("text").alias("_new"))
    text = F.when(prefixed, F.coalesce("_new", "_old")).otherwise(F.coalesce("_old", "_new"))
    return o.join(n, [entity, "name"], "full_outer").select(entity, "name", text.alias("text"))


def backfill(df: DataFrame, source: DataFrame, key: str, column: str, overwrite: bool = False):
    """``column`` filled from ``source(key, column)`` with the outcome of each row.

    Outcomes: patched, skipped (already present) and missing (nothing to fill from).
    """
    new = source.select(key, F.nullif(F.col(column), F.lit("")).alias("_new"))
    joined = df.join(new, key, "left")
    have, got = F.col(column).isNotNull(), F.col("_new").isNotNull()
    take = got & (F.lit(overwrite) | ~have)
    outcome = F.when(~got, "missing").when(take, "patched").otherwise("skipped")
    return joined.withColumn("outcome", outcome).withColumn(
        column, F.when(take, F.col("_new")).otherwise(F.col(column))
    ).drop("_new")


def outcome_counts(patched: DataFrame) -> DataFrame:
    return patched.groupBy("outcome").agg(F.count("*").alias("n"))


def citation_list(attrs: str | Column, stem: str = "dataset_provider_citation_") -> Column:
    """Numbered citations 1, 2, ... of an attribute map, cut at the first missing number.

    A map of n entries has at most n of them; the number after the last one is always missing.
    """
    attrs = F.col(attrs) if isinstance(attrs, str) else attrs
    texts = F.transform(
        F.sequence(F.lit(1), F.coalesce(F.size(attrs), F.lit(0)) + 1),
        lambda i: F.try_element_at(attrs, F.concat(F.lit(stem), i.cast("string"))),
    )
    first_gap = F.array_position(F.transform(texts, lambda t: t.isNull()), True)
    return F.when(first_gap == 0, texts).otherwise(
        F.slice(texts, F.lit(1), (first_gap - 1).cast("int"))
    )


def inventory_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows added to or removed from an inventory between two scans."""
    cols = before.columns
    added = after.join(before, cols, "left_anti").withColumn("change", F.lit("added"))
    removed = before.join(after, cols, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def ingest_report(results: DataFrame) -> DataFrame:
    """Processed, failed and skipped counts with their reasons."""
    return results.groupBy("status", "reason").agg(F.count("*").alias("n"))
