"""Files in, stores out: readers of whole files and every sink, written and read back (A)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import passport, reshape, select, sessions
from ..session import shared_dir
from ..sources import flux_csv, layout, ocean_csv, sinks
from . import adapters as A
from .registry import query

_HEADER = 'TIMESTAMP,Temp [degC],Temp [degC] QC Flag,"Odd, label",Temp [degC] QC Comment'


# Rows of a landed file.
FILE_ROWS = 250_000


def _files(df, folders: int) -> int:
    """Files of each of ``folders`` groups of the rows of ``df``: their number grows with the rows."""
    return max(1, math.ceil(df.count() / (folders * FILE_ROWS)))


@query("ocean_file_rows", """
SELECT file, variable, qc, count(*) AS n, round(sum(value), 2) AS total, min(time) AS first FROM (
  SELECT 'C' || (o_custkey % 7) AS file, o_orderdate AS time, unnest(['Temp', 'Odd_label']) AS variable,
    unnest([o_totalprice, CAST(o_orderkey AS DOUBLE)]) AS value,
    unnest([CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE o_orderkey % 4 END, -1])::INTEGER AS qc
  FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY ALL""")
def ocean_file_rows(t):
    """Ocean files with a preamble and a quoted label, landed as text and read by blocks into facts;
    bad stamps go."""
    landed, files = shared_dir(t.spark, "ocean-csv"), _files(t.orders, 7)
    stamp = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    flag = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(
        (F.col("o_orderkey") % 4).cast("string"))
    line = F.concat_ws(",", stamp, F.col("o_totalprice").cast("string"), flag,
                       F.col("o_orderkey").cast("string"), F.lit('"a, ""b"""'))
    part = F.col("o_custkey") % 7 + 7 * F.pmod(F.xxhash64("o_orderkey"), F.lit(files))
    rows = t.orders.select(part.cast("bigint").alias("part"), F.lit(1).alias("ord"),
                           line.alias("value"))
    head = t.spark.range(0, 7 * files).select(
        F.col("id").alias("part"),
        F.posexplode(F.array(F.lit("// exported"), F.lit(""), F.lit(_HEADER)))
        .alias("ord", "value"),
    ).withColumn("ord", F.col("ord") - 3)
    lines = head.join(rows.select("part").distinct(), "part", "left_semi").unionByName(rows)
    lines.repartition("part").sortWithinPartitions("part", "ord").select(
        "part", "value").write.partitionBy("part").text(landed)
    body = ocean_csv.skip_block_preamble(ocean_csv.block_lines(t.spark, f"{landed}/part=*"))
    rows = ocean_csv.good_times(ocean_csv.body_rows(body, "file"), "stamp").withColumn(
        "file", F.concat(F.lit("C"), (F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint")
                                      % 7).cast("string")))
    return rows.groupBy("file", "variable", F.col("qc").cast("int").alias("qc")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"),
        F.min("time").alias("first"),
    )


def _ocean_stored(t, path: str) -> None:
    rows = A.track(t).withColumn(
        "source_file", F.concat(F.lit("f"), (F.col("seq") % 3).cast("string")))
    for part in (0, 2, 1, 0):
        sinks.write_ocean(rows.filter(F.col("seq") % 3 == part), path)


@query("ocean_store", f"""WITH {A.TRACK_SQL}
SELECT deployment, variable, count(*) AS n, round(avg(value), 6) AS mean_value FROM track GROUP BY ALL""")
def ocean_store(t):
    """Deployments whose files come in three batches, the first of them twice."""
    path = shared_dir(t.spark, "ocean")
    _ocean_stored(t, path)
    return sinks.ocean_store(path).read(t.spark).groupBy("deployment", "variable").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value")
    )


@query("box_of_tracks", f"""WITH {A.TRACK_SQL}
SELECT deployment, count(*) AS n, round(avg(value), 6) AS mean_value, min(time) AS first, max(time) AS last FROM track
WHERE lat BETWEEN 5 AND 12.5 AND lon BETWEEN -20 AND -3 AND time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-22' GROUP BY deployment""")
def box_of_tracks(t):
    """Tracks stored by place and time, then a box and a fortnight of them."""
    path = shared_dir(t.spark, "tracks-by-place")
    layout.write_by_place(A.track(t), path)
    box = layout.in_box(t.spark.read.parquet(path), 5, 12.5, -20, -3)
    return select.time_slice(box, "time", "2024-01-08", "2024-01-21").groupBy("deployment").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value"),
        F.min("time").alias("first"), F.max("time").alias("last"),
    )


@query("flux_files", """
WITH x AS (SELECT 'S' || (l_suppkey % 3) AS site, l_orderkey * 10 + l_linenumber AS k, l_shipdate,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS nee, round(l_discount * 100) AS qc, l_extendedprice AS ta FROM lineitem)
SELECT variable, count(*) AS n, count(value) AS n_values, round(sum(value), 2) AS total, min(ts_start) AS first, max(ts_end) AS last FROM (
  SELECT 'NEE' AS variable, nee AS value, l_shipdate AS ts_start, l_shipdate + INTERVAL 1 DAY AS ts_end FROM x WHERE nee IS NOT NULL OR qc IS NOT NULL
  UNION ALL SELECT 'TA_F', ta, l_shipdate, l_shipdate + INTERVAL 1 DAY FROM x) GROUP BY variable""")
def flux_files(t):
    """CSV files with a wrapped header: read by header, converted to facts and stored twice."""
    landed, stored = shared_dir(t.spark, "flux-csv"), shared_dir(t.spark, "flux")
    files = _files(t.lineitem, 3)
    part = F.col("l_suppkey") % 3 + 3 * F.pmod(
        F.xxhash64("l_orderkey", "l_linenumber"), F.lit(files))
    rows = t.lineitem.select(
        part.cast("bigint").alias("part"), F.lit(1).alias("ord"),
        F.concat_ws(
            ",", F.date_format("l_shipdate", "yyyyMMdd"),
            F.when(F.col("l_tax") == 0, "-9999").otherwise(F.col("l_quantity").cast("string")),
            F.round(F.col("l_discount") * 100).cast("int").cast("string"),
            F.col("l_extendedprice").cast("string"),
        ).alias("value"),
    )
    head = t.spark.range(0, 3 * files).select(
        F.col("id").cast("bigint").alias("part"),
        F.posexplode(F.array(F.lit(""), F.lit("TIMESTAMP,NEE_VUT_REF,"), F.lit("NEE_VUT_REF_QC,TA_F")))
        .alias("ord", "value"),
    ).withColumn("ord", F.col("ord") - 3)
    lines = head.unionByName(rows).repartition("part").sortWithinPartitions("part", "ord")
    lines.select("part", "value").write.partitionBy("part").text(landed)
    for _ in range(2):
        for columns, wide in flux_csv.read_all(t.spark, f"{landed}/part=*"):
            sinks.write_flux(flux_csv.convert(wide, columns, "DD"), stored)
    return sinks.flux_store(stored).read(t.spark).groupBy("variable").agg(
        F.count("*").alias("n"), F.count("value").alias("n_values"),
        F.round(F.sum("value"), 2).alias("total"), F.min("ts_start").alias("first"),
        F.max("ts_end").alias("last"),
    )


def _zipped(rows, path: str) -> None:
    """Lands (archive, member, ord, value) as zip archives, through Spark's text writer: an archive's bytes
    are cut at line feeds, and its comment is the last one. A task holds one member's pending bytes."""

    def pack(batches):
        import io
        import zipfile

        import pyarrow as pa
        import pyarrow.compute as pc

        class Pipe(io.RawIOBase):
            def __init__(self):
                self.held = b""

            def writable(self):
                return True

            def write(self, b):
                self.held += bytes(b)
                return len(b)

        def ready(pipe, name, n, last=False):
            *whole, rest = pipe.held.split(b"\n")
            pipe.held = rest
            if last and rest:
                raise ValueError("an archive ends with a line feed")
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(whole), pa.int64()),
                 pa.array(range(n, n + len(whole)), pa.int64()), pa.array(whole, pa.binary())],
                names=["archive", "ord", "value"])

        name = pipe = z = out = None
        member, n = None, 0
        for batch in batches:
            # Lines of one member in a batch are put together before they are packed.
            ends = pc.run_end_encode(
                pc.binary_join_element_wise(batch.column(0).cast(pa.string()), batch.column(1), "/")
            ).run_ends.to_pylist()
            texts = pc.binary_join(pa.ListArray.from_arrays([0, *ends], batch.column(3)), "\n")
            for at, text in zip([0, *ends], texts):
                a, m = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                if a != name:
                    if z is not None:
                        out.close()
                        z.comment = b"\n"
                        z.close()
                        yield ready(pipe, name, n, True)
                    pipe, name, member, n = Pipe(), a, None, 0
                    z = zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED)
                if m != member:
                    if member is not None:
                        out.close()
                    out, member = z.open(m, "w"), m
                out.write(text.as_py().encode() + b"\n")
            if pipe is not None:
                done = ready(pipe, name, n)
                n += done.num_rows
                yield done
        if z is not None:
            out.close()
            z.comment = b"\n"
            z.close()
            yield ready(pipe, name, n, True)

    order = ["archive", "member", "ord"]
    packed = rows.select(*order, "value").repartition("archive").sortWithinPartitions(*order)
    packed = packed.mapInArrow(pack, "archive bigint, ord bigint, value binary")
    packed.sortWithinPartitions("archive", "ord").select(
        "archive", F.col("value").cast("string").alias("value")
    ).write.partitionBy("archive").option("lineSep", "\n").text(path)


@query("archive_rows", """
WITH x AS (SELECT 'S-' || (l_suppkey % 3) AS site, l_shipdate, CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS nee,
  round(l_discount * 100) AS qc, l_extendedprice AS ta FROM lineitem)
SELECT site, variable, count(*) AS n, count(value) AS n_values, round(sum(value), 2) AS total, min(ts_start) AS first, max(ts_end) AS last FROM (
  SELECT site, 'NEE' AS variable, nee AS value, l_shipdate AS ts_start, l_shipdate + INTERVAL 1 DAY AS ts_end FROM x WHERE nee IS NOT NULL OR qc IS NOT NULL
  UNION ALL SELECT site, 'TA_F', ta, l_shipdate, l_shipdate + INTERVAL 1 DAY FROM x) GROUP BY ALL""")
def archive_rows(t):
    """Zip archives of a member for each site and one that is no product, read to facts and stored."""
    landed, stored = shared_dir(t.spark, "archives"), shared_dir(t.spark, "archive-facts")
    files = _files(t.lineitem, 1)
    archive = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(files)).cast("bigint")
    member = F.concat(F.lit("deep/ICOSETC_S-"), (F.col("l_suppkey") % 3).cast("string"),
                      F.lit("_FLUXNET_DD_L2.csv"))
    rows = t.lineitem.select(
        archive.alias("archive"), member.alias("member"), F.lit(1).alias("ord"),
        F.concat_ws(
            ",", F.date_format("l_shipdate", "yyyyMMdd"),
            F.when(F.col("l_tax") == 0, "-9999").otherwise(F.col("l_quantity").cast("string")),
            F.round(F.col("l_discount") * 100).cast("int").cast("string"),
            F.col("l_extendedprice").cast("string"),
        ).alias("value"),
    )
    heads = rows.select("archive", "member").distinct().select(
        "archive", "member", F.lit(0).alias("ord"),
        F.lit("TIMESTAMP,NEE_VUT_REF,NEE_VUT_REF_QC,TA_F").alias("value"))
    notes = heads.select("archive").distinct().select(
        "archive", F.lit("deep/README.csv").alias("member"), F.lit(0).alias("ord"),
        F.lit("no,product").alias("value"))
    _zipped(rows.unionByName(heads).unionByName(notes), landed)
    for columns, wide in flux_csv.read_archives(t.spark, f"{landed}/archive=*"):
        sinks.write_flux(flux_csv.convert(wide, columns, "DD"), stored)
    return sinks.flux_store(stored).read(t.spark).groupBy(
        F.col("site_id").alias("site"), "variable"
    ).agg(
        F.count("*").alias("n"), F.count("value").alias("n_values"),
        F.round(F.sum("value"), 2).alias("total"), F.min("ts_start").alias("first"),
        F.max("ts_end").alias("last"),
    )


@query("wide_store", f"""WITH {A.HOURLY_SQL}
SELECT hour, coalesce(max(CASE WHEN variable = 'click' THEN value END), 9.96921e36) AS click, max(CASE WHEN variable = 'view' THEN value END) AS "view"
FROM hourly GROUP BY hour""")
def wide_store(t):
    """A tidy CSV of all hours, one column with its fill value, read back."""
    path = shared_dir(t.spark, "wide")
    wide = reshape.pivot_wide(A.hourly(t), ["hour"], "variable", ["click", "view"])
    sinks.write_wide(sinks.export_columns(wide, {"click": "double"}), path, "csv")
    return t.spark.read.option("header", "true").schema(
        "hour TIMESTAMP_NTZ, click DOUBLE, `view` DOUBLE").csv(path)


@query("passport_store", f"""WITH {A.SESSIONS_SQL}
SELECT count(*) AS n_documents, count(DISTINCT (ip, store, session_no)) AS n_sessions FROM (SELECT DISTINCT ip, store, session_no FROM numbered)""")
def passport_store(t):
    """Documents of all sessions written twice; each is stored once."""
    path = shared_dir(t.spark, "passport-store")
    keys = ["ip", "store", "session_no"]
    rows = sessions.with_session(sessions.tracked(A.access(t)), idle=A.IDLE)
    manifest = passport.detailed_manifest(rows, keys, "ts")
    none = t.nation.filter("false").select(
        F.col("n_name").alias("group"), F.col("n_name").alias("source_doi"),
        F.col("n_name").alias("citation"),
    )
    named = passport.assemble(manifest, none, keys).withColumn(
        "id", F.concat_ws("|", *keys))
    # Made once: both writes read them back.
    made = shared_dir(t.spark, "passport-documents")
    passport.graph_document(named, "id").select("sha256", "document").write.parquet(made)
    documents = t.spark.read.schema("sha256 STRING, document STRING").parquet(made)
    for _ in range(2):
        sinks.write_passports(documents, path)
    stored = t.spark.read.schema("file_name STRING, sha256 STRING, document STRING").json(path)
    return stored.agg(
        F.count("*").alias("n_documents"),
        F.countDistinct("sha256").alias("n_sessions"),
    )


@query("month_store", f"""WITH {A.TILES_SQL}
SELECT date, count(*) AS n_tiles, CAST(max(CASE WHEN month(date) = 2 THEN 2 ELSE 1 END) AS INTEGER) AS version FROM tiles
WHERE month(date) <> 2 OR day(date) <= 10 GROUP BY date""")
def month_store(t):
    """Months stored once, offered again (skipped), then February replaced by its first ten days."""
    path = shared_dir(t.spark, "months")
    tiles = A.tiles(t).select("date", "tile_row", "tile_col", "file").withColumn(
        "version", F.lit(1))
    sinks.store_months(tiles, path)
    again = tiles.withColumn("version", F.lit(2))
    sinks.store_months(again, path)
    february = again.filter((F.month("date") == 2) & (F.dayofmonth("date") <= 10))
    sinks.store_months(february, path, overwrite=True)
    return t.spark.read.parquet(path).groupBy("date").agg(
        F.count("*").alias("n_tiles"), F.max("version").alias("version")
    )
