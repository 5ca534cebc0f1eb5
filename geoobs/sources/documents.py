"""JSON documents of collections, stations and data objects as flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import names

COLLECTION = "members ARRAY<STRUCT<name: STRING, res: STRING>>"
PERSON_ROLE = (
    "STRUCT<person: STRUCT<firstName: STRING, lastName: STRING>, "
    "role: STRUCT<`end`: STRING, role: STRUCT<label: STRING>>>"
)
STATION = (
    "location STRUCT<lat: DOUBLE, lon: DOUBLE, alt: DOUBLE>, countryCode STRING, "
    "org STRUCT<name: STRING>, "
    "responsibleOrganization STRUCT<name: STRING, self: STRUCT<uri: STRING>>, "
    "specificInfo STRUCT<stationClass: STRING, labelingDate: STRING, timeZoneOffset: INT, "
    "wigosId: STRING, ecosystemType: STRUCT<label: STRING>, climateZone: STRUCT<label: STRING>, "
    "meanAnnualTemp: DOUBLE, meanAnnualPrecip: DOUBLE, meanAnnualRad: DOUBLE, "
    "documentation: ARRAY<STRUCT<res: STRING>>>, "
    f"staff ARRAY<{PERSON_ROLE}>"
)
OBJECT = (
    "pid STRING, accessUrl STRING, references STRUCT<citationString: STRING>, "
    "coverageGeo STRUCT<type: STRING>, "
    "specificInfo STRUCT<acquisition: STRUCT<station: STRUCT<id: STRING, org: STRUCT<name: STRING>,"
    " countryCode: STRING, location: STRUCT<lat: DOUBLE, lon: DOUBLE>>, "
    "interval: STRUCT<start: STRING, stop: STRING>>, "
    "columns: ARRAY<STRUCT<label: STRING, valueType: STRUCT<unit: STRUCT<label: STRING>, "
    "self: STRUCT<label: STRING>>, instrumentDeployments: ARRAY<STRUCT<"
    "instrument: STRUCT<label: STRING, uri: STRING, comments: ARRAY<STRING>>, "
    "pos: STRUCT<lat: DOUBLE, lon: DOUBLE, alt: DOUBLE>, start: STRING, stop: STRING>>>>>"
)


def read_documents(spark: SparkSession, paths: list[str] | str, schema: str) -> DataFrame:
    """One row per JSON document."""
    return spark.read.schema(schema).json(paths, multiLine=True).withColumn(
        "source_file", F.col("_metadata.file_path")
    )


def members(collections: DataFrame, suffix: str | None = None) -> DataFrame:
    """(name, res, hash_id) of the members, optionally only those with a name suffix."""
    m = collections.select(F.explode("members").alias("m")).select("m.name", "m.res")
    if suffix:
        m = m.filter(F.endswith("name", F.lit(suffix)))
    return m.withColumn("hash_id", F.element_at(F.split("res", "/"), -1))


def archive_members(collections: DataFrame) -> DataFrame:
    """Archive members with their site."""
    site = F.regexp_extract("name", r"(?i)^ICOSETC_([^_]+-\w+?)_ARCHIVE", 1)
    return members(collections).filter(F.contains("name", F.lit("_ARCHIVE_"))).withColumn(
        "site_id", F.nullif(site, F.lit(""))
    )


def sensor_members(collections: DataFrame) -> DataFrame:
    """Per-sensor members, one per site; a later member of a site replaces an earlier one."""
    m = collections.select(F.posexplode("members").alias("pos", "m")).select("pos", "m.*")
    m = m.filter(
        ~F.contains("name", F.lit("_ARCHIVE_")) & F.contains(F.upper("name"), F.lit("_METEOSENS_"))
    ).withColumn(
        "site_id", F.nullif(F.regexp_extract("name", r"(?i)^ICOSETC_([^_]+-[^_]+)_", 1), F.lit(""))
    )
    return m.filter("site_id IS NOT NULL").groupBy("site_id").agg(
        F.max_by("res", "pos").alias("res")
    )


def _full_name(person: Column) -> Column:
    return F.concat_ws(" ", person["firstName"], person["lastName"])


def _staff(role: str, separator: str, current_only: bool) -> Column:
    """Names of one document's staff with a role, in document order."""
    chosen = F.filter(
        "staff",
        lambda s: (s["role"]["role"]["label"] == role)
        & (s["role"]["end"].isNull() if current_only else F.lit(True)),
    )
    text = F.array_join(F.transform(chosen, lambda s: _full_name(s["person"])), separator)
    return F.nullif(text, F.lit(""))


def ecosystem_stations(stations: DataFrame) -> DataFrame:
    """Flat attributes of ecosystem station documents."""
    si = F.col("specificInfo")
    staff = {attr: _staff(label, ", ", True) for label, attr in S.STAFF_ROLES.items()}
    return stations.select(
        "source_file",
        F.col("location.lat").alias("geospatial_lat"),
        F.col("location.lon").alias("geospatial_lon"),
        F.col("location.alt").alias("station_elevation"),
        F.when(F.col("location.alt").isNotNull(), "m above sea level").alias(
            "station_elevation_units"),
        F.col("countryCode").alias("country"),
        si["stationClass"].alias("station_class"),
        si["labelingDate"].alias("labeling_date"),
        names.zone_label(si["timeZoneOffset"]).alias("time_zone"),
        si["ecosystemType"]["label"].alias("ecosystem"),
        si["climateZone"]["label"].alias("climate_zone"),
        si["meanAnnualTemp"].alias("mean_annual_temperature"),
        F.when(si["meanAnnualTemp"].isNotNull(), "degC").alias("mean_annual_temperature_units"),
        si["meanAnnualPrecip"].alias("mean_annual_precipitation"),
        F.when(si["meanAnnualPrecip"].isNotNull(), "mm").alias("mean_annual_precipitation_units"),
        si["meanAnnualRad"].alias("mean_annual_sw_radiation"),
        F.when(si["meanAnnualRad"].isNotNull(), "W m-2").alias("mean_annual_sw_radiation_units"),
        F.get(si["documentation"], 0)["res"].alias("documentation"),
        *[text.alias(attr) for attr, text in staff.items()],
    )


def atmosphere_stations(stations: DataFrame) -> DataFrame:
    """Flat attributes of atmosphere station documents; empty texts are NULL."""
    si = F.col("specificInfo")
    org = F.col("responsibleOrganization")

    def text(col: Column, name: str) -> Column:
        return F.nullif(col, F.lit("")).alias(name)

    return stations.select(
        "source_file",
        F.col("location.lat").alias("station_lat"), F.col("location.lon").alias("station_lon"),
        F.col("location.alt").alias("station_alt"),
        text(F.col("org.name"), "station_full_name"),
        text(org["name"], "responsible_organization"),
        text(org["self"]["uri"], "responsible_organization_uri"),
        text(F.col("countryCode"), "country_code"),
        text(si["stationClass"], "station_class"),
        text(si["labelingDate"], "station_labeling_date"),
        text(si["wigosId"], "wigos_id"),
        si["timeZoneOffset"].alias("time_zone_offset"),
        _staff("Principal Investigator", "; ", False).alias("current_pi"),
    )


def instrument_deployments(objects: DataFrame) -> DataFrame:
    """One row per instrument mounted on a column; columns without any are absent."""
    c = objects.select("source_file", F.explode("specificInfo.columns").alias("c"))
    d = c.select("source_file", F.col("c.label").alias("column"),
                 F.explode("c.instrumentDeployments").alias("d"))
    profile = r"^(.+?)_(\d+)_(\d+)_(\d+)$"
    index = {
        k: F.nullif(F.regexp_extract("column", profile, i), F.lit("")).cast("int")
        for i, k in ((2, "r"), (3, "h"), (4, "v"))
    }
    return d.select(
        "source_file", "column",
        F.nullif(F.regexp_extract("column", profile, 1), F.lit("")).alias("base"),
        *[e.alias(k) for k, e in index.items()],
        F.col("d.instrument.label").alias("instrument"),
        F.col("d.instrument.uri").alias("instrument_uri"),
        F.coalesce(F.get("d.instrument.comments", 0), F.lit("")).alias("instrument_description"),
        F.col("d.pos.lat").alias("lat"), F.col("d.pos.lon").alias("lon"),
        F.col("d.pos.alt").alias("alt"),
        F.col("d.start").try_cast("timestamp").alias("start"),
        F.col("d.stop").try_cast("timestamp").alias("stop"),
    )


def object_citations(objects: DataFrame) -> DataFrame:
    """Resolver address and citation text of data objects; '' where absent."""
    pid = F.coalesce("pid", F.lit(""))
    return objects.select(
        "source_file",
        F.when(pid == "", "").otherwise(F.concat(F.lit(S.HANDLE_RESOLVER), pid)).alias("pid_url"),
        F.coalesce(names.strip_tags("references.citationString"), F.lit("")).alias("citation"),
    )


def deployments(objects: DataFrame) -> DataFrame:
    """Deployment dimension from ocean object documents."""
    acq = F.col("specificInfo.acquisition")
    return objects.select(
        names.deployment_id("source_file").alias("deployment"),
        acq["station"]["id"].alias("station_id"),
        acq["station"]["org"]["name"].alias("platform_name"),
        acq["station"]["countryCode"].alias("country_code"),
        acq["station"]["location"]["lat"].alias("lat"),
        acq["station"]["location"]["lon"].alias("lon"),
        acq["interval"]["start"].alias("time_start"),
        acq["interval"]["stop"].alias("time_end"),
        F.col("coverageGeo.type").alias("geo_type"),
        F.col("pid").alias("object_pid"),
        F.col("accessUrl").alias("source_url"),
        F.col("references.citationString").alias("citation"),
    )
