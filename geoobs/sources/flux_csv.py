"""Half-hourly to yearly flux CSV files, and archives of them.

Lines are read once and parsed by the header of their file; only the distinct headers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean, names
from ..operators import reshape
from ..session import shared_dir
from . import archives


def file_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, at, line) of text files; ``at`` orders the lines of a file's first split, which holds its
    header, and is null in later ones."""
    at = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), at.alias("at"), F.col("value").alias("line")
    )


def headers_of(lines: DataFrame) -> DataFrame:
    """(path, columns) of each file; a header that is wrapped over two lines is joined.

    The header is the first line that is not blank and, if it does not start with a number, the one
    after it. Later text lines belong to no header.
    """
    first = lines.filter(F.col("at").isNotNull() & (F.trim("line") != ""))
    nth = F.row_number().over(Window.partitionBy("path").orderBy("at"))
    # The rank limit is applied before the shuffle, which gets two lines of a file.
    both = first.withColumn("nth", nth).filter("nth <= 2").groupBy("path").agg(
        F.max(F.when(F.col("nth") == 1, F.col("line"))).alias("a"),
        F.max(F.when(F.col("nth") == 2, F.col("line"))).alias("b"),
    )
    wrapped = ~F.regexp_like("b", F.lit("^ *[0-9]+ *(,|$)"))
    text = F.concat("a", F.when(wrapped, F.col("b")).otherwise(F.lit("")))
    return both.select("path", F.split(text, ",").alias("columns"))


def headers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, columns) of each file at ``paths``."""
    return headers_of(file_lines(spark, paths))


def by_header(lines: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """One DataFrame of text columns for each distinct header in ``lines`` (path, at, line).

    Headers are found once and stored, so Spark knows their size when lines meet the header of their file
    in a join. Lines of several headers are written once, apart by header, so every DataFrame reads its
    own lines only; lines of one header are left where they are. The driver sees the distinct headers,
    never a list of files. Header lines and other lines that do not begin with digits are dropped.
    """
    spark = lines.sparkSession
    found = shared_dir(spark, "headers")
    headers_of(lines).withColumn(
        "header", F.concat(F.lit("h"), F.hex(F.xxhash64("columns")))).write.parquet(found)
    named = spark.read.schema("path string, columns array<string>, header string").parquet(found)
    kinds = [tuple(r) for r in named.groupBy("header").agg(F.first("columns")).collect()]
    of_file = named.select(F.col("path").alias("_path"), "header")
    met = lines.join(of_file, F.col("path") == F.col("_path")).select("header", "path", "line")
    if len(kinds) > 1:
        at = shared_dir(spark, "lines-by-header")
        met.write.partitionBy("header").parquet(at)
        met = spark.read.schema("path string, line string, header string").parquet(at)
    out = []
    for header, columns in sorted(kinds):
        # A generator, so that the filter on the first column does not parse lines a second time.
        parsed = F.inline(F.array(F.from_csv("line", _ddl(columns))))
        rows = met.filter(F.col("header") == header).select(F.col("path").alias("source_file"), parsed)
        rows = rows.select(*[F.col(f"`{c.replace('`', '``')}`") for c in rows.columns[1:]], "source_file")
        digits = F.regexp_like(F.trim(F.col(f"`{columns[0]}`")), F.lit("^[0-9]+$"))
        out.append((columns, rows.filter(digits)))
    return out


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)


def read_all(spark: SparkSession, paths: list[str] | str) -> list[tuple[list[str], DataFrame]]:
    """One DataFrame of text columns for each distinct header of the files at ``paths``."""
    return by_header(file_lines(spark, paths))


def read_archives(
    spark: SparkSession, paths: list[str] | str
) -> list[tuple[list[str], DataFrame]]:
    """One DataFrame of text columns for each distinct header of the product members of archives.

    Members are inflated once and their lines stored, for headers and lines are both read from them.
    """
    inflated = shared_dir(spark, "archive-lines")
    archive_lines(spark, paths).select(
        F.concat_ws("/", "archive", "member").alias("path"), F.col("line_no").alias("at"), "line"
    ).write.parquet(inflated)
    return by_header(spark.read.schema("path string, at bigint, line string").parquet(inflated))


def convert(df: DataFrame, columns: list[str], freq: str | None = None) -> DataFrame:
    """Wide text rows to the long fact table with site, product, frequency and period."""
    start = "TIMESTAMP_START" if "TIMESTAMP_START" in columns else "TIMESTAMP"
    info = names.parse_flux_tokens("_tokens")
    code = F.lit(freq) if freq else F.coalesce(names.freq_from_name("source_file"), F.lit("HH"))
    # Tokens are a column of their own, so that a name is taken apart once for each row.
    base = df.withColumn("_tokens", names.flux_tokens("source_file")).withColumns({
        "site_id": info["site_id"], "product": info["product"], "freq": code,
        "ts_start": clean.parse_flux_time(start),
    })
    end = (
        clean.parse_flux_time("TIMESTAMP_END") if "TIMESTAMP_END" in columns
        else clean.period_end("ts_start", "freq")
    )
    keys = ["site_id", "product", "freq", "ts_start", "ts_end", "source_file"]
    roles = reshape.classify_columns(columns)
    return reshape.to_long(base.withColumn("ts_end", end), keys, roles)


def infer_frequency(df: DataFrame, file: str, ts: str) -> DataFrame:
    """Frequency per file from the spacing of its two earliest rows; HH when there is one row.

    Two map-side aggregates replace an ordered window over the file.
    """
    first = df.groupBy(file).agg(F.min(ts).alias("_t0"))
    later = F.when(F.col(ts) > F.col("_t0"), F.col(ts))
    spaced = df.join(first, file).groupBy(file).agg(
        F.first("_t0").alias("_t0"), F.min(later).alias("_t1"),
        F.count_if(F.col(ts) == F.col("_t0")).alias("_same"), F.count(ts).alias("_n"),
    )
    minutes = F.when(F.col("_same") > 1, F.lit(0)).otherwise(
        F.timestamp_diff("MINUTE", F.col("_t0"), F.col("_t1"))
    )
    code = F.lit("YY")
    for name, limit in reversed(S.FREQ_LIMITS):
        code = F.when(minutes <= limit, name).otherwise(code)
    return spaced.select(file, F.when(F.col("_n") < 2, "HH").otherwise(code).alias("freq"))


def sibling_files(files: DataFrame, path: str) -> DataFrame:
    """Files grouped by their name without the frequency token."""
    code = names.freq_from_name(path)
    series = F.regexp_replace(
        names.stem(path), F.concat(F.lit("(?i)_"), code, F.lit("_")), F.lit("_*_")
    )
    return files.withColumns({"freq": code, "series": series})


def needed_member(name: str) -> Column:
    """Archive members that hold a product, whatever folder they sit in."""
    return names.is_member(F.element_at(F.split(F.col(name), "/"), -1))


def archive_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(archive, member, line_no, line) of the product files inside zip archives.

    Only the bytes of product members are shuffled and inflated, one task a member.
    """
    rows = archives.byte_rows(spark, paths)
    lines = archives.member_lines(rows, archives.members(rows).filter(needed_member("member")))
    return lines.withColumn("member", F.element_at(F.split("member", "/"), -1))
