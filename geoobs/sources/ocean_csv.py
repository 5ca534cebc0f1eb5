"""Ship and buoy CSV files: preamble, column labels, timestamps and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean, names


# Every break that ends a text line, the two-character one first.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, line_no, line); each file is one row of the scan, so line numbers are exact."""
    files = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value")
    )
    return split_lines(files, "file", "value")


def block_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, block, line_no, line) of files of any size, each block of a file a task of its own.

    Numbers rise within a block and are unique; they are not the line numbers of the file. Lines end
    at the breaks of Spark's text reader.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"),
    )


def split_lines(df: DataFrame, file: str, text: str) -> DataFrame:
    lines = F.split(F.col(text), LINE_BREAK)
    return df.select(file, F.posexplode(lines).alias("line_no", "line"))


def body_lines(df: DataFrame, file: str, text: str, marker: str = "TIMESTAMP") -> DataFrame:
    """(file, line_no, line) from the first line that starts with ``marker``, else from the start.

    A file is one value, so its header is found inside the row: no shuffle and no second read.
    """
    lines = F.split(F.col(text), LINE_BREAK)
    starts = F.transform("_lines", lambda l: F.startswith(l, F.lit(marker)))
    head = F.greatest(F.array_position(starts, True), F.lit(1)).cast("int")
    found = df.select(file, lines.alias("_lines")).withColumn("_head", head)
    body = F.slice("_lines", F.col("_head"), F.size("_lines"))
    return found.select(file, "_head", F.posexplode(body).alias("_i", "line")).select(
        file, (F.col("_head") - 1 + F.col("_i")).alias("line_no"), "line",
        (F.col("_i") == 0).alias("is_header"),
    )


def skip_preamble(lines: DataFrame, file: str, marker: str = "TIMESTAMP") -> DataFrame:
    """The same on a table of lines, such as archive members that are too large for one value."""
    head = lines.groupBy(file).agg(
        F.coalesce(
            F.min(F.when(F.startswith("line", F.lit(marker)), F.col("line_no"))), F.lit(0)
        ).alias("_head")
    )
    return lines.join(head, file).filter("line_no >= _head").withColumn(
        "is_header", F.col("line_no") == F.col("_head")
    ).drop("_head")


def short_names(labels: DataFrame, file: str, position: str, label: str) -> DataFrame:
    """Short column names of each header: known labels, ``X_QC`` for flags, else sanitised.

    Labels that give the same name are numbered ``_2``, ``_3``... in header order; comment and type
    columns are left out. The window covers the columns of one header.
    """
    keep = ~F.endswith(F.lower(label), F.lit(" qc comment")) & ~F.endswith(
        F.lower(label), F.lit(" type")
    )
    text = F.when(F.lower(label) == "date/time", "TIMESTAMP").otherwise(F.col(label))
    qc = F.regexp_like(text, F.lit(r"(?i)\s*QC Flag$"))
    base = F.when(qc, F.trim(F.regexp_replace(text, r"(?i)\s*QC Flag$", ""))).otherwise(text)
    known = F.create_map(*[F.lit(x) for pair in S.OCEAN_NAMES.items() for x in pair])
    safe = F.regexp_replace(F.regexp_replace(base, "[^0-9a-zA-Z_]+", "_"), "^_+|_+$", "")
    plain = F.coalesce(
        F.try_element_at(known, base), F.nullif(safe, F.lit("")), F.lit("var")
    )
    candidate = F.when(qc, F.concat(plain, F.lit("_QC"))).otherwise(plain)
    nth = F.row_number().over(Window.partitionBy(file, "_name").orderBy(position))
    return (
        labels.filter(keep)
        .withColumns({"_name": candidate, "is_qc": qc})
        .withColumn(
            "short_name",
            F.when(nth == 1, F.col("_name")).otherwise(
                F.concat("_name", F.lit("_"), nth.cast("string"))),
        )
        .drop("_name")
    )


def parse_time(col: str) -> Column:
    """UTC timestamp or NULL; ISO forms with or without zone and blank-separated ones are read."""
    s = F.trim(F.col(col))
    zoned = F.regexp_like(s, F.lit(r"(Z|[+-]\d\d:?\d\d)$"))
    return F.when(zoned, F.try_to_timestamp(s).cast("timestamp_ntz")).otherwise(
        F.col(col).try_cast("timestamp_ntz")
    )


def good_times(df: DataFrame, ts: str, observation=None) -> DataFrame:
    """Rows with a readable timestamp; ``observation`` receives the number of dropped rows."""
    parsed = df.withColumn("time", parse_time(ts))
    if observation is not None:
        parsed = parsed.observe(
            observation, F.count_if(F.col("time").isNull()).alias("bad_timestamps")
        )
    return parsed.filter(F.col("time").isNotNull())


def to_rows(df: DataFrame, keys: list[str], mapping: dict[str, tuple[str, str | None]]):
    """Wide ocean rows to (keys, variable, value, qc).

    ``mapping`` gives short name -> (value column, flag column or None).
    """
    cells = [
        F.struct(
            F.lit(short).alias("variable"),
            F.col(f"`{value}`").try_cast("double").alias("value"),
            (clean.ocean_qc(f"`{flag}`") if flag else F.lit(None).cast("tinyint")).alias("qc"),
        )
        for short, (value, flag) in mapping.items()
    ]
    return df.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.*")


def skip_block_preamble(lines: DataFrame, marker: str = "TIMESTAMP") -> DataFrame:
    """``skip_preamble`` for ``block_lines``: the header lies in the first block of a file."""
    first = lines.filter("block = 0").groupBy("file").agg(
        F.coalesce(
            F.min(F.when(F.startswith("line", F.lit(marker)), F.col("line_no"))),
            F.min("line_no"),
        ).alias("_head")
    )
    return lines.join(first, "file").filter("block > 0 OR line_no >= _head").withColumn(
        "is_header", (F.col("block") == 0) & (F.col("line_no") == F.col("_head"))
    ).drop("_head", "block")


# A comma outside of quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def cells(line: str | Column) -> Column:
    """Fields of a CSV line; quotes around a field are taken off, doubled ones inside become one."""
    plain = lambda c: F.when(
        F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')) & (F.length(c) > 1),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')),
    ).otherwise(c)
    text = F.col(line) if isinstance(line, str) else line
    return F.transform(F.split(text, _COMMA, -1), lambda c: plain(F.trim(c)))


def file_rows(df: DataFrame, file: str, text: str, marker: str = "TIMESTAMP") -> DataFrame:
    """Facts of ocean files: (file, line_no, stamp, variable, value, qc).

    The header of each file names its columns; ``stamp`` is the text of its time column, to be read by
    ``good_times``. Values that are no numbers are NULL, fields missing at the end of a line too. A
    line is read where it is: only the names, one row a file, are joined.
    """
    return body_rows(body_lines(df, file, text, marker), file)


def body_rows(body: DataFrame, file: str) -> DataFrame:
    """The same of (file, line_no, line, is_header), as the readers of lines give them."""
    labels = body.filter("is_header").select(
        file, F.posexplode(cells("line")).alias("pos", "label")
    )
    column = F.struct("pos", "short_name", "is_qc")
    named = short_names(labels, file, "pos", "label").groupBy(file).agg(
        F.array_sort(F.collect_list(column)).alias("_columns")
    )
    lines = body.filter(~F.col("is_header") & (F.trim("line") != "")).withColumn(
        "_cells", cells("line")
    ).join(named, file)

    def at(name: Column) -> Column:
        found = F.filter("_columns", lambda c: c["short_name"] == name)
        return F.get("_cells", F.get(found, F.lit(0))["pos"])

    measured = F.filter(
        "_columns", lambda c: ~c["is_qc"] & ~c["short_name"].isin("time", "lon", "lat")
    )
    facts = F.transform(measured, lambda c: F.struct(
        c["short_name"].alias("variable"),
        F.get("_cells", c["pos"]).try_cast("double").alias("value"),
        at(F.concat(c["short_name"], F.lit("_QC"))).alias("flag"),
    ))
    out = lines.select(file, "line_no", at(F.lit("time")).alias("stamp"),
                       at(F.lit("lon")).try_cast("double").alias("lon"),
                       at(F.lit("lat")).try_cast("double").alias("lat"),
                       F.explode(facts).alias("_f"))
    return out.select(
        file, "line_no", "stamp", "lon", "lat", "_f.variable", "_f.value",
        clean.ocean_qc("_f.flag").alias("qc"),
    )


def variable_attributes(columns: DataFrame, label: str, unit: str, quantity: str) -> DataFrame:
    """Unit, long name and standard name of labelled columns."""
    return columns.withColumns({
        "units": names.unit_of_label(label, unit),
        "long_name": F.col(quantity),
        "standard_name": F.when(
            F.col(quantity).isNotNull(), names.standard_name(quantity, label)),
    })
