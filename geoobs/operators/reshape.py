"""Wide sensor columns to labelled rows and back.

The header is metadata: it is classified on the driver into ``ColumnRole`` entries. The data pass is
one ``explode`` of an array of structs per product, so no shuffle is needed whatever the width.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean


@dataclass(frozen=True)
class ColumnRole:
    """What one wide column holds: a statistic of a variable at some label coordinates."""

    column: str
    family: str
    variable: str
    stat: str = "value"
    labels: dict = field(default_factory=dict, hash=False)

    def label(self, name: str):
        return self.labels.get(name)


def _stat(tokens: list[str], known: tuple[str, ...]) -> tuple[list[str], str]:
    """A column name without the statistic it ends in, and that statistic."""
    if len(tokens) > 1 and tokens[-1] in known:
        return tokens[:-1], tokens[-1].lower()
    return tokens, "value"


def _numbers(tokens: list[str], n: int) -> tuple[str, list[int]] | None:
    """Base name and the last ``n`` tokens as numbers, if that is what a name ends in."""
    base, tail = "_".join(tokens[:-n]), tokens[-n:]
    if base and all(t.isdecimal() for t in tail):
        return base, [int(t) for t in tail]
    return None


def _thresholded(tokens: list[str]) -> tuple[dict, list[str]] | None:
    """Labels of a USTAR threshold and a variant at the start of ``tokens``, and what follows."""
    if len(tokens) < 2 or tokens[0] not in S.USTAR_LABELS:
        return None
    # Percentiles are bare numbers in a header.
    variant = f"p{tokens[1]}" if tokens[1].isdecimal() else tokens[1]
    if variant not in S.VARIANT_LABELS or tokens[1].startswith("p"):
        return None
    return {"ustar_threshold": tokens[0], "nee_variant": variant}, tokens[2:]


def _named_family(col: str) -> ColumnRole | None:
    """Role of a column of the flux, partitioning, soil, energy or profile families.

    The name is read token by token against the label vocabularies.
    """
    head, *rest = col.split("_")
    if head == "NEE" and (read := _thresholded(rest)):
        labels, stat = read[0], "_".join(read[1])
        if not read[1] or stat in S.NEE_STATS:
            return ColumnRole(col, "nee", "NEE", stat.lower() or "value", labels)
        if stat in S.NEE_NOTES:
            return None
    if head in S.PARTITIONED and rest and rest[0] in S.PARTITION_LABELS:
        read = _thresholded(rest[1:])
        if read and read[1] in ([], ["QC"]):
            labels = {"partition_method": rest[0], **read[0]}
            return ColumnRole(col, "partitioned", head, "qc" if read[1] else "value", labels)
    if head in S.SOIL and rest[:2] == ["F", "MDS"]:
        tokens, stat = _stat(rest[2:], ("QC",))
        if len(tokens) == 1 and tokens[0].isdecimal():
            return ColumnRole(col, "soil", head, stat, {"soil_layer": int(tokens[0])})
    if head in S.ENERGY and rest[:1] == ["CORR"]:
        pct = f"p{rest[1]}" if len(rest) == 2 else "p50"
        if len(rest) <= 2 and (len(rest) == 1 or pct in ("p25", "p75")):
            return ColumnRole(col, "energy", f"{head}_CORR", "value", {"corr_pct": pct})
    tokens, stat = _stat([head, *rest], ("N", "SE", "QC"))
    if placed := _numbers(tokens, 3):
        return ColumnRole(col, "profile", placed[0], stat, dict(zip("rhv", placed[1])))
    return None


def _is_note(col: str) -> bool:
    """A method or count column of a flux uncertainty, which stays as it is."""
    head, *rest = col.split("_")
    read = _thresholded(rest) if head == "NEE" else None
    return read is not None and "_".join(read[1]) in S.NEE_NOTES


def classify_columns(columns: list[str]) -> list[ColumnRole]:
    """Role of every data column of one product header.

    A single trailing index makes a level axis only when its base has two indices or an index with
    both a value and a statistic; everything unmatched stays a plain 1-D variable.
    """
    roles: dict[str, ColumnRole] = {}
    single: dict[str, list[tuple[str, int, str]]] = defaultdict(list)
    data = [c for c in columns if c not in S.TIME_COLUMNS]
    for col in data:
        if role := _named_family(col):
            roles[col] = role
        elif not _is_note(col):
            tokens, stat = _stat(col.split("_"), ("N", "SE", "SD", "QC"))
            if placed := _numbers(tokens, 1):
                single[placed[0]].append((col, placed[1][0], stat))
    for base, members in single.items():
        by_level: dict[int, set[str]] = defaultdict(set)
        for _, level, stat in members:
            by_level[level].add(stat)
        paired = any("value" in stats and len(stats) > 1 for stats in by_level.values())
        if len(by_level) > 1 or paired:
            for col, level, stat in members:
                roles[col] = ColumnRole(col, "level", base, stat, {"level": level})
    return [roles.get(c, ColumnRole(c, "plain", c)) for c in data]


def resolve_names(roles: list[ColumnRole]) -> dict[tuple[str, str], str]:
    """(family, variable) -> stored name; a later family that repeats a base name gets a suffix."""
    order = ["nee", "partitioned", "soil", "energy", "profile", "level", "plain"]
    used: set[str] = set()
    names: dict[tuple[str, str], str] = {}
    for family in order:
        for role in roles:
            key = (role.family, role.variable)
            if role.family != family or key in names:
                continue
            # A 1-D variable keeps its name or takes "_raw"; the others go through the list.
            suffixes = ["", "_raw"] if family == "plain" else S.COLLISION_SUFFIXES
            free = [role.variable + s for s in suffixes if role.variable + s not in used]
            if not free:
                raise ValueError(f"no free name for {role.variable}")
            names[key] = free[0]
            used.add(free[0])
    return names


def mapping_table(spark, roles: list[ColumnRole], product: str = "") -> DataFrame:
    """The header mapping as a DataFrame (one row per wide column)."""
    names = resolve_names(roles)
    rows = [
        (
            product, r.column, r.family, names[r.family, r.variable], r.stat,
            *[None if r.label(n) is None else str(r.label(n)) for n in S.FLUX_LABELS],
        )
        for r in roles
    ]
    labels = ", ".join(f"{n} STRING" for n in S.FLUX_LABELS)
    schema = f"product STRING, column STRING, family STRING, variable STRING, stat STRING, {labels}"
    return spark.createDataFrame(rows, schema)


_LABEL_TYPES = {n: "int" if n in ("soil_layer", "r", "h", "v", "level") else "string"
                for n in S.FLUX_LABELS}


def pick(roles: list[ColumnRole], *variables: str, **labels) -> list[ColumnRole]:
    """Roles of some variables and labels; the scan then reads only their columns."""
    return [
        r for r in roles
        if (not variables or r.variable in variables)
        and all(r.label(k) == v for k, v in labels.items())
    ]


def to_long(
    df: DataFrame, keys: list[str], roles: list[ColumnRole], keep_missing: bool = False,
    stored: dict[tuple[str, str], str] | None = None,
) -> DataFrame:
    """One row per key, variable and label coordinates with all statistics side by side.

    The exploded structs carry the cell number and raw values only. Labels come from a constant
    array and values are cleaned once after the explode, which keeps the generated code small
    however wide the product is. ``stored`` holds the variable names of the whole header when
    ``roles`` is a part of it.
    """
    names = stored or resolve_names(roles)
    cells: dict[tuple, dict[str, ColumnRole]] = defaultdict(dict)
    for role in roles:
        coords = tuple(role.label(n) for n in S.FLUX_LABELS)
        cells[(names[role.family, role.variable], *coords)][role.stat] = role
    stats = [s for s in S.FLUX_STATS if any(s in by_stat for by_stat in cells.values())]

    def raw(role: ColumnRole | None) -> Column:
        if role is None:
            return F.lit(None).cast("double")
        return F.col(f"`{role.column}`").try_cast("double")

    labels = F.array(*[
        F.struct(
            F.lit(variable).alias("variable"),
            *[F.lit(v).cast(_LABEL_TYPES[n]).alias(n) for n, v in zip(S.FLUX_LABELS, coords)],
        )
        for variable, *coords in cells
    ])
    structs = [
        F.struct(F.lit(i).alias("_i"), *[raw(by_stat.get(s)).alias(s) for s in stats])
        for i, by_stat in enumerate(cells.values())
    ]
    rows = df.select(*keys, F.explode(F.array(*structs)).alias("_cell")).select(*keys, "_cell.*")
    cleaned = {
        s: clean.clean_qc(s).cast("double") if s == "qc" else clean.clean_value(s) for s in stats
    }
    rows = rows.withColumns(cleaned)
    if not keep_missing:
        rows = rows.filter(F.coalesce(*stats).isNotNull())
    out = rows.withColumn("_label", F.get(labels, F.col("_i")))
    return out.select(
        *keys, "_label.*",
        *[F.col(s) if s in stats else F.lit(None).cast("double").alias(s) for s in S.FLUX_STATS],
    )


def pivot_wide(
    df: DataFrame, index: list[str], key: str, values: list, value: str = "value",
    prefix: str = "",
) -> DataFrame:
    """Rows of ``index`` with one column per listed value of ``key``."""
    # Conditional maxima aggregate map-side and never need a pass to find the key values.
    aggs = [
        F.max(F.when(F.col(key) == F.lit(v), F.col(value))).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(*index).agg(*aggs)


def pack_labels(
    df: DataFrame, keys: list[str], label: str, labels: list, value: str = "value",
    name: str = "packed",
) -> DataFrame:
    """One array per key holding the values of all labels in order; absent labels are NULL."""
    slots = [F.max(F.when(F.col(label) == F.lit(v), F.col(value))) for v in labels]
    return df.groupBy(*keys).agg(F.array(*slots).alias(name))


def densify(
    df: DataFrame, keys: list[str], label: str, labels: list, value: str = "value"
) -> DataFrame:
    """Every key x label row, absent combinations with a NULL value."""
    packed = pack_labels(df, keys, label, labels, value, "_cells")
    order = F.array(*[F.lit(v) for v in labels])
    cells = F.explode(F.arrays_zip(order.alias(label), F.col("_cells").alias(value)))
    return packed.select(*keys, cells.alias("_c")).select(
        *keys, F.col("_c")[label].alias(label), F.col("_c")[value].alias(value)
    )


def station_independent(df: DataFrame) -> DataFrame:
    """Rows whose variable has no station-specific index, fit for a combined view."""
    return df.filter(
        F.col("level").isNull() & F.col("r").isNull() & F.col("h").isNull() & F.col("v").isNull()
        & F.col("soil_layer").isNull()
        & ~F.col("variable").isin("time_bounds", "obspack_id")
    )


# --- type inference -----------------------------------------------------------------------------


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: value count, text count, integrality, minimum and maximum.

    All columns are profiled in one pass with map-side partial aggregates.
    """
    structs = []
    for c in columns:
        x = clean.clean_value(F.col(f"`{c}`"))
        text = F.col(f"`{c}`").cast("string")
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("n_values"),
                F.count_if(text.isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(
                    "n_text"
                ),
                F.coalesce(F.bool_and(x == F.floor(x)), F.lit(False)).alias("integral"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    profiles = df.agg(F.array(*structs).alias("ps"))
    return profiles.select(F.explode("ps").alias("p")).select("p.*")


def storage_type(profile: DataFrame, kind: str = "value") -> DataFrame:
    """Narrowest storage type per profiled column: ``value``, ``count`` or ``qc`` rules."""
    lo, hi, n = F.col("min"), F.col("max"), F.col("n_values")
    if kind == "count":
        top = F.coalesce(hi, F.lit(0.0))
        storage = (
            F.when(top <= 127, "tinyint").when(top <= 32767, "smallint").otherwise("int")
        )
    elif kind == "qc":
        # Missing flags count as zero here, so an empty column is a small integer.
        top = F.coalesce(hi, F.lit(0.0))
        storage = (
            F.when((n > 0) & ~F.col("integral"), "float")
            .when(top <= 254, "smallint")
            .when(top <= 2147483647, "int")
            .otherwise("bigint")
        )
    else:
        storage = (
            F.when((n == 0) | ~F.col("integral"), "float")
            .when((lo >= -128) & (hi <= 127), "tinyint")
            .when((lo >= -32768) & (hi <= 32767), "smallint")
            .when((lo >= -2147483648) & (hi <= 2147483647), "int")
            .otherwise("bigint")
        )
    return profile.withColumn("storage", F.when(F.col("n_text") > 0, "text").otherwise(storage))


def narrow(df: DataFrame, columns: list[str], kind: str = "value") -> DataFrame:
    """Columns cast to their inferred storage; text columns are dropped.

    The inference result has one row per column, which is what reaches the driver.
    """
    storage = {
        r["column"]: r["storage"] for r in storage_type(column_profile(df, columns), kind).collect()
    }
    out = []
    for c in df.columns:
        if c not in storage:
            out.append(F.col(f"`{c}`"))
        elif storage[c] != "text":
            out.append(clean.clean_value(F.col(f"`{c}`")).cast(storage[c]).alias(c))
    return df.select(*out)
