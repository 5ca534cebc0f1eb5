"""Space, time, label and position selections.

All of them are plain filters, so Catalyst pushes them to the scan; a station filter is applied to
the station dimension and reaches the facts through a semi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_box(lat: str, lon: str, south: float, north: float, west: float, east: float) -> Column:
    """Inclusive bounding-box predicate."""
    return F.col(lat).between(south, north) & F.col(lon).between(west, east)


def stations_in_box(dim, south, north, west, east, lat="lat", lon="lon") -> DataFrame:
    """Stations inside an inclusive box."""
    return dim.filter(in_box(lat, lon, south, north, west, east))


def facts_of(facts: DataFrame, dim: DataFrame, key: str = "station_id") -> DataFrame:
    """Facts of the listed stations with their dimension columns.

    No broadcast is forced: Spark broadcasts the filtered dimension when its measured size allows.
    """
    return facts.join(dim, key)


def time_slice(df: DataFrame, ts: str, first: str | None, last: str | None) -> DataFrame:
    """Rows from the start of ``first`` to the end of ``last``.

    Partial dates ("2024", "2024-03", "2024-03-05") cover their whole year, month or day. The bounds
    are literals of a half-open interval, so they are pushed down to the file scan.
    """
    out = df
    if first is not None:
        out = out.filter(F.col(ts) >= _partial(first, end=False))
    if last is not None:
        if len(last) > 10:
            out = out.filter(F.col(ts) <= _partial(last, end=False))
        else:
            out = out.filter(F.col(ts) < _partial(last, end=True))
    return out


def _partial(text: str, end: bool) -> Column:
    from datetime import datetime, timedelta

    if len(text) > 10:
        moment = datetime.fromisoformat(text)
    else:
        parts = [int(p) for p in text.split("-")]
        year, month, day = (parts + [1, 1])[:3]
        moment = datetime(year, month, day)
        if end and len(parts) == 1:
            moment = datetime(year + 1, 1, 1)
        elif end and len(parts) == 2:
            moment = datetime(year + month // 12, month % 12 + 1, 1)
        elif end:
            moment += timedelta(days=1)
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def labels(df: DataFrame, **coords) -> DataFrame:
    """Label selection: equality, or membership when a list is given."""
    for name, value in coords.items():
        if isinstance(value, (list, tuple, set)):
            df = df.filter(F.col(name).isin(list(value)))
        elif value is None:
            df = df.filter(F.col(name).isNull())
        else:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def station_match(df, column: str, ids=None, prefix: str | None = None, pattern: str | None = None):
    """Stations by list (letter case ignored), prefix or regular expression."""
    if ids is not None:
        df = df.filter(F.upper(F.col(column).cast("string")).isin([str(i).upper() for i in ids]))
    if prefix is not None:
        df = df.filter(F.startswith(F.col(column), F.lit(prefix)))
    if pattern is not None:
        df = df.filter(F.col(column).rlike(pattern))
    return df


class Selection:
    """A DataFrame with the list of selections made on it.

    Each step returns a new selection that shares the log; ``query_log`` turns the log into the
    ``query_log`` table that delivery records refer to.
    """

    def __init__(self, df, group: str, variable: str | None = None, log: list | None = None,
                 keys=("station_id",), ts="time", tie=()):
        self.df, self.group, self.variable = df, group, variable
        self.log = [] if log is None else log
        self.keys, self.ts, self.tie = list(keys), ts, list(tie)

    def _next(self, df, **changes) -> Selection:
        kw = dict(group=self.group, variable=self.variable, log=self.log, keys=self.keys,
                  ts=self.ts, tie=self.tie)
        kw.update(changes)
        return Selection(df, **kw)

    def _record(self, **entry):
        entry = {k: v for k, v in entry.items() if v is not None}
        entry["group"] = self.group
        if self.variable is not None:
            entry["variable"] = self.variable
        self.log.append(entry)

    def __getitem__(self, variable: str) -> Selection:
        chosen = self._next(self.df.filter(F.col("variable") == variable), variable=variable)
        chosen._record()
        return chosen

    def sel(self, **coords) -> Selection:
        shown = {
            k: {"start": v.start, "stop": v.stop, "step": v.step} if isinstance(v, slice) else v
            for k, v in coords.items()
        }
        self._record(op=None if self.variable else "sel", sel=shown)
        df = self.df
        for name, value in coords.items():
            if isinstance(value, slice):
                df = time_slice(df, name, value.start, value.stop)
            else:
                df = labels(df, **{name: value})
        return self._next(df)

    def isel(self, rows: slice | int) -> Selection:
        """Rows of every series by position; negative positions count from the end."""
        from .blocks import rows_between

        if isinstance(rows, int):
            self._record(op=None if self.variable else "isel", isel={self.ts: rows})
            rows = slice(rows, rows + 1 if rows != -1 else None)
        else:
            shown = {"start": rows.start, "stop": rows.stop, "step": rows.step}
            self._record(op=None if self.variable else "isel", isel={self.ts: shown})
        df = rows_between(
            self.df, self.keys, self.ts, self.tie, rows.start, rows.stop, rows.step or 1
        )
        return self._next(df)

    def where(
        self, condition: Column, text: str, extent: tuple[str, ...] = (), drop: bool = True,
        value: str = "value",
    ) -> Selection:
        """Rows that meet a condition; with ``drop=False`` all rows stay and other values are NULL.

        ``extent`` names coordinates whose smallest and largest value under the condition is recorded
        with it, one row of the data.
        """
        cond = {"repr": text}
        if extent:
            found = mask_extent(self.df, condition, *extent).first().asDict()
            cond["extent"] = {
                c: [None if found[f"{c}_{end}"] is None else str(found[f"{c}_{end}"])
                    for end in ("min", "max")] for c in extent
            }
        self._record(op="where", drop=drop, cond=cond)
        met = self.df.filter(condition)
        kept = self._next(
            met if drop else self.df.withColumn(value, F.when(condition, F.col(value)))
        )
        self.log[-1]["_survivors"] = met.select(self.keys[0]).distinct()
        return kept

    def record(self, **entry) -> None:
        self._record(op="user_recorded", **entry)

    def query_log(self, session: str) -> DataFrame:
        """The log as rows, one per call; a mask carries the stations that survive it.

        The station list of an entry is bounded by the station dimension.
        """
        import json
        from functools import reduce

        spark, key = self.df.sparkSession, self.keys[0]
        shown = [{k: v for k, v in e.items() if k != "_survivors"} for e in self.log]
        rows = [
            (session, i, e.get("op"), e.get("variable"), e["group"], json.dumps(e, sort_keys=True))
            for i, e in enumerate(shown)
        ]
        schema = (
            "session STRING, seq BIGINT, op STRING, variable STRING, `group` STRING, payload STRING"
        )
        log = spark.createDataFrame(rows, schema)
        masks = [
            e["_survivors"].select(
                F.lit(i).cast("bigint").alias("seq"), F.col(key).cast("string").alias("_s"))
            for i, e in enumerate(self.log) if "_survivors" in e
        ]
        if not masks:
            return log.withColumn("surviving_stations", F.lit(None).cast("array<string>"))
        lists = reduce(lambda a, b: a.unionByName(b), masks).groupBy("seq").agg(
            F.sort_array(F.collect_list("_s")).alias("surviving_stations")
        )
        return log.join(lists, "seq", "left").select(*log.columns, "surviving_stations")


def mask_extent(df: DataFrame, condition: Column, *coords: str) -> DataFrame:
    """Smallest and largest value of each coordinate where the condition holds."""
    aggs = []
    for c in coords:
        hit = F.when(condition, F.col(c))
        aggs += [F.min(hit).alias(f"{c}_min"), F.max(hit).alias(f"{c}_max")]
    return df.agg(*aggs)
