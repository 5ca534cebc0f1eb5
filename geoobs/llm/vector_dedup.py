"""Near-duplicate vectors by sorted projection passes.

A pass orders all vectors lexicographically by their concatenated random hashes (signs of random
projections) and compares each with the next few in that order. Verified pairs of all passes are
united into components, and passes are added until a round of them unites nothing more, so that a group
which the hashes hardly split gets more of them. Links are then counted over all pairs of a component, so the counts do not
depend on which pairs a window happened to hold. Equal vectors are one class throughout, and a pass
yields at most one link for each vector, never all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, stored
from .components import connected_components
from .vectors import by_dimension, finite, nonzero, one_per_id, unit

SIMILAR = 0.9
WINDOW = 64
MISS = 0.005
BITS = 62
TILE = 2048
# Rows of a pass that one task sorts.
TASK_ROWS = 25_000


def passes_needed(n: int, similar: float, window: int, miss: float) -> int:
    """Passes after which a pair at the threshold has been missed with a chance of about ``miss``,
    where the hashes split the vectors evenly; the first round has as many.

    Two vectors meet in a window if they share about log2(n / window) leading hashes; one hash agrees
    with chance 1 - angle / pi. A fifth is taken off for windows that a longer run overflows.
    """
    shared = max(0.0, math.log2(max(1, n) / window))
    met = 0.8 * (1 - math.acos(similar) / math.pi) ** shared
    return max(3, math.ceil(math.log(miss) / math.log(1 - met)))


def _planes(dim: int, k: int) -> np.ndarray:
    return np.random.default_rng([dim, k]).normal(size=(dim, BITS))


def _hashed(passes: range):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for dim, rows, x in by_dimension(batch.column(1)):
                x = unit(x)
                raw = pa.array([r.tobytes() for r in x], pa.binary())
                for k in passes:
                    keys = ((x @ _planes(dim, k)) > 0) @ weights
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), k, np.int32)),
                        pa.array(np.full(len(rows), dim, np.int32)),
                        pa.array(keys), pa.array(ids[rows]), raw,
                    ], names=["pass", "dim", "key", "id", "vector"])

    return hashes


def _united(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each one's group under the links a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _windowed(x: np.ndarray, window: int, similar: float, block: int = 256):
    """Pairs of rows at most ``window`` apart whose cosine is ``similar`` or more."""
    firsts, seconds = [], []
    for at in range(0, len(x) - 1, block):
        near = x[at:at + block + window]
        own = near[:block]
        i, j = np.nonzero(own @ near.T >= similar)
        ahead = (j > i) & (j - i <= window)
        firsts.append(i[ahead] + at)
        seconds.append(j[ahead] + at)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *firsts]), np.concatenate([none, *seconds])


_FOUND = "a bigint, b bigint, edge int, place int, pass int, dim int, vector binary"


def _scan(window: int, similar: float):
    """Links within a sorted partition, and its first and last rows for the windows across."""

    def links(ids: np.ndarray, x: np.ndarray):
        label = _united(len(ids), *_windowed(x, window, similar))
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return ids[moved], ids[label[moved]]

    def out(a, b=None, edge=-1, place=None, run=(None, None), vectors=None):
        n = len(a)
        full = lambda v, t: pa.array([v] * n, t)
        return pa.RecordBatch.from_arrays([
            pa.array(a, pa.int64()),
            full(None, pa.int64()) if b is None else pa.array(b, pa.int64()),
            full(edge, pa.int32()),
            full(None, pa.int32()) if place is None else pa.array(place, pa.int32()),
            full(run[0], pa.int32()), full(run[1], pa.int32()),
            full(None, pa.binary()) if vectors is None
            else pa.array([v.tobytes() for v in vectors], pa.binary()),
        ], names=["a", "b", "edge", "place", "pass", "dim", "vector"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, ids, x, first = None, None, None, True
        for batch in batches:
            passes, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.flatnonzero((passes[1:] != passes[:-1]) | (dims[1:] != dims[:-1])) + 1
            for lo, hi in zip([0, *new], [*new, batch.num_rows]):
                if lo == hi:
                    continue
                here = (int(passes[lo]), int(dims[lo]))
                got_ids = batch.column(3).to_numpy()[lo:hi]
                raw = b"".join(batch.column(4).slice(lo, hi - lo).to_pylist())
                got = np.frombuffer(raw, np.float64).reshape(hi - lo, here[1])
                if here != run:
                    run, ids, x = here, got_ids, got
                else:
                    ids, x = np.concatenate([ids, got_ids]), np.concatenate([x, got])
                if first:  # the window of the partition before this one reaches in here
                    head = min(window, len(ids))
                    yield out(ids[:head], edge=part - 1, place=np.arange(head) + window, run=run,
                              vectors=x[:head])
                    first = False
                yield out(*links(ids, x))
                ids, x = ids[-window:], x[-window:]
        if ids is not None:
            yield out(ids, edge=part, place=np.arange(len(ids)), run=run, vectors=x)

    def across(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending")])
        dim = rows["dim"][0].as_py()
        x = np.frombuffer(b"".join(rows["vector"].to_pylist()), np.float64).reshape(-1, dim)
        a, b = links(rows["a"].to_numpy(), x)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return scan, across


def _links(classes: DataFrame, n: int, passes: range, window: int, similar: float) -> DataFrame:
    """``a``, ``b``: links that the given passes over the ``n`` classes find."""
    hashed = classes.select("id", "vector").mapInArrow(
        _hashed(passes), "pass int, dim int, key bigint, id bigint, vector binary"
    )
    order = ["pass", "dim", "key", "id"]
    tasks = max(1, math.ceil(n * len(passes) / TASK_ROWS))
    dealt = hashed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    scan, across = _scan(window, similar)
    found = stored(dealt.mapInArrow(scan, _FOUND), "vector-passes")
    edges = found.filter("edge >= 0 AND place IS NOT NULL")
    between = edges.groupBy("edge", "pass", "dim").applyInArrow(across, "a bigint, b bigint")
    return found.filter("b IS NOT NULL").select("a", "b").unionAll(between)


def _apart(links: DataFrame, component: DataFrame) -> DataFrame:
    """``a``, ``b``: components, or nodes of none, that ``links`` join and ``component`` does not."""
    for end in ("a", "b"):
        of = component.select(F.col("node").alias(end), F.col("component").alias("_in"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("_in", end)).drop("_in")
    return links.filter("a <> b").distinct()


def _counted(similar: float):
    """Vectors linked with each member of a cell, by the weight of their class."""

    def count(rows: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(rows["vector"].to_pylist()), np.float64).reshape(
            rows.num_rows, -1)
        weight, part = rows["copies"].to_numpy(), rows["part"].to_numpy()
        own = rows["own"].to_numpy(zero_copy_only=False)
        total = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x), 256):
            near = x[at:at + 256] @ x.T >= similar
            i = np.arange(len(near))
            near[i, i + at] = False
            # Pairs within a part count in one of the cells that hold the part.
            same = part[at:at + 256, None] == part
            near &= ~same | own[at:at + 256, None]
            total[at:at + 256] = near @ weight
        return pa.table({"id": rows["id"], "n": pa.array(total)})

    return count


def near_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", *,
    similar: float = SIMILAR, window: int = WINDOW, miss: float = MISS,
    passes: int | None = None, tile: int = TILE,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors are linked if their cosine, in double precision, is ``similar`` or more. ``n_links`` is
    the number of other ids linked directly within the component, ``component_id`` the smallest id
    reachable. Without ``passes``, a first round of passes keeps the chance of a missed pair at ``miss``
    if the hashes split the vectors evenly, and further rounds of half as many follow until one unites
    nothing more.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor
    do vectors of different dimensions. Rows with one id are one vector (the smallest in array
    order). A row without an id has no links, a null component, and is kept. Empty in, empty out.
    """
    vectors = stored(
        one_per_id(df, vec_id, vector, lambda v: finite(v) & nonzero(v)), "vectors"
    )
    classes = stored(
        vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")),
        "vector-classes",
    )
    n = classes.count()
    first = passes or passes_needed(n, similar, window, miss)
    component = stored(
        connected_components(_links(classes, n, range(first), window, similar)),
        "vector-components",
    )
    done, more = first, math.ceil(first / 2)
    while passes is None and n > window + 1:  # one window holds all pairs of fewer
        links = _links(classes, n, range(done, done + more), window, similar)
        new = stored(_apart(links, component), "vector-links")
        done += more
        if new.isEmpty():
            break
        held = component.filter("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b"))
        component = stored(connected_components(held.unionAll(new)), "vector-components")

    sizes = component.groupBy("component").agg(F.count("*").alias("size"))
    parts = F.when(F.col("size") <= tile, F.lit(1)).otherwise(
        F.ceil(F.col("size") * 2 / F.lit(tile))).cast("int")
    members = component.join(sizes, "component").withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    ).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).filter("parts = 1 OR part <> other")
    members = members.select(
        F.col("node").alias("id"), "component", "part",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        ((F.col("parts") == 1) | (F.col("other") == F.pmod(F.col("part") + 1, F.col("parts"))))
        .alias("own"),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, x in by_dimension(batch.column(1)):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array([r.tobytes() for r in unit(x)],
                                                        pa.binary()), batch.column(2).take(at)],
                    names=["id", "vector", "copies"],
                )

    units = classes.select("id", "vector", "copies").mapInArrow(
        packed, "id bigint, vector binary, copies bigint"
    )
    counts = members.join(units, "id").groupBy("component", "low", "high").applyInArrow(
        _counted(similar), "id bigint, n bigint"
    ).groupBy("id").agg(F.sum("n").alias("n"))
    classed = classes.select(F.col("id").alias("node"), "copies", "vector").join(
        counts.withColumnRenamed("id", "node"), "node", "left"
    ).join(component, "node", "left")
    named = vectors.join(classed, "vector").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    rows = df.select(col(vec_id).cast("long").alias("vec_id"))
    out = rows.join(named, rows["vec_id"] == named["id"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
