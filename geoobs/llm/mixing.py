"""Mixing sources to target weights with the cube method.

Every document of a source is taken at the source's rate: whole copies for the whole part of the
rate, and one more with the fractional part as inclusion probability. The cube method settles these
probabilities: it moves three of them at a time along the null space of the two balancing totals
(words and documents) until one reaches 0 or 1, so both totals stay as they were. Blocks of a source
settle in parallel; what two constraints leave undecided in each is settled again in larger company,
until at most two documents of a source remain. Those land on the choice nearest to the words due,
with a few others that make up for what it is off.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, col, fresh, rows_of, stored

BLOCK = 4096
# A document is large if it holds more than this part of the open words of its block.
LARGE = 64
EPS = 1e-9


def words_of(text: str) -> Column:
    """Words of a text: runs of anything but ASCII blanks. A null text has none."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(raw.split()) for raw in rows_of(batch)], type=pa.int64())

    return count(bytes_of(text))


def source_targets(
    sized: DataFrame, source: str = "source", size: str = "size", *,
    weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """Words due from each source: ``source``, ``source_size``, ``target``.

    Sources by code point, null last, take the weights in turn and share ``share`` times all words by
    them. A target stops at ``most`` times its source's size; the excess is shared again by weight.
    An empty table has no targets; a source without words has target 0.
    """
    sizes = stored(
        sized.groupBy(col(source).alias("source")).agg(F.sum(col(size)).alias("source_size")),
        "mix-sources",
    )
    # One row a source; the order only streams through the task that numbers them.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    state = stored(
        sizes.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("full", F.lit(False)),
        "mix-weights",
    )
    total = state.agg(F.sum("source_size")).first()[0] or 0
    due = min(share, most) * total
    while True:
        open_weight, held = state.agg(
            F.sum(F.when(~F.col("full"), F.col("weight"))),
            F.sum(F.when(F.col("full"), F.col("limit"))),
        ).first()
        level = (due - (held or 0.0)) / open_weight if open_weight else 0.0
        over = (~F.col("full")) & (F.col("weight") * level > F.col("limit"))
        if not open_weight or state.filter(over).isEmpty():
            break
        state = stored(state.withColumn("full", F.col("full") | over), "mix-weights")
    return state.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * level)
        .cast("double").alias("target"),
    )


def settle_large(p: np.ndarray, x: np.ndarray, chance: random.Random) -> np.ndarray:
    """Settles documents that outweigh many others while all others can still make up for them.

    The move is along the null space of all open documents that turns most on the large one.
    """
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    large = open_[x[open_] * LARGE > x[open_].sum()]
    for g in large[np.lexsort((large, -x[large]))]:
        while 0 < p[g] < 1:
            open_ = np.flatnonzero((p > 0) & (p < 1))
            if len(open_) < 4:
                return p
            totals = np.stack([np.ones(len(open_)), x[open_] / x[open_].max()])
            aim = (open_ == g).astype(float)
            move = aim - totals.T @ np.linalg.lstsq(totals @ totals.T, totals @ aim, rcond=None)[0]
            moves = np.abs(move) > EPS
            if not moves.any():
                break
            at, step = open_[moves], move[moves]
            ahead = np.where(step > 0, 1 - p[at], p[at]) / np.abs(step)
            back = np.where(step > 0, p[at], 1 - p[at]) / np.abs(step)
            ahead, back = ahead.min(), back.min()
            way = ahead if chance.random() * (ahead + back) < back else -back
            moved = p[at] + way * step
            p[at] = np.where(moved <= EPS, 0.0, np.where(moved >= 1 - EPS, 1.0, moved))
    return p


def flight(p: list[float], x: list[float], seed: int) -> list[float]:
    """Moves probabilities to 0 or 1 with sum(p) and sum(p * x) kept: large documents among all
    open ones, the others three at a time.

    Each move goes one of both ways with the chances that keep every expected value. At most two
    probabilities stay between 0 and 1.
    """
    chance = random.Random(seed)
    p = settle_large(np.array(p, dtype=float), np.array(x, dtype=float), chance).tolist()
    waiting = [i for i in range(len(p)) if 0 < p[i] < 1]
    waiting.reverse()
    held: list[int] = []
    while len(held) + len(waiting) >= 3:
        while len(held) < 3:
            held.append(waiting.pop())
        a, b, c = held
        # Orthogonal to (1, 1, 1) and to the three sizes.
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        moves = [(i, d) for i, d in zip(held, u) if d]
        ahead = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in moves)
        back = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in moves)
        step = ahead if chance.random() * (ahead + back) < back else -back
        for i, d in moves:
            moved = p[i] + step * d
            p[i] = 0.0 if moved <= EPS else 1.0 if moved >= 1 - EPS else moved
        held = [i for i in held if 0 < p[i] < 1]
    return p


def landing(p: list[float], x: list[float]) -> list[float]:
    """Settles the last open probabilities, words first.

    For each choice, settled documents that fit the words still missing or over change sides, the
    largest first. The choice that comes nearest wins, then the one with the fewest changes.
    """
    left = [i for i in range(len(p)) if 0 < p[i] < 1]
    if not left:
        return list(p)
    due = sum(p[i] * x[i] for i in left)
    others = sorted((i for i in range(len(p)) if p[i] in (0, 1) and x[i] > 0),
                    key=lambda i: (-x[i], i))
    best = None
    for pick in product((0.0, 1.0), repeat=len(left)):
        out, gap, changes = list(p), due - sum(k * x[i] for k, i in zip(pick, left)), 0
        for i, k in zip(left, pick):
            out[i] = k
        for i in others:
            if x[i] <= (gap if p[i] == 0 else -gap):
                out[i] = 1.0 - p[i]
                gap -= x[i] if p[i] == 0 else -x[i]
                changes += 1
        if best is None or (abs(gap), changes) < best[:2]:
            best = (abs(gap), changes, out)
    return best[2]


def _settle(last: bool):
    def settle(rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["open", "_s", "block"]).sort_by(
            [("unit", "ascending"), ("size", "ascending")]
        )
        p, x = rows["p"].to_pylist(), [float(n) for n in rows["size"].to_pylist()]
        p = flight(p, x, rows["unit"][0].as_py())
        p = landing(p, x) if last else p
        return rows.set_column(rows.column_names.index("p"), "p", pa.array(p, pa.float64()))

    return settle


def cube_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """Decides every row of ``units`` (``source``, ``unit``, ``size``, ``p`` and any others): ``p``
    becomes 0 or 1.

    Rows are dealt and ordered by ``unit``, a hash, so reruns agree. Sums of ``p`` and ``p * size`` of
    a source are kept but for a landing of a few rows.
    """
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    state, done = units.filter(fractional), units.filter(~fractional)
    while True:
        counts = stored(state.groupBy("source").agg(F.count("*").alias("open")), "mix-open")
        most = counts.agg(F.max("open")).first()[0]
        if most is None:
            return done
        last = most <= block
        # A source is dealt into blocks by its number of open rows.
        sized = state.join(
            counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
        ).withColumn("block", F.pmod(F.xxhash64(F.lit(most), "unit"),
                                     F.ceil(F.col("open") / F.lit(block))))

        settled = stored(
            sized.groupBy("source", "block").applyInArrow(_settle(last), state.schema), "mix-settled"
        )
        done = done.unionByName(settled.filter(~fractional))
        state = settled.filter(fractional)


def mix(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *,
    weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    block: int = BLOCK,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns for every row ``doc_id``, ``source``, ``text_hash``, ``size`` (words), ``source_size``,
    ``target`` and ``copies``; it takes ``copies * size`` words of the row. Copies lie between the
    whole numbers around target / source size, so no document exceeds ``most`` times its size.

    A null text has size 0. A null source is a source of its own, last in order. Rows equal in id,
    source and text are one unit with their number as multiplicity; its copies are spread evenly over
    them. A null id is an id like any other. Empty in, empty out. Reruns agree.

    The words of a source come near its target unless one document outweighs the others of its block
    of ``block`` documents; then they are off by what those cannot make up for.
    """
    rows = df.select(
        col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"),
        F.xxhash64(bytes_of(text)).alias("text_hash"), words_of(text).alias("size"),
    )
    units = stored(
        rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("rows")),
        "mix-units",
    )
    targets = source_targets(
        units.withColumn("words", F.col("size") * F.col("rows")), "source", "words",
        weights=weights, share=share, most=most,
    )
    targets = stored(targets, "mix-targets").select(
        F.col("source").alias("_s"), "source_size", "target"
    )
    rated = units.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    due = F.when(
        F.col("source_size") > 0, F.col("rows") * F.col("target") / F.col("source_size")
    ).otherwise(F.lit(0.0))
    # A rate that is whole but for rounding errors is whole.
    due = F.when(F.abs(due - F.round(due)) < EPS, F.round(due)).otherwise(due)
    rated = rated.withColumn("due", due).withColumn("whole", F.floor("due").cast("long"))
    rated = stored(
        rated.withColumn("unit", F.xxhash64("doc_id", "source", "text_hash"))
        .withColumn("p", F.col("due") - F.col("whole")).drop("due"),
        "mix-rated",
    )
    taken = cube_sample(rated, block).withColumn(
        "total", F.col("whole") + F.col("p").cast("long")
    )
    each = taken.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    extra = F.when(F.col("nth") <= F.col("total") % F.col("rows"), 1).otherwise(0)
    return each.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.floor(F.col("total") / F.col("rows")) + extra).cast("long").alias("copies"),
    )


def apply_mix(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    **options,
) -> DataFrame:
    """``df`` as the mix takes it: every row as often as its copies say, with all its columns."""
    copies = mix(df, doc_id, text, source, **options).groupBy(
        "doc_id", "source", "text_hash"
    ).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    names = fresh(df, "doc", "src", "hash", "copies", "rows", "key", "nth", "same")
    doc, src, hashed, n, rows, key, nth, same = names
    copies = copies.filter(F.col("copies") > 0).select(
        F.xxhash64("doc_id", "source", "text_hash").alias(key), F.col("doc_id").alias(doc),
        F.col("source").alias(src), F.col("text_hash").alias(hashed),
        F.col("copies").alias(n), F.col("rows").alias(rows),
    )
    text_hash = F.xxhash64(bytes_of(text))
    keyed = df.withColumn(key, F.xxhash64(col(doc_id), col(source).cast("string"), text_hash))
    met = keyed.join(copies, key).filter(
        col(doc_id).eqNullSafe(col(doc)) & col(source).cast("string").eqNullSafe(col(src))
        & (text_hash == col(hashed))
    )
    # Rows equal in id, source and text share their copies. They are counted first, so a row that
    # occurs very often is one row here; variants in other columns take their part one after another.
    shared = met.filter(col(rows) > 1).groupBy(*met.columns).agg(F.count("*").alias(same))
    before = Window.partitionBy(key, doc, src, hashed).orderBy(
        *[col(c) for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    ).rowsBetween(Window.unboundedPreceding, -1)
    past = F.coalesce(F.sum(col(same)).over(before), F.lit(0))
    over = F.least(F.greatest(col(n) % col(rows) - col(nth), F.lit(0)), col(same))
    spread = shared.withColumn(nth, past).withColumn(
        n, (F.floor(col(n) / col(rows)) * col(same) + over).cast("long")
    ).filter(col(n) > 0)
    keep = [col(c) for c in (*df.columns, n)]
    both = met.filter(col(rows) == 1).select(*keep).unionAll(spread.select(*keep))
    return both.withColumn(
        nth, F.explode(F.sequence(F.lit(1).cast("long"), col(n)))
    ).select(*[col(c) for c in df.columns])
