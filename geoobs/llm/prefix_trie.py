"""Prefix tries of rebuilt conversations, from fingerprints that compose.

A conversation is rebuilt from the first turns of a base conversation and its own turns after as many.
The fingerprint of a run of turns is a pair (value, length), a monoid under
``(v, m) * (w, n) = (v * B**n + w, m + n)`` modulo a prime of 127 bits. Prefix products are taken once
for the conversations as given; the fingerprint of every prefix of a rebuilt one follows from three of
them, that of the base's head, of its own part left out and of its own prefix. No rebuilt text or list
of turns is ever made; what stands for a turn is the place where it is stored.

Prefixes of equal fingerprint are one node. Its members' last turns, read through those places, must
have one digest; the parent's fingerprint follows from a node's and that digest, so by induction equal
fingerprints are equal sequences. Sums over subtrees come from pointers that double their reach.

Turns of one conversation may lie in any number of tasks: each range of the ordered turns multiplies
its own, and a conversation that crosses ranges is put together from one product for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from .common import col, stored

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix fingerprints").digest()[:15], "big") | 1
BACK = pow(BASE, -1, PRIME)
# Ids in one piece of a node's list of ends.
PIECE = 1 << 14


def _value(raw: bytes | None) -> int:
    return int.from_bytes(raw, "big") if raw else 0


def _raw(value: int) -> bytes:
    return (value % PRIME).to_bytes(16, "big")


@lru_cache(maxsize=1 << 16)
def _power(n: int) -> int:
    return pow(BASE, n, PRIME)


def _products(rows: DataFrame) -> DataFrame:
    """Ordered turns with their place in their range of the order and the product up to there."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        conv = value = place = None
        for batch in batches:
            values, places = [], []
            for c, digest in zip(batch["conv"].to_pylist(), batch["digest"].to_pylist()):
                if c != conv or place is None:
                    conv, value, place = c, 0, 0
                value, place = (value * BASE + _value(digest)) % PRIME, place + 1
                values.append(_raw(value))
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [batch["conv"], pa.array([task] * len(places), pa.int32()),
                 pa.array(places, pa.int64()), pa.array(values, pa.binary()), batch["digest"],
                 batch["n_bytes"]],
                names=["conv", "task", "place", "value", "digest", "n_bytes"],
            )

    kind = dict(rows.dtypes)["conv"]
    return rows.mapInArrow(
        multiply, f"conv {kind}, task int, place bigint, value binary, digest binary, n_bytes bigint"
    )


_CARRIES = ArrayType(StructType().add("task", IntegerType()).add("offset", LongType())
                     .add("carry", BinaryType()))


@F.arrow_udf(_CARRIES)
def _carried(parts: pa.Array) -> pa.Array:
    """For each range that a conversation crosses, the turns and the product before it."""
    out = []
    for row in parts.to_pylist():
        value, offset, mine = 0, 0, []
        for part in sorted(row, key=lambda p: p["task"]):
            mine.append({"task": part["task"], "offset": offset, "carry": _raw(value)})
            value = value * _power(part["n"]) + _value(part["value"])
            value, offset = value % PRIME, offset + part["n"]
        out.append(mine)
    kind = pa.struct([("task", pa.int32()), ("offset", pa.int64()), ("carry", pa.binary())])
    return pa.array(out, pa.list_(kind))


@F.arrow_udf(BinaryType())
def _joined(left: pa.Array, right: pa.Array, length: pa.Array) -> pa.Array:
    """Product of two runs, the second one with its length; a null first one changes nothing."""
    rows = zip(left.to_pylist(), right.to_pylist(), length.to_pylist())
    return pa.array(
        [b if a is None else _raw(_value(a) * _power(n) + _value(b)) for a, b, n in rows],
        pa.binary(),
    )


@F.arrow_udf(BinaryType())
def _rebased(prefix: pa.Array, left_out: pa.Array, head: pa.Array, length: pa.Array) -> pa.Array:
    """``prefix`` with the run at its start that is ``left_out`` replaced by ``head``; ``length`` turns
    of it stay."""
    rows = zip(prefix.to_pylist(), left_out.to_pylist(), head.to_pylist(), length.to_pylist())
    return pa.array(
        [_raw(_value(p) + (_value(h) - _value(o)) * _power(n)) for p, o, h, n in rows], pa.binary()
    )


@F.arrow_udf(BinaryType())
def _shortened(value: pa.Array, digest: pa.Array) -> pa.Array:
    """The product without its last turn."""
    rows = zip(value.to_pylist(), digest.to_pylist())
    return pa.array([_raw((_value(v) - _value(x)) * BACK) for v, x in rows], pa.binary())


def _node(depth: Column, value: Column) -> Column:
    return F.concat(F.unhex(F.lpad(F.hex(depth.cast("long")), 16, "0")), value)


ROOT = bytes(24)


def _turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns as given: position in the conversation, product up to there, digest and bytes."""
    rows = df.select(
        col(conv_id).alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL")
    # The sample that the ranges are taken from holds no long strings.
    ordered = rows.withColumn("digest", F.unhex(F.sha2(
        F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256
    ))).withColumn("n_bytes", F.octet_length("text").cast("long"))
    ordered = ordered.repartitionByRange("conv", "turn", F.substring("role", 1, 64))
    ordered = ordered.sortWithinPartitions("conv", "turn", "role", "text")
    local = stored(_products(ordered.select("conv", "digest", "n_bytes")), "trie-products")
    parts = local.groupBy("conv", "task").agg(
        F.max("place").alias("n"), F.max_by("value", "place").alias("value")
    )
    # At most one entry for each range of the order.
    crossing = parts.groupBy("conv").agg(
        F.collect_list(F.struct("task", "n", "value")).alias("parts")
    ).filter(F.size("parts") > 1)
    carries = crossing.select("conv", F.explode(_carried("parts")).alias("c")).select(
        F.col("conv").alias("_conv"), F.col("c.task").alias("_task"), "c.offset", "c.carry"
    )
    whole = local.join(
        carries, (F.col("conv") == F.col("_conv")) & (F.col("task") == F.col("_task")), "left"
    )
    return stored(whole.select(
        "conv", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("position"),
        _joined("carry", "value", "place").alias("value"), "digest", "n_bytes",
    ), "trie-turns")


def _prefixes(turns: DataFrame, base: Column, head: Column, most_head: int) -> DataFrame:
    """Every prefix of every rebuilt conversation: ``node``, its last turn and where that is stored."""
    heads = turns.groupBy("conv").agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.when(
            F.col("position") <= most_head, F.struct("position", "value", "digest", "n_bytes")
        ))).alias("head"),
    )
    heads = stored(heads, "trie-heads")
    bases = heads.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    given = heads.select("conv", "n", "head", base.alias("_base"), head.cast("int").alias("h"))
    given = given.join(bases, F.col("_base") == F.col("base"), "left")
    # The first h turns of the base, all of them if it has fewer, none if it is not there.
    lent = F.when(F.col("h") > 0, F.slice(
        F.coalesce("base_head", F.slice("head", 1, 0)), F.lit(1), F.greatest("h", F.lit(1))
    )).otherwise(F.slice("head", 1, 0))
    at = lambda parts, i: F.when(i > 0, F.try_element_at(parts, i)["value"])
    plan = given.withColumn("lent", lent).select(
        "conv", "h", "lent", F.size("lent").alias("n_lent"),
        at(F.col("lent"), F.size("lent")).alias("lent_value"),
        at(F.col("head"), F.col("h")).alias("left_out"), F.col("_base").alias("base"),
        (F.size("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"),
    )
    plan = stored(plan, "trie-plans")
    lent = plan.select("conv", "base", "total", F.explode("lent").alias("t")).select(
        "conv", F.col("t.position").alias("depth"), "t.value", "t.digest", "t.n_bytes", "total",
        F.col("base").alias("stored_conv"), F.col("t.position").alias("stored_position"),
    )
    own = turns.join(plan.withColumnRenamed("conv", "_conv"), F.col("conv") == F.col("_conv"))
    own = own.filter("position > h").withColumn("kept", F.col("position") - F.col("h"))
    own = own.select(
        "conv", (F.col("n_lent") + F.col("kept")).alias("depth"),
        _rebased("value", "left_out", "lent_value", "kept").alias("value"), "digest", "n_bytes",
        "total", F.col("conv").alias("stored_conv"), F.col("position").alias("stored_position"),
    )
    empty = plan.filter("total = 0").select(F.col("conv").alias("end_conv"), F.lit(ROOT).alias("end_node"))
    rows = lent.unionByName(own).withColumn("node", _node(F.col("depth"), F.col("value")))
    return stored(rows, "trie-prefixes"), stored(
        plan.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")), "trie-root"
    ), empty


def _ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the sorted, comma-joined ids of each ``end_node``.

    Pieces of the list are written by ranges of (node, id); the digest, which no two tasks can share,
    then only reads a node's pieces in order.
    """
    ordered = ends.repartitionByRange("end_node", "end_conv")
    ordered = ordered.sortWithinPartitions("end_node", "end_conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, at = [], 0
            ids = batch["end_conv"].to_pylist()
            for node, same in groupby(batch["end_node"].to_pylist()):
                end = at + sum(1 for _ in same)
                for a in range(at, end, PIECE):
                    out.append((node, ids[a], ",".join(map(str, ids[a:min(end, a + PIECE)]))))
                at = end
            kinds = pa.binary(), batch["end_conv"].type, pa.string()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                names=["end_node", "first", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()),
                 pa.array([f[1] for f in found], pa.string())], names=["end_node", "ends_sha256"])

        for batch in batches:
            found = []
            for key, ids in zip(batch["end_node"].to_pylist(), batch["ids"].to_pylist()):
                if key == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        found.append((node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield rows(found)
        if node is not None:
            yield rows([(node, digest.hexdigest())])

    kind = dict(ends.dtypes)["end_conv"]
    cut = ordered.select("end_node", "end_conv").mapInArrow(
        pieces, f"end_node binary, first {kind}, ids string"
    )
    cut = stored(cut, "trie-ends")
    return cut.repartition("end_node").sortWithinPartitions("end_node", "first").select(
        "end_node", "ids").mapInArrow(digests, "end_node binary, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``node``, ``n_leaves`` and ``saved_tokens`` of whole subtrees.

    After round k a node's sums cover what lies fewer than 2**k levels below it, and it points 2**k
    levels up; nodes whose pointer has left the tree only wait for sums.
    """
    state = nodes.select("node", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    k = 0
    while not state.filter("up IS NOT NULL").isEmpty():
        climbing = state.filter("up IS NOT NULL")
        gained = climbing.groupBy(F.col("up").alias("_node")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        above = climbing.select(F.col("node").alias("_at"), F.col("up").alias("_up"))
        state = state.join(gained, F.col("node") == F.col("_node"), "left").join(
            above, F.col("up") == F.col("_at"), "left"
        ).select(
            "node", F.col("_up").alias("up"),
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
        )
        state, k = stored(state, f"trie-sums-{k}"), k + 1
    return state.select("node", "n_leaves", "saved_tokens")


def prefix_trie(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", *, base: Column, head: Column, most_head: int,
) -> DataFrame:
    """One row for each node of the trie of all rebuilt conversations.

    ``base`` and ``head`` are expressions of ``conv``, a conversation's id: the conversation whose
    first ``head`` turns it starts with (all if that has fewer, none if it is not there), before its
    own turns after its first ``head``. ``head`` is at most ``most_head``.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated rows are turns of their
    own. Null roles and texts are empty, rows without a conversation id take no part, and columns
    other than the four are not read. An empty table has no node, any other a root of depth 0.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` over the subtree, ``ends_sha256`` of the members that end there,
    and ``stored_conv`` and ``stored_position``, where the node's last turn is stored.
    """
    turns = _turns(df, conv_id, turn, role, text)
    prefixes, root, empty = _prefixes(turns, base, head, most_head)
    found = prefixes.groupBy("node", "depth").agg(
        F.min("value").alias("value"), F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"),
        F.min("digest").alias("digest"), F.max("digest").alias("_digest"),
        F.max("n_bytes").alias("n_bytes"),
        F.min(F.struct("stored_conv", "stored_position")).alias("at"),
    )
    same = F.when(F.col("digest") == F.col("_digest"), F.col("digest")).otherwise(
        F.raise_error(F.lit("different turns have one fingerprint")).cast("binary")
    )
    found = found.select(
        "node", "depth", _node(F.col("depth") - 1, _shortened("value", same)).alias("parent"),
        "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
        "at.stored_conv", "at.stored_position",
    )
    top = root.filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("binary").alias("parent"), "conv_id", "n_convs",
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.lit(None).cast(dict(found.dtypes)["stored_conv"]).alias("stored_conv"),
        F.lit(None).cast("bigint").alias("stored_position"),
    )
    found = stored(found.unionByName(top), "trie-nodes")
    children = found.groupBy(F.col("parent").alias("_node")).agg(F.count("*").alias("n_children"))
    found = found.join(children, F.col("node") == F.col("_node"), "left").drop("_node").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))
    ).withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
    found = stored(found, "trie-children")
    sums = _subtree_sums(found).withColumnRenamed("node", "_node")
    ends = prefixes.filter("depth = total").select(
        F.col("conv").alias("end_conv"), F.col("node").alias("end_node")
    ).unionByName(empty)
    parents = found.select(F.col("node").alias("_up"), F.col("conv_id").alias("parent_conv_id"))
    done = found.drop("n_leaves", "saved_tokens").join(
        sums, F.col("node") == F.col("_node")
    ).join(_ends(ends), F.col("node") == F.col("end_node"), "left").join(
        parents, F.col("parent") == F.col("_up"), "left"
    )
    return done.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "stored_conv", "stored_position",
    )
