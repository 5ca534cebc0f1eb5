"""Chat formatting over reply trees, in DataFrame operations only.

Self-joins double the reach of every message's parent pointer, so root, depth and branch score of a
message at depth d are known after log2(d) joins. Leaves are ranked within their tree; the paths of
the chosen ones are laid out by the same doubled pointers and formatted as one conversation each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, stored

# The template. A control string is "<|", a name and "|>"; texts never hold "<|" without a further
# "|" after it, so none of theirs is read as control.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    """Doubles the bar of every ``<|``; ``unescape`` undoes exactly that."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def turns_as_messages(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Messages of linear conversations: each turn replies to the one before it.

    Rows are ordered by turn (null first), ties by role and text; repeated rows stay, each as a turn
    of its own. Message ids are (conversation, position). Null roles and texts become empty.
    """
    rows = df.select(
        col(conv_id).alias("conv_id"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("position", F.row_number().over(order))
    return rows.select(
        F.struct("conv_id", "position").alias("msg_id"),
        F.when(F.col("position") > 1, F.struct("conv_id", (F.col("position") - 1)
                                               .alias("position"))).alias("parent_id"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def _reach(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers ``node -> up`` of 1, 2, 4, ... steps, and root, depth and score sum of each message."""
    known = messages.select(F.col("msg_id").alias("up"))
    links = messages.select("msg_id", "parent_id", "score").join(
        known, F.col("parent_id") == F.col("up"), "left"
    )
    # A parent that is not there makes a root.
    state = stored(
        links.select(
            F.col("msg_id").alias("node"), "up",
            F.col("msg_id").alias("top"), F.lit(1).alias("depth"), "score",
        ),
        "reply-links",
    )
    levels = []
    # After log2(messages) doublings every path has ended; what still points up lies on a cycle.
    for k in range(max(1, math.ceil(math.log2(max(2, messages.count())))) + 1):
        if state.filter("up IS NOT NULL").isEmpty():
            break
        levels.append(state.filter("up IS NOT NULL").select("node", "up"))
        above = state.select(
            F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("top").alias("_top"),
            F.col("depth").alias("_depth"), F.col("score").alias("_score"),
        )
        # Only messages whose path goes on take part; short trees are done after a few rounds.
        joined = state.filter("up IS NOT NULL").join(above, F.col("up") == F.col("_node"))
        further = joined.select(
            "node", F.col("_up").alias("up"), F.col("_top").alias("top"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("score") + F.col("_score")).alias("score"),
        )
        state = stored(
            state.filter("up IS NULL").unionByName(further), f"reply-reach-{k}"
        )
    return levels, state.filter("up IS NULL")


def branches(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Every root-to-leaf branch: ``root_id``, ``leaf_id``, ``depth``, ``branch_score`` (mean score of
    its messages) and ``branch_rank`` in its tree (highest score first, ties to the longer branch,
    then to the smaller leaf id); and the pointer levels that lay out its path."""
    levels, reach = _reach(messages)
    inner = messages.select(F.col("parent_id").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = reach.join(inner, "node", "left_anti").select(
        F.col("top").alias("root_id"), F.col("node").alias("leaf_id"), "depth",
        (F.col("score") / F.col("depth")).alias("branch_score"),
    )
    best = Window.partitionBy("root_id").orderBy(
        F.desc("branch_score"), F.desc("depth"), "leaf_id"
    )
    return levels, leaves.withColumn("branch_rank", F.row_number().over(best))


def format_branches(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """One row for each of the ``top`` best branches of every tree (None: all branches).

    ``messages`` has ``msg_id``, ``parent_id``, ``role``, ``text`` and ``score`` (null: 0). Returns
    ``root_id``, ``leaf_id``, ``branch_rank``, ``branch_score``, ``n_turns``, ``formatted`` and
    ``loss_spans``: start and end, in code points of ``formatted``, of every assistant text.

    Null roles and texts are empty. A message without an id takes no part; of rows with one id the
    smallest (parent, role, text, score) is used. A parent that does not exist makes a root. Messages
    on a cycle of parents, or below one, have no root and are in no branch. Empty in, empty out.
    """
    clean = messages.filter(F.col("msg_id").isNotNull()).select(
        "msg_id", "parent_id",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    clean = stored(
        clean.groupBy("msg_id").agg(F.min(F.struct("parent_id", "role", "text", "score"))
                                    .alias("m")).select("msg_id", "m.*"),
        "reply-messages",
    )
    levels, chosen = branches(clean)
    if top is not None:
        chosen = chosen.filter(F.col("branch_rank") <= top)
    chosen = stored(chosen, "reply-branches")
    path = chosen.select(
        "leaf_id", F.col("leaf_id").alias("node"), F.lit(0).alias("back"), "depth"
    )
    for k, level in enumerate(levels):
        # Paths shorter than the reach of the level are complete.
        further = path.filter(F.col("depth") > (1 << k)).join(level, "node").select(
            "leaf_id", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"), "depth"
        )
        path = stored(path.unionByName(further), f"reply-path-{k}")
    turns = path.join(
        clean.select(F.col("msg_id").alias("node"), "role", "text"), "node"
    ).select("leaf_id", "back", "role", "text")
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    turns = turns.select(
        "leaf_id", "back", F.col("role").eqNullSafe("assistant").alias("loss"),
        F.length(head).alias("head"), F.length(escape(F.col("text"))).alias("body"),
        F.concat(head, escape(F.col("text")), F.lit(END + "\n")).alias("piece"),
    )
    order = Window.partitionBy("leaf_id").orderBy(F.desc("back"))
    before = F.sum(F.length("piece")).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = turns.withColumn(
        "start", F.coalesce(before, F.lit(0)).cast("int") + F.col("head")
    )
    whole = placed.groupBy("leaf_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda t: t["piece"]
            ), "",
        ).alias("formatted"),
        F.array_sort(F.collect_list(F.when(
            F.col("loss"), F.struct("start", (F.col("start") + F.col("body")).alias("end"))
        ))).alias("loss_spans"),
    )
    return chosen.join(whole, "leaf_id").select(
        "root_id", "leaf_id", "branch_rank", "branch_score", "n_turns", "formatted", "loss_spans"
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, as they were before escaping."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(p: Column) -> Column:
        line = F.locate("\n", p)
        length = F.length(p) - line - len(END + "\n")
        return F.struct(
            _unescape_role(F.substring(p, F.lit(1), line - 1)).alias("role"),
            unescape(F.substring(p, line + 1, length)).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    parts = F.transform(
        spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    )
    return F.array_join(parts, "")
