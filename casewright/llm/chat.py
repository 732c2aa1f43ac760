"""Chat formatting of reply trees.

A message points at the message it answers. Iterative self-joins with doubling jumps enumerate every root-to-leaf
path: after round k a leaf knows its nearest 2^k ancestors, so the rounds are logarithmic in the depth. Branches of a
tree are ranked by score, and each chosen path becomes one conversation. All of it is DataFrame functions.

The template wraps a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash goes between
``<`` and ``|`` (after those already there), so no text can hold a control string, and taking one out again gives
the text back. In a role, backslash and line feed are written ``\\\\`` and ``\\n``.

Defined results: a null text or role counts as empty; rows of equal turn follow each other by role, then text, a null
turn comes first; a null conversation id is a conversation of its own; an empty table gives only what is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.shared import cut_lineage

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    plain = F.coalesce(role, F.lit(""))
    return escaped(F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    # a doubled backslash is set aside while the line feeds are read back
    parts = F.split(unescaped(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def paths(nodes: DataFrame) -> DataFrame:
    """Every (tree, leaf, node, distance from the leaf) of ``nodes (tree, node long, parent long)``.

    ``jump`` takes a node to its ancestor 2^k above; ``reached`` has a leaf's ancestors nearer than 2^k. One round
    joins both with ``jump``. A parent that is not in its tree ends the path, as null does.
    """
    known = nodes.select("tree", F.col("node").alias("up"))
    jump = nodes.select("tree", "node", F.col("parent").alias("up")).where("up is not null")
    jump = cut_lineage(_same(jump, known, "up").select("tree", "node", "up"))
    answered = jump.select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.select("tree", "node").alias("l").join(answered.alias("r"), F.col("l.tree").eqNullSafe(F.col("r.tree")) & (F.col("l.node") == F.col("r.node")), "left_anti")
    reached = cut_lineage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("distance")))
    step = 1
    while not jump.isEmpty():
        above = _same(reached, jump.withColumnRenamed("node", "at"), "node", "at")
        above = above.select("tree", "leaf", F.col("up").alias("node"), (F.col("distance") + step).alias("distance"))
        reached = cut_lineage(reached.unionByName(above))
        twice = _same(jump, jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top")), "up")
        jump = cut_lineage(twice.select("tree", "node", F.col("top").alias("up")))
        step *= 2
    return reached


def _same(left: DataFrame, right: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """Inner join on ``key`` within the same tree, where a null tree equals a null tree."""
    r = right.select(*(F.col(c).alias(f"_{c}") if c in ("tree", other or key) else F.col(c) for c in right.columns))
    return left.join(r, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col(key) == F.col(f"_{other or key}")))


def conversations(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """One formatted conversation for each chosen branch of ``nodes (tree, node, parent, score, role, text)``.

    A branch is a root-to-leaf path; its score is the sum of its nodes' scores. ``rank`` counts the branches of a tree
    from 1, by score, then leaf; ``branches`` keeps the best so many (None: all). Returned are tree, leaf, rank, turns
    (long), formatted (string) and mask: the code-point spans of ``formatted`` that bear loss, which are the assistant's
    texts without their control strings.
    """
    if "score" not in nodes.columns:
        nodes = nodes.withColumn("score", F.lit(0.0))
    walk = _same(paths(nodes), nodes.select("tree", F.col("node").alias("at"), "score", "role", "text"), "node", "at").select("tree", "leaf", "distance", "score", "role", "text")
    role, text = escaped_role(F.col("role")), escaped(F.col("text"))
    head, tail = F.concat(F.lit(START), role, F.lit("\n")), F.lit(f"{END}\n")
    walk = walk.select("tree", "leaf", "distance", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), (F.col("role") == "assistant").alias("loss"), F.length(head).alias("head"), F.length(text).alias("n"), F.concat(head, text, tail).alias("piece"))
    line = Window.partitionBy("tree", "leaf").orderBy(F.col("distance").desc())
    walk = walk.withColumn("begin", F.sum(F.length("piece").cast("bigint")).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("piece") + F.col("head"))
    turn = F.struct((-F.col("distance")).alias("order"), "piece", F.when(F.col("loss"), F.struct(F.col("begin").alias("start"), (F.col("begin") + F.col("n")).alias("end"))).alias("span"))
    built = walk.groupBy("tree", "leaf").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_list(turn)).alias("t"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf"))
    mask = F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull())
    out = built.select("tree", "leaf", rank.alias("rank"), "turns", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), mask.alias("mask"))
    return out if branches is None else out.where(F.col("rank") <= branches)


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>", -1), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|im_start\|>", -1)) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        rest = F.substring(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END) - 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(rest).alias("text"))

    return F.transform(pieces, turn)


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts that bear loss, unescaped, in order."""
    return F.transform(mask, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def as_chains(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees without branches: each row answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    at = F.row_number().over(order).cast("bigint")
    return turns.select(F.col("conv_id").alias("tree"), at.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
