"""A Merkle manifest of a table: one root for all rows, and a proof for each.

Rows are leaves; within a group they are ordered, and every two nodes that
follow each other become their hash, until one is left; the groups' roots are
hashed together in the same way. The leaves of a group are numbered by one
range-partitioned sort and cut into aligned blocks. A block keeps a level of its
subtree as one string of hexadecimal text, in which the nodes stand at fixed
places: two of them side by side are the text of their parent, and the
substring beside a node is its sibling. The roots of the blocks are the leaves
of the next round.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.sources import materialize, scratch

# Leaves of a block, a power of two.
BLOCK = 1024
# Fixed value: characters of a node.
NODE = 64
STEP = "struct<left:string,right:string>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(cells: Sequence[Column]) -> Column:
    """The hash of the cells' texts, each behind its length in bytes; ``-`` stands for NULL."""
    texts = [cell.cast("string") for cell in cells]
    return hashed(
        *[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: hashed(step["left"], node, step["right"]))


def siblings(proof: Column) -> Column:
    """The nodes of a proof as one text, from the leaf up, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    changed: Mapping[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``(order, group, leaf, changed_leaf, subroot, root, proof)`` for every row.

    ``columns`` are what a leaf covers, in that order. Groups are ordered by
    their name's bytes, NULL first; NULL is a group of its own. Within a group
    rows are ordered by ``order``, NULL first; rows that share it are ordered by
    their leaves, so equal rows have proofs of neighbouring places. ``proof`` is
    a list of ``(left, right)`` from the leaf to the root; both are empty where
    a node is the last of an odd number. ``changed_leaf`` is the leaf of the row
    with other cells, as ``changed`` names them: folding it must miss the root.
    A group of one row has its leaf for a subroot, a table of one group its
    subroot for a root; an empty table gives no rows. Other columns are not
    read. ``docs`` is read once.
    """
    cells = {name: named(name).cast("string") for name in columns}
    others = {name: cell.cast("string") for name, cell in (changed or {}).items()}
    same = reduce(and_, [cells[name].eqNullSafe(cell) for name, cell in others.items()], F.lit(True))
    node = leaf_of(list(cells.values()))
    leaves = docs.select(
        _group_key(named(group)).alias("group"),
        named(order).alias("order"),
        node.alias("node"),
        F.when(same, node).otherwise(leaf_of(list((cells | others).values()))).alias("other"),
    )
    with scratch(docs.sparkSession):
        placed = _placed(materialize(leaves), ["order", "node", "other"])
        nodes = placed.select("group", "place", "node", F.struct("order", "other").alias("own"))
        blocks = _blocks(nodes, block)
    found = _climb(blocks, block, lambda tops: _over_groups(tops, block))
    return found.select(
        F.col("own.order").alias(order),
        F.when(F.col("group") != "", F.substr("group", F.lit(2))).alias(group),
        F.col("node").alias("leaf"),
        F.col("own.other").alias("changed_leaf"),
        "subroot",
        "root",
        "proof",
    )


def _group_key(name: Column) -> Column:
    """A text that is never NULL and sorts as the names do, NULL first."""
    return F.coalesce(F.concat(F.lit("+"), name.cast("string")), F.lit(""))


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with each one's ``place`` in its group, from 0.

    One sort over ranges of (group, order), so a large group lies in many
    tasks, as do rows that are equal. A place is the number in the task plus the group's rows in earlier
    tasks, of which there is one count a task and group.
    """
    by = ["group", *order, "row"]
    nodes = nodes.withColumn("row", F.monotonically_increasing_id())
    ordered = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    ordered = materialize(ordered.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    parts = ordered.groupBy("group", part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = materialize(starts.select("group", "part", (F.col("before") - F.col("first")).alias("shift")))
    found = ordered.withColumn("part", part).join(starts, ["group", "part"])
    return found.withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift", "row")


def _over_groups(tops: DataFrame, block: int) -> DataFrame:
    """The tree over the groups' roots; ``(group, place, subroot, root, proof)``, all at place 0."""
    names = tops.select(F.lit("").alias("group"), F.col("group").alias("name"), "node")
    with scratch(tops.sparkSession):
        placed = _placed(names, ["name"])
        blocks = _blocks(placed.select("group", "place", "node", F.struct("name").alias("own")), block)
    found = _climb(blocks, block, _no_more)
    return found.select(
        F.col("own.name").alias("group"),
        F.lit(0).cast("long").alias("place"),
        F.col("node").alias("subroot"),
        "root",
        "proof",
    )


def _no_more(tops: DataFrame) -> DataFrame:
    return tops.select(
        "group",
        "place",
        F.col("node").alias("subroot"),
        F.col("node").alias("root"),
        F.array().cast(f"array<{STEP}>").alias("proof"),
    )


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    """``(group, place, members)``, stored: the nodes of each aligned block in order."""
    member = F.struct(F.col("place").alias("place"), F.col("node").alias("node"), F.col("own").alias("own"))
    number = F.floor(F.col("place") / block).cast("long").alias("place")
    blocks = nodes.groupBy("group", number).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return materialize(blocks, keep=True)


def _climb(blocks: DataFrame, block: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(own, group, node, subroot, root, proof)`` of the nodes in blocks.

    A round hashes every block to one node, which is a leaf of the next round.
    When each group has a single node, ``above`` goes on from there.
    """
    levels, names = _levels(blocks, block)
    last = F.coalesce(*[F.col(n) for n in reversed(names)]).cast("string")
    tops = materialize(levels.select("group", "place", last.alias("node")), keep=True)
    if tops.filter("place > 0").isEmpty():
        upper = above(tops)
    else:
        upper = _climb(_blocks(tops.withColumn("own", F.col("place")), block), block, above)
        upper = upper.select("group", F.col("own").alias("place"), "subroot", "root", "proof")
    rows = F.transform(
        "members",
        lambda m, j: F.struct(
            m["own"].alias("own"),
            F.col("group").alias("group"),
            m["node"].alias("node"),
            F.col("subroot").alias("subroot"),
            F.col("root").alias("root"),
            F.concat(_steps(names, j), F.col("proof")).alias("proof"),
        ),
    )
    return levels.join(upper, ["group", "place"]).select(F.inline(rows))


def _levels(blocks: DataFrame, block: int) -> tuple[DataFrame, list[str]]:
    """``blocks`` with the levels of each block's subtree, and their names from the leaves up.

    A level is the nodes' text, as bytes so that a substring is found without
    counting characters. A block that is the only one of its group ends at the
    level with one node, higher levels are NULL; any other is hashed to the full height.
    """
    only = (F.col("place") == 0) & (F.size("members") < block)
    text = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    names = [f"level_{k}" for k in range(block.bit_length())]
    blocks = blocks.withColumn(names[0], text)
    for below, name in zip(names, names[1:]):
        size = F.octet_length(below)
        runs = F.sequence(F.lit(0), F.floor((size - 1) / (2 * NODE)).cast("int"))
        parents = F.transform(
            runs, lambda i: F.sha2(F.substr(below, i * (2 * NODE) + 1, F.lit(2 * NODE)), 256)
        )
        more = ~only | (size > NODE)
        blocks = blocks.withColumn(name, F.when(more, F.array_join(parents, "").cast("binary")))
    return blocks, names


def _steps(names: Sequence[str], place: Column) -> Column:
    """The siblings of the node at that place of its block, level by level."""
    steps = []
    for k, (level, parent) in enumerate(zip(names, names[1:])):
        i = F.shiftright(place, k)
        odd = i % 2 == 1
        beside = F.substr(F.col(level), NODE * F.when(odd, i - 1).otherwise(i + 1) + 1, F.lit(NODE)).cast("string")
        step = F.struct(
            F.when(odd, beside).otherwise("").alias("left"), F.when(odd, "").otherwise(beside).alias("right")
        )
        steps.append(F.when(F.col(parent).isNotNull(), step))
    return F.filter(F.array(*steps), lambda s: s.isNotNull()).cast(f"array<{STEP}>")
