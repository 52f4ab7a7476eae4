"""Merkle manifest of a table by slot pivots: leaves, roots of groups, the root of all, proofs and their verification.

Every row is a leaf, the hash of its columns. In each group (a value of `group`, null too) leaves stand in ascending
order, and every FANOUT nodes in a row become their hash, the last run as it comes, until one is left: the group's root.
The groups' roots, in the order of the groups, form a tree in the same way, whose top is the root of the table.

A slot pivot takes LEVELS levels at once: conditional aggregates spread the FANOUT ** LEVELS nodes of a block into as many columns.
Hashing neighbouring columns together gives the block's inner nodes; leaving the own column out gives a node's siblings.
The nodes of the next blocks are the roots of these, so tables shrink FANOUT ** LEVELS-fold from pivot to pivot, and
leaves are shuffled twice: by order, for their places, and by block. Going down, a block joins the path above its root, and its
slots become rows again. Places are those in range partitions plus the counts of the partitions before; no group, however large,
is in one task.

Leaves (`leaves`): sha256, lowercase hex, of each of FIELDS in turn: `-` if null, else its length in UTF-8 bytes, `:` and
the value. Rows with the same id stand in the order of their leaves, and equal rows one behind the other, each with its own
proof. Null ids come first. Empty texts count as such; long texts cost only their own hash. An empty table gives
no rows. Only the named columns are read, so others may have any name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txguard.plans.workspace import stored

FANOUT, LEVELS = 2, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(fields: list[Column]) -> Column:
    """Hash of values, each with its length."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, id_: str = "doc_id", group: str = "lang", fields: tuple = FIELDS, changed: dict | None = None) -> DataFrame:
    """id, grp (orders as the group does, null first), leaf, and `presented`: the leaf with the columns in `changed` instead."""
    changed = changed or {}
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    own = [F.col(f"`{f}`") for f in fields]
    return docs.select(
        F.col(f"`{id_}`").alias("id"), key.alias("grp"), digest(own).alias("leaf"),
        digest([changed.get(f, c) for f, c in zip(fields, own)]).alias("presented"),
    )


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` with place (from 0) and n (how many) in grp, in that order."""
    ordered = nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    runs = ordered.groupBy("grp", part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per group and partition
    runs = runs.select(
        "grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(W.partitionBy("grp")).alias("n"),
    )
    found = ordered.withColumn("part", part).join(runs, ["grp", "part"])
    return found.withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _blocks(nodes: DataFrame, more: list[str]) -> DataFrame:
    """A row per block: grp, block, n, and a column per slot with node and `more`."""
    width = FANOUT**LEVELS
    whole = f"struct({', '.join(['node', *more])})"
    slots = [F.expr(f"max(CASE WHEN pmod(place, {width}) = {i} THEN {whole} END) AS s{i}") for i in range(width)]
    return nodes.groupBy("grp", F.expr(f"place div {width} AS block")).agg(F.max("n").alias("n"), *slots)


def _joined(level: int, begin: int, end: int) -> str:
    """SQL for the nodes of a level from begin to end, one behind the other."""
    return f"concat('', {', '.join(f"coalesce(h{level}_{j}, '')" for j in range(begin, end))})" if end > begin else "''"


def _with_levels(blocks: DataFrame) -> DataFrame:
    """Adds a column per inner node: h<level>_<i>. Where a group has one node left it stays as it is."""
    width = FANOUT**LEVELS
    blocks = blocks.select("*", *[F.expr(f"s{i}.node AS h0_{i}") for i in range(width)])
    for level in range(LEVELS):
        width //= FANOUT
        made = []
        for i in range(width):
            first = f"h{level}_{i * FANOUT}"
            whole = f"sha2({_joined(level, i * FANOUT, (i + 1) * FANOUT)}, 256)"
            made.append(F.expr(f"CASE WHEN {first} IS NULL OR n <= {FANOUT**level} THEN {first} ELSE {whole} END AS h{level + 1}_{i}"))
        blocks = blocks.select("*", *made)
    return blocks


def _siblings(slot: int) -> str:
    """SQL: per level of the block, the siblings before and after the node above a slot; a level above the group's root has none."""
    levels = []
    for level in range(LEVELS):
        own = slot // FANOUT**level
        first = own // FANOUT * FANOUT
        before, after = _joined(level, first, own), _joined(level, own + 1, first + FANOUT)
        levels.append(f"CASE WHEN n > {FANOUT**level} THEN named_struct('before', {before}, 'after', {after}) END")
    return f"array_compact(array({', '.join(levels)}))"


def tree(nodes: DataFrame, more: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (grp, node) of the groups of `nodes` (grp, place, n, node, `more`), and the pivots, lowest first."""
    pivots = []
    while True:
        blocks = stored(_with_levels(_blocks(nodes, [] if pivots else more)), "merkle-pivot")
        pivots.append(blocks)
        n = F.ceil(F.col("n") / FANOUT**LEVELS)
        nodes = blocks.select("grp", F.col("block").alias("place"), n.alias("n"), F.col(f"h{LEVELS}_0").alias("node"))
        if nodes.where("n > 1").isEmpty():
            return nodes.select("grp", "node"), pivots


def paths(pivots: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest nodes' slots (`node`, what else they hold), with grp and `path`: siblings by level, up to the group's root and
    then as in `above` (grp, path, what else it holds)."""
    width = FANOUT**LEVELS
    extra = [c for c in above.columns if c not in ("grp", "path")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(pivots):
        slots = [
            f"CASE WHEN s{i} IS NOT NULL THEN named_struct('i', {i}L, 'slot', s{i}, 'own', {_siblings(i)}) END" for i in range(width)
        ]
        rows = blocks.join(above, ["grp", "block"]).select(
            "grp", "block", "path", *extra, F.expr(f"explode(array_compact(array({', '.join(slots)}))) AS x")
        )
        above = rows.select(
            "grp", (F.col("block") * width + F.col("x.i")).alias("block"), F.concat("x.own", "path").alias("path"), *extra, "x.slot.*"
        )
        if blocks is not pivots[0]:
            above = above.drop("node")
    return above.drop("block")


def manifest(found: DataFrame) -> DataFrame:
    """Of each leaf in `found` (as `leaves` makes it): id, grp, leaf, presented, subroot, root, path (struct before, after of each level)."""
    lowest = placed(found, ["id", "leaf"]).withColumnRenamed("leaf", "node")
    roots, pivots = tree(lowest, ["id", "presented"])
    top = roots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "node")
    tops, top_pivots = tree(placed(top, ["member"]), ["member"])
    none = F.array().cast("array<struct<before:string,after:string>>")
    tops = tops.select("grp", F.col("node").alias("root"), none.alias("path"))
    members = paths(top_pivots, tops)
    members = members.select(F.col("member").alias("grp"), F.col("node").alias("subroot"), "root", "path")
    return paths(pivots, members).withColumnRenamed("node", "leaf")


def folded(leaf: str | Column, path: str | Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def proof_digest(path: str) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def verified(docs: DataFrame, id_: str = "doc_id", group: str = "lang", fields: tuple = FIELDS, changed: dict | None = None) -> DataFrame:
    """id, leaf, subroot, root, path; folded_root: from the row as presented (with the columns in `changed`) and its path; verified: whether it is the root."""
    found = manifest(leaves(docs, id_, group, fields, changed))
    return found.withColumn("folded_root", folded("presented", "path")).withColumn("verified", F.col("folded_root") == F.col("root"))
