"""Merkle manifest of a dataset: one tree a source, a tree over the sources, and a recursive climb that proves every row.

Leaves of a source stand in the order of their ids; every `FAN` neighbours hash to their parent until one node, the
source's subroot, is left; the subroots are the leaves of the tree that gives the root.

Levels are stored `LEVELS` at a time: a stored row is a *block*, the node above up to `FAN ** LEVELS` neighbours with the hashes
of all levels in between, and a link to its parent block.  A recursive SQL query then climbs from every leaf at once: each
step joins the leaf's place with its block, folds the leaf's hash through the block's levels, appends the siblings
and moves to the parent's place.  Seven steps reach the root above 10^11 leaves, and no step sends whole levels about.

Heights with at most `SMALL` blocks are broadcast, so leaves and proofs stay where they are; below them leaves travel to
their blocks.  All leaves below a block meet in its join.  A block above more than `SPREAD` leaves is therefore stored several
times, salted, so that no join key has more than about `SPREAD` rows however large a source is.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloader.llm.common import cut, discard, release, scratch_path

FAN = 3
LEVELS = 4
SPREAD = 512
# Blocks of a height that are broadcast: at most some 16 KB each, below Spark's own bound of 10 MB together.
SMALL = 512
SPAN = FAN**LEVELS
# The tree over the sources, and the place above the root.
TOP, DONE = -1, -2
# Bytes that a task sorts, as expected, and what a leaf's row takes.
SORT_BYTES = 64 << 20
LEAF_BYTES = 200


def field(value: Column) -> Column:
    """A value as its byte count, a colon and its text; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """Lowercase hex sha256 of a row with this text."""
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def hit(doc_id: str = "doc_id") -> Column:
    """The rows that are tampered with: their id has an even crc32.  A row without id is left alone."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def numbered(rows: DataFrame, group: str, order: list[str], tasks: int) -> tuple[DataFrame, DataFrame]:
    """The rows with `task` and `at`, and runs (group, task, first, before, width): a row's number in its group is
    `at - first + before`, the group has `width` rows.

    Rows are range partitioned and sorted, so a group of any size lies in many tasks.  Equal rows get numbers too.
    """
    keys = [group, *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    laid = cut(tied.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("tie"))
    # The id holds the task in its upper bits and the place within it in the lower 33.
    placed = laid.withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", 33))
    placed.cut_path = laid.cut_path
    runs = placed.groupBy(group, "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    return placed, runs.select(
        group, "task", "first", (F.sum("n").over(whole.orderBy("task")) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("width")
    )


def _in_group(placed: DataFrame, runs: DataFrame, group: str) -> DataFrame:
    own = runs.withColumnsRenamed({group: "in_group", "task": "in_task"})
    met = placed.join(own, F.col(group).eqNullSafe(F.col("in_group")) & (F.col("task") == F.col("in_task")))
    return met.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "task", "in_group", "in_task", "first", "before")


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, tampered, tree, pos, width); `tree` numbers the sources in byte order, null first."""
    spark = docs.sparkSession
    own = F.col("text").cast("string")
    broken = hit() & F.coalesce(F.contains(own, F.lit("\n")), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.unhex(leaf_hash(own)).alias("leaf"),
        F.when(broken, F.unhex(leaf_hash(F.replace(own, F.lit("\n"), F.lit(""))))).alias("tampered"),
    ).withColumn("tampered", F.coalesce("tampered", "leaf"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranging samples its input, so the texts are hashed before.
    rows = cut(rows)
    laid, runs = numbered(rows, "source", ["doc_id", "leaf"], max(least, math.ceil(rows.count() * LEAF_BYTES / SORT_BYTES)))
    release(rows)
    runs = cut(runs)
    placed = cut(_in_group(laid, runs.join(ranks(runs), F.col("source").eqNullSafe(F.col("of"))).drop("of"), "source").drop("source"))
    release(laid, runs)
    return placed


def ranks(runs: DataFrame) -> DataFrame:
    """(of, tree): each source's number in byte order, null first.

    Tasks hold ranges of sources in order, so a source's number is its place among those that begin in its first task and
    the sources that begin in earlier ones.
    """
    begun = runs.groupBy(F.col("source").alias("of")).agg(F.min("task").alias("task"))
    sizes = begun.groupBy("task").agg(F.count("*").alias("n"))
    # One row for each task.
    before = sizes.select(F.col("task").alias("begun_in"), (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("task").orderBy("of"))
    met = begun.withColumn("place", place).join(before, F.col("task") == F.col("begun_in"))
    return met.select("of", (F.col("before") + F.col("place") - 1).alias("tree"))


def _parents(level: str) -> Column:
    """The hashes of one level up, in order."""
    runs = f"sequence(0, cast((size({level}) - 1) div {FAN} as int))"
    return F.expr(f"transform({runs}, i -> sha2(array_join(slice({level}, i * {FAN} + 1, {FAN}), ''), 256))")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """(tree, pos, width, h, leaves) to blocks (tree, block, width, leaves, levels, root) of `SPAN` neighbours each.

    `levels` are the hashes of each level from the neighbours up; above a tree's last node a level repeats.
    """
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "h"))), lambda n: n["h"])
    made = nodes.withColumn("block", F.expr(f"pos div {SPAN}")).groupBy("tree", "block").agg(
        F.max("width").alias("width"), F.sum("leaves").alias("leaves"), ordered.alias("l0")
    )
    for k in range(LEVELS):
        made = made.withColumn(f"l{k + 1}", F.when(F.col("width") > FAN**k, _parents(f"l{k}")).otherwise(F.col(f"l{k}")))
    levels = F.array(*[f"l{k}" for k in range(LEVELS)])
    return made.select("tree", "block", "width", "leaves", levels.alias("levels"), F.element_at(f"l{LEVELS}", 1).alias("root"))


class Built(NamedTuple):
    """The number of sources, and the blocks at each height of their trees and of the tree over them."""

    trees: int
    source: list[int]
    top: list[int]

    def large(self, side: str) -> int:
        """Heights from here on are broadcast: they have few blocks, and so do those above them."""
        return sum(n > SMALL for n in getattr(self, side))


def build(placed: DataFrame, path: str) -> Built:
    """Writes the blocks of all trees below `path`, height by height."""
    spark = placed.sparkSession

    def grow(nodes: DataFrame, widest: int, side: str) -> tuple[DataFrame, list[int]]:
        """Blocks upon blocks until each tree has one left; returns those, which hold the trees' roots."""
        ended, many = None, []
        while True:
            folder = f"{path}/side={side}/height={len(many)}"
            new = blocks_of(nodes)
            new.write.parquet(folder)
            made = spark.read.schema(new.schema).parquet(folder)
            many.append(made.count())
            last = made.where(F.col("width") <= SPAN).select("tree", "root", "leaves")
            ended = last if ended is None else ended.union(last)
            if widest <= SPAN:
                return ended, many
            nodes = made.where(F.col("width") > SPAN).select(
                "tree", F.col("block").alias("pos"), F.ceil(F.col("width") / SPAN).alias("width"), F.col("root").alias("h"), "leaves"
            )
            widest = math.ceil(widest / SPAN)

    one = F.lit(1).cast("long")
    widest = placed.agg(F.max("width")).first()[0] or 0
    subroots, source = grow(placed.select("tree", "pos", "width", F.lower(F.hex("leaf")).alias("h"), one.alias("leaves")), widest, "source")
    trees = subroots.count()
    at_top = [F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).cast("long").alias("width")]
    _, top = grow(subroots.select(*at_top, F.col("root").alias("h"), "leaves"), trees, "top")
    return Built(trees, source, top)


def _siblings(level: int, before: bool) -> Column:
    """What stands before (after) each node of a level in its run, joined; nothing where the tree has ended."""
    own = f"levels[{level}]"
    run = f"slice({own}, i - i % {FAN} + 1, i % {FAN})" if before else f"slice({own}, i + 2, {FAN - 1} - i % {FAN})"
    return F.expr(f"transform({own}, (h, i) -> if(width > {FAN**level}, array_join({run}, ''), ''))")


def linked(blocks: DataFrame, built: Built) -> DataFrame:
    """Blocks with the place of their parent; those not to be broadcast are stored once for every `SPREAD` leaves below them."""
    ends, top = F.col("width") <= SPAN, F.col("tree") == TOP

    def up(at_root: Column, at_subroot: Column, inside: Column) -> Column:
        return F.when(ends & top, at_root).when(ends, at_subroot).otherwise(inside).cast("long")

    travels = F.col("height") < F.when(top, built.large("top")).otherwise(built.large("source"))
    own = blocks.drop("side").withColumns({
        "salts": F.when(travels, F.ceil(F.col("leaves") / SPREAD)).otherwise(F.lit(1)).cast("long"),
        "height": F.col("height").cast("long"),
        "up_tree": up(F.lit(DONE), F.lit(TOP), F.col("tree")),
        "up_height": up(F.lit(0), F.lit(0), F.col("height") + 1),
        "up_pos": up(F.lit(0), F.col("tree"), F.col("block")),
        "up_width": up(F.lit(0), F.lit(built.trees), F.ceil(F.col("width") / SPAN)),
    })
    above = own.select(
        F.col("tree").alias("up_tree"), F.col("height").alias("up_height"), F.col("block").alias("up_block"), F.col("salts").alias("up_salts")
    )
    met = own.withColumn("up_block", F.expr(f"up_pos div {SPAN}")).join(above, ["up_tree", "up_height", "up_block"], "left")
    met = met.withColumns({"before": F.array(*[_siblings(k, True) for k in range(LEVELS)]), "after": F.array(*[_siblings(k, False) for k in range(LEVELS)])})
    return met.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select(
        "tree", "height", "block", "salt", "before", "after", F.unhex("root").alias("node"), "up_tree", "up_height", "up_pos", "up_width",
        F.coalesce("up_salts", F.lit(1).cast("long")).alias("up_salts"),
    )


def _recursion(inside: str, hint: str) -> str:
    """The climb through the blocks at places `inside`, as SQL.

    A step folds the levels of a block one after the other, each in a projection of its own.
    """
    columns = "doc_id, leaf, spot, tree, height, pos, width, salts, folded, proof, subroot, root"
    step = f"""
        SELECT {hint} c.doc_id, c.leaf, c.spot, c.tree, c.width, c.folded AS f0, c.proof, c.subroot, b.*, cast(c.pos % {SPAN} as int) AS i
        FROM (SELECT * FROM climb WHERE {inside}) c
        JOIN (SELECT * EXCEPT (tree, height), tree AS of_tree, height AS of_height FROM {{blocks}} WHERE {inside}) b
        ON of_tree = c.tree AND of_height = c.height AND b.block = c.pos div {SPAN} AND b.salt = pmod(c.spot, c.salts)"""
    siblings = []
    for k in range(LEVELS):
        at = f"[{k}][cast(i div {FAN**k} as int)]"
        folded = f"unhex(sha2(concat(before{at}, lower(hex(f{k})), after{at}), 256))"
        step = f"SELECT *, if(width > {FAN**k}, {folded}, f{k}) AS f{k + 1} FROM ({step})"
        siblings += [f"before{at}", f"after{at}"]
    return f"""
    WITH RECURSIVE climb({columns}) AS (
        SELECT {columns} FROM {{rows}}
        UNION ALL
        SELECT doc_id, leaf, spot, up_tree, up_height, up_pos, up_width, up_salts, f{LEVELS},
               concat(proof, unhex(concat({", ".join(siblings)}))),
               if(up_tree = {TOP} AND tree <> {TOP}, node, subroot), if(up_tree = {DONE}, node, X'')
        FROM ({step})
    )
    SELECT * FROM climb WHERE NOT ({inside}) LIMIT ALL
    """


def climb(placed: DataFrame, blocks: DataFrame, built: Built, path: str) -> DataFrame:
    """Every leaf's way to the root: (doc_id, leaf, subroot, root, proof, folded_root, verified), hashes in binary.

    `path` is a folder for the places between phases. `proof` holds the siblings' digests one after the other, 32 bytes each, level by level, left to right.
    """
    rows = placed.selectExpr(
        "doc_id", "leaf", "xxhash64(tree, pos) AS spot", "tree", "0L AS height", "pos", "width",
        # Blocks of the first height have too few leaves for salt.
        "1L AS salts", "tampered AS folded", "X'' AS proof", "X'' AS subroot", "X'' AS root",
    )
    source, top = built.large("source"), built.large("top")
    travel, stay = "", "/*+ BROADCAST(b) */"
    at = {
        ("source", travel): f"(tree >= 0 AND height < {source})", ("source", stay): f"(tree >= 0 AND height >= {source})",
        ("top", travel): f"(tree = {TOP} AND height < {top})", ("top", stay): f"(tree = {TOP} AND height >= {top})",
    }
    phases = [(at["source", travel], travel)] if source else []
    if top:
        phases += [(at["source", stay], stay), (at["top", travel], travel), (at["top", stay], stay)]
    else:
        phases.append((f"{at['source', stay]} OR {at['top', stay]}", stay))
    spark = placed.sparkSession
    for k, (inside, hint) in enumerate(phases):
        reached = spark.sql(_recursion(inside, hint), rows=rows, blocks=blocks)
        if k < len(phases) - 1:
            # Read from files, as the constraints that a checkpoint keeps break the next recursion's plan.
            reached.write.parquet(f"{path}/phase={k}")
            rows = spark.read.parquet(f"{path}/phase={k}")
    return reached.selectExpr("doc_id", "leaf", "subroot", "root", "proof", "folded AS folded_root", "folded = root AS verified")


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, subroot, root and proof, and whether its tampered text still folds to the root.

    Nulls in any column have a hash of their own; rows with a null id come first in their source, equal rows follow each
    other in any order, which changes no hash.  Texts are hashed whole.  An empty table gives no rows; columns
    other than doc_id, source, lang, n_chars and text are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    placed = leaves(docs)
    built = build(placed, f"{path}/built")
    linked(spark.read.parquet(f"{path}/built"), built).write.parquet(f"{path}/linked")
    proved = cut(climb(placed, spark.read.parquet(f"{path}/linked"), built, f"{path}/climb"))
    discard(spark, path)
    release(placed)
    return proved
