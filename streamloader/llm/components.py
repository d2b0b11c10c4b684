"""Connected components of a link table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import cut, forget_shuffles, release

# The alternation needs about log2(nodes) rounds; far more means a fault, and that is an error, never a cut result.
MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the node's smallest neighbour."""
    # One pass over the links, which a union would read twice.
    both = links.select(F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ("ab", "ba")])))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    # The link to the smallest itself carries the node.
    return down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of long ids to (id, root): every id that has a link, with the smallest id it reaches.

    Self links and repeated links do no harm; no links give no rows.  A node that many links meet is
    reduced by partial aggregation, and its join is an inner one that adaptive execution splits.
    """
    state = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            found = state.select(F.explode(F.array("a", "b")).alias("id"), F.col("b").alias("root"))
            rooted = cut(found.groupBy("id").agg(F.min("root").alias("root")))
            release(state)
            return rooted
        before = mark
        last, state = state, cut(_small_star(_large_star(state)).distinct())
        release(last)
        del last
        forget_shuffles(links.sparkSession)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
