"""Classes from links: connected components and the pairs inside a class, without hot tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralane.session import cut

#: Rows of a class that meet in one task; larger classes are compared block by block.
BLOCK = 2_000
MAX_ROUNDS = 60


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an int64 link table; the component is its smallest node.

    Alternating large-star and small-star rounds; every round is two aggregations and two joins of the
    link table with itself, its result is written to the checkpoint folder.  Self-links are kept as
    single nodes; nulls are dropped; direction and repetition of links make no difference.
    """
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u IS NOT NULL AND v IS NOT NULL").distinct()
    pairs = cut(pairs)
    nodes = pairs.select("u").union(pairs.select(F.col("v").alias("u"))).distinct()
    state = pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: every larger neighbour of u goes to the smallest node around u
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: all smaller neighbours of u, and u itself, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        state = cut(small)
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return nodes.join(state, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))


def pairs_within(members: DataFrame, group: str, key: str, left: str, right: str, block: int = BLOCK) -> DataFrame:
    """Every pair of different keys of one group, smaller key first, each once.

    ``members`` has distinct (group, key) rows.  A group of n keys gives n(n-1)/2 pairs; groups larger
    than ``block`` are cut into blocks that meet pairwise, so that no task holds a whole large group.
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = members.join(sizes, group).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    # block b meets every block o at the place (min, max)
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least("own", o) * F.col("blocks") + F.greatest("own", o))
    placed = rows.select(group, F.col(key).alias("k"), "own", (F.col("blocks") + 1).alias("span"), F.explode(meet).alias("place"))
    x, y = placed.alias("x"), placed.alias("y")
    same_block = F.col("x.own") == F.col("y.own")
    diagonal = F.col("x.place") % F.col("x.span") == 0
    met = x.join(y, (F.col(f"x.{group}") == F.col(f"y.{group}")) & (F.col("x.place") == F.col("y.place")) & (F.col("x.k") < F.col("y.k")) & (~same_block | diagonal))
    return met.select(F.col("x.k").alias(left), F.col("y.k").alias(right))
