"""Relational building blocks with explicit keys, checks and tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.session import cut


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, n)`` of the keys that stand in more than one row; null keys count like values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, after checking that no key stands twice; a ValueError names one that does."""
    found = duplicates(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"keys {keys} are not unique: {tuple(found[0])[:-1]}")
    return df


def left_join_checked(left: DataFrame, right: DataFrame, keys: list[str], relation: str = "m:1") -> DataFrame:
    """Left equi-join that keeps the left rows' number: the right keys, and for 1:1 the left ones, are unique."""
    if relation not in ("m:1", "1:1"):
        raise ValueError("relation is m:1 or 1:1")
    require_unique(right, keys)
    if relation == "1:1":
        require_unique(left, keys)
    return left.join(right, keys, "left")


def lookup(df: DataFrame, column: str, mapping: dict, name: str) -> DataFrame:
    """Adds ``name`` from a mapping held in the plan; keys it lacks give null."""
    if not mapping:
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn(name, F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col(column)])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in a total order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", rank).filter("__n = 1").drop("__n")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... in a global order, without one task that sees all rows.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the sizes of
    the partitions before it.  The partitioning is written out, so the numbers are those of one run.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", inside))
    sizes = sorted((r["__p"], r["n"]) for r in placed.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, {}
    for part, n in sizes:
        offsets[part] = before
        before += n
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("__p", "__i")
    shift = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("__p")]
    return placed.withColumn(name, (shift + F.col("__i")).cast("long")).drop("__p", "__i")


def top_k(df: DataFrame, k: int, score: str, tie: str) -> DataFrame:
    """The k rows with the highest score, ties by the smaller ``tie``; with their ``rank``.

    A limit with an order keeps k rows per task, so no task sees the whole table.
    """
    best = df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.col(score).desc(), F.col(tie).asc())))


def group_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """Every row with the exact, linearly interpolated quantile of its group."""
    return df.join(df.groupBy(*keys).agg(F.percentile(value, F.lit(q)).alias(name)), keys)


def block_sum(matrix: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of a long matrix (src, dst, value) over blocks; ``groups`` is (code, grp), codes without group drop out."""
    a = groups.select(F.col("code").alias("src"), F.col("grp").alias("src_group"))
    b = groups.select(F.col("code").alias("dst"), F.col("grp").alias("dst_group"))
    return matrix.join(a, "src").join(b, "dst").groupBy("src_group", "dst_group").agg(F.sum("value").alias("value"))


def first_reaching(df: DataFrame, keys: list[str], order: list[str], weight: str, need: Column, distance: str, name: str) -> DataFrame:
    """Per key the smallest distance at which the running weight reaches ``need``; null where it never does."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    run = df.withColumn("__run", F.sum(weight).over(w))
    return run.groupBy(*keys).agg(F.min(F.when(F.col("__run") >= need, F.col(distance))).alias(name))


def runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``run``: the number of the stretch of equal neighbours, from 1, in the given order."""
    w = W.partitionBy(*keys).orderBy(*order)
    starts = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.when(F.row_number().over(w) == 1, 1).otherwise(starts)
    return df.withColumn("__s", first).withColumn("run", F.sum("__s").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__s")


def neighbours_in_grid(left: DataFrame, right: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs of points whose grid cells touch: nine offsets on the left, one equi-join, no cross product."""
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = left.select("*", F.explode(around).alias("o")).select("*", (F.floor(F.col(x) / cell) + F.col("o.i")).alias("gx"), (F.floor(F.col(y) / cell) + F.col("o.j")).alias("gy")).drop("o")
    b = right.select("*", F.floor(F.col(x) / cell).alias("gx"), F.floor(F.col(y) / cell).alias("gy"))
    return a.alias("a").join(b.alias("b"), ["gx", "gy"])
