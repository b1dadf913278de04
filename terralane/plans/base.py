"""Derived inputs shared by the queries: transactions, outputs, sectors, typed points and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralane.session import table as t


def code(column: str):
    return F.lpad(F.col(column).cast("string"), 2, "0")


def transactions(s: SparkSession, d: str) -> DataFrame:
    """Flows between nations as a long matrix (src, dst, value); decimal sums are exact in any order."""
    lines = t(s, d, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,6)").alias("v"))
    joined = lines.join(t(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(t(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t(s, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy(code("s_nationkey").alias("src"), code("c_nationkey").alias("dst")).agg(F.sum("v").cast("decimal(38,6)").alias("value"))


def outputs(s: SparkSession, d: str) -> DataFrame:
    """Total output per sector: use by the others plus final demand (sector, x)."""
    demand = t(s, d, "orders").join(t(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(code("c_nationkey").alias("sector")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,6)")).alias("v"))
    use = transactions(s, d).groupBy(F.col("dst").alias("sector")).agg(F.sum("value").alias("v"))
    return use.select("sector", "v").unionByName(demand).groupBy("sector").agg(F.sum("v").cast("decimal(38,6)").alias("x"))


#: The same two tables as SQL.
Z_SQL = """z AS (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS src, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dst,
  CAST(sum(CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6)) AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""
X_SQL = """xs AS (SELECT sector, CAST(sum(v) AS DECIMAL(38,6)) AS x FROM (
  SELECT dst AS sector, sum(value) AS v FROM z GROUP BY 1 UNION ALL
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), sum(CAST(CAST(o_totalprice AS DECIMAL(18,6)) AS DECIMAL(38,6))) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) GROUP BY 1)"""
