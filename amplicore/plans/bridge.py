"""Amplicon tables as views of the driver's star schema, in Spark and in SQL.

abundance: a part is an observation, a supplier's nation a sample, quantities are counts. The sparse matrix has orders as
observations. A part's type, brand and name are its lineage. A line of an order is an alignment of the order (query) with
the part (subject): quantity is the bit score, discount and tax give identity and coverage. A document is a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANKS = ["type", "brand", "name"]

AB_SQL = """ab AS (SELECT l_partkey AS obs_id, n_name AS sample_id, CAST(sum(l_quantity) AS BIGINT) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2 HAVING sum(l_quantity) > 0)"""
ABS_SQL = AB_SQL.replace("ab AS", "abs_ AS").replace("l_partkey", "l_orderkey")
SAMPLE_SQL = "smp AS (SELECT n_name AS sample_id, r_name AS grp FROM nation JOIN region ON n_regionkey = r_regionkey)"
TAX_SQL = "tax AS (SELECT p_partkey AS obs_id, [p_type, p_brand, p_name] AS taxonomy FROM part)"
AFF_SQL = """aff AS (SELECT l_orderkey AS query_id, l_partkey AS subject, l_linenumber AS ord, l_quantity AS bitscore,
  round(100 * (1 - l_discount), 6) AS identity, round(100 * (1 - l_tax), 6) AS coverage, p_size AS aln_length,
  p_type AS r1, p_brand AS r2, p_name AS r3 FROM lineitem JOIN part ON l_partkey = p_partkey)"""
BEST_SQL = "best AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY query_id ORDER BY bitscore DESC) AS rk FROM aff) WHERE rk = 1)"
CONS_SQL = """cons AS (SELECT query_id, count(*) AS hits,
  CASE WHEN count(DISTINCT r1) = 1 THEN min(r1) ELSE 'Multi-affiliation' END AS c1,
  CASE WHEN count(DISTINCT r1) = 1 AND count(DISTINCT r2) = 1 THEN min(r2) ELSE 'Multi-affiliation' END AS c2,
  CASE WHEN count(DISTINCT r1) = 1 AND count(DISTINCT r2) = 1 AND count(DISTINCT r3) = 1 THEN min(r3) ELSE 'Multi-affiliation' END AS c3
  FROM best GROUP BY 1)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _matrix(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col(key).alias("obs_id"), "l_suppkey", "l_quantity")
    sup = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("sample_id"))
    joined = lines.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("obs_id", "sample_id").agg(F.sum("l_quantity").cast("long").alias("count")).where("count > 0")


def abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir, "l_partkey")


def sparse_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir, "l_orderkey")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("sample_id"), F.col("r_name").alias("group"))


def lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("obs_id"), F.array("p_type", "p_brand", "p_name").alias("taxonomy"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("aln_length"), F.array("p_type", "p_brand", "p_name").alias("taxonomy"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("subject"), F.col("l_linenumber").alias("ord"), F.col("l_quantity").alias("bitscore"), F.round(100 * (1 - F.col("l_discount")), 6).alias("identity"), F.round(100 * (1 - F.col("l_tax")), 6).alias("coverage"))
    return lines.join(part, F.col("subject") == F.col("p_partkey")).drop("p_partkey")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.col("text").alias("sequence"), F.col("source").alias("sample_id"), F.col("lang").alias("group"))
