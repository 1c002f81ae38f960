"""The raw credit-application view derived from the driver tables.

``orders`` joined to ``customer`` gives one application per order, with raw
(un-normalised) headers, ``NA`` sentinels and real nulls, exactly as a raw
credit CSV would arrive.  Both sides are large at scale, so the join is left
to Catalyst/AQE (sort-merge on the customer key, or broadcast when AQE sees
a small side at runtime); nothing is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (column pruning/pushdown by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    ck = F.col("c_custkey")
    ok = F.col("o_orderkey")
    nk = F.col("c_nationkey") % 10
    bal = F.col("c_acctbal")
    seg = F.col("c_mktsegment")
    return j.select(
        ok.alias("CustomerId"),
        (F.lit(18) + (ck * 7) % 58).cast("int").alias("Age"),
        F.when(ck % 10 < 7, "male").otherwise("female").alias("Sex"),
        (ok % 4).cast("int").alias("Job"),
        F.when(nk < 7, "own").when(nk < 9, "rent").otherwise("free").alias("Housing"),
        F.when(bal < 1000, "NA").when(bal < 4000, "little").when(bal < 6000, "moderate")
         .when(bal < 8000, "quite rich").otherwise("rich").alias("Saving accounts"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "little")
         .when(F.col("o_orderpriority") == "2-HIGH", "moderate")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "rich")
         .when(F.col("o_orderpriority") == "5-LOW", "NA").alias("Checking account"),
        F.col("o_totalprice").alias("Credit amount"),
        (F.lit(6) + (ok * 11) % 67).cast("int").alias("Duration"),
        F.when(ok % 13 == 0, "vacation/others")
         .when(seg == "AUTOMOBILE", "car")
         .when(seg == "FURNITURE", "furniture")
         .when(seg == "BUILDING", "repairs")
         .when(seg == "HOUSEHOLD", "domestic appliances")
         .otherwise("business").alias("Purpose"),
        F.when(F.col("o_orderstatus") == "F", "bad").otherwise("good").alias("Risk"),
    )


# The same view in SQL, for the DuckDB oracle (double-quoted identifiers).
APPLICATIONS_SQL = """
SELECT o_orderkey AS "CustomerId",
  CAST(18 + (c_custkey * 7) % 58 AS INT) AS "Age",
  CASE WHEN c_custkey % 10 < 7 THEN 'male' ELSE 'female' END AS "Sex",
  CAST(o_orderkey % 4 AS INT) AS "Job",
  CASE WHEN c_nationkey % 10 < 7 THEN 'own'
       WHEN c_nationkey % 10 < 9 THEN 'rent' ELSE 'free' END AS "Housing",
  CASE WHEN c_acctbal < 1000 THEN 'NA' WHEN c_acctbal < 4000 THEN 'little'
       WHEN c_acctbal < 6000 THEN 'moderate' WHEN c_acctbal < 8000 THEN 'quite rich'
       ELSE 'rich' END AS "Saving accounts",
  CASE o_orderpriority WHEN '1-URGENT' THEN 'little' WHEN '2-HIGH' THEN 'moderate'
       WHEN '3-MEDIUM' THEN 'rich' WHEN '5-LOW' THEN 'NA' END AS "Checking account",
  o_totalprice AS "Credit amount",
  CAST(6 + (o_orderkey * 11) % 67 AS INT) AS "Duration",
  CASE WHEN o_orderkey % 13 = 0 THEN 'vacation/others'
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'car'
       WHEN c_mktsegment = 'FURNITURE' THEN 'furniture'
       WHEN c_mktsegment = 'BUILDING' THEN 'repairs'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'domestic appliances'
       ELSE 'business' END AS "Purpose",
  CASE WHEN o_orderstatus = 'F' THEN 'bad' ELSE 'good' END AS "Risk"
FROM orders JOIN customer ON o_custkey = c_custkey
"""
