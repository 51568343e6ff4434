"""The driver's test tables and the stand-ins built on them.

``tx`` plays the listing rows (city = region name, district = nation name) and
``ck`` the check list of the 25 districts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
DEFAULT_SF_DIR = "/root/testdata/sf0.001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (city, district) names; a 25-row dimension."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("city"), F.col("n_name").alias("district"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(city, district, o_orderkey, o_totalprice, tx_date) per order.

    The join order puts the two small dimensions first; Catalyst broadcasts
    the customer side only while its file-size estimate is under the
    broadcast threshold and shuffles (with AQE skew splitting) above it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cg = c.join(geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey")).select(
        "c_custkey", "city", "district")
    return o.join(cg, o.o_custkey == cg.c_custkey).select(
        "city", "district", "o_orderkey", "o_totalprice", F.col("o_orderdate").alias("tx_date"))


def ck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check list of the 25 districts: record_id, city, district, done_yn
    (the first ten are done)."""
    g = geo(spark, sf_dir)
    return g.select((F.col("n_nationkey") + 1).cast("int").alias("record_id"), "city", "district",
                    F.when(F.col("n_nationkey") < 10, F.lit("Y")).alias("done_yn"))
