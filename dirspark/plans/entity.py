"""A directory of entities made from the driver's tables by integer arithmetic, the same in Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "1999-01-01"

#: SQL that Spark and the oracle share; {s} is the string type.
COLUMNS = {
    "external_id": "concat('c:', CAST(k AS {s}))",
    "source": "CASE k % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'ocm' END",
    "display_name": "concat(split_part('sri,durga,new,royal,city,lake,green,metro', ',', CAST(1 + k % 8 AS INT)), ' ', split_part('medicals,tent house,kirana stores,mobile point,state bank,xerox centre,hotel,tailors,hardware,general store', ',', CAST(1 + CAST(floor(k / 8.0) AS BIGINT) % 10 AS INT)), CASE WHEN k % 5 = 0 THEN concat(' ', CAST(k % 40 AS {s})) ELSE '' END)",
    "brand_name": "CASE WHEN k % 23 = 0 THEN concat(split_part('sri,durga,new,royal,city,lake,green,metro', ',', CAST(1 + k % 8 AS INT)), ' ', 'Hotel') END",
    "code": "CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(500000 + k % 97 AS {s}) END",
    "code_confidence": "CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(40 + k % 58 AS DOUBLE) / 100 END",
    "lat": "8 + CAST(k * 7919 % 28000 AS DOUBLE) / 1000",
    "lon": "69 + CAST(k * 104729 % 28000 AS DOUBLE) / 1000",
    "public_phone": "CASE k % 7 WHEN 0 THEN concat('+919', lpad(CAST(k * 7907 % 1000000000 AS {s}), 9, '0')) WHEN 1 THEN concat('+914023', lpad(CAST(k * 31 % 1000000 AS {s}), 6, '0')) WHEN 2 THEN concat('+919848', lpad(CAST(k % 50 AS {s}), 6, '0')) WHEN 3 THEN concat('+911800', lpad(CAST(k % 900 AS {s}), 6, '0')) WHEN 4 THEN concat('+910', CAST(k AS {s}), '1111111') END",
    "category": "lower(segment)",
    "website": "CASE WHEN k % 3 = 0 THEN concat('https://shop', CAST(k AS {s}), '.example.com') END",
    "address": "CASE WHEN k % 5 < 3 THEN concat(CAST(k % 200 AS {s}), ' main road') END",
    "hours": "CASE WHEN k % 11 = 0 THEN 'Mo-Sa 09:00-18:00' WHEN k % 13 = 0 THEN 'sunrise-sunset' END",
    "locality": "CASE WHEN k % 4 > 0 THEN concat('area ', CAST(k % 29 AS {s})) END",
    "location_accuracy": "CASE WHEN k % 2 = 0 THEN 'building' ELSE 'street' END",
    "district": "nation",
    "updated_at": "updated",
}


def select_list(s: str) -> str:
    return ", ".join(f"{x.format(s=s)} AS {c}" for c, x in COLUMNS.items())


#: The same as a relation for the oracle; other CTEs may follow.
ENTITY = f"""WITH updates AS (SELECT o_custkey, max(o_orderdate) AS updated FROM orders GROUP BY o_custkey),
base AS (SELECT c_custkey AS k, c_mktsegment AS segment, n_name AS nation, updated FROM customer LEFT JOIN updates ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
entity AS (SELECT k, {select_list('VARCHAR')} FROM base)"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each customer, with the attributes of a business and its key k."""
    updates = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("updated"))
    customers = read(spark, sf_dir, "customer").join(updates, F.col("c_custkey") == F.col("o_custkey"), "left").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    base = customers.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), "updated")
    return base.selectExpr("k", *(f"{x.format(s='STRING')} AS {c}" for c, x in COLUMNS.items()))
