"""Corrections and patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.operators import rows as r
from tablemend.operators.fill import fill_by_group
from tablemend.operators.sets import upsert_union
from tablemend.queries.registry import query
from tablemend.sources.tables import literal_table


@query("q24_rows_update", """
WITH y AS (SELECT p_brand, max(p_type) AS p_type, nullif(max(p_size), 50) AS p_size FROM part
           GROUP BY 1 HAVING sum(p_size) * 2 > 51 * count(*))
SELECT p_partkey, p_name, x.p_brand, CASE WHEN y.p_brand IS NULL THEN x.p_type ELSE y.p_type END AS p_type,
       CASE WHEN y.p_brand IS NULL THEN x.p_size ELSE y.p_size END AS p_size, p_retailprice
FROM part x LEFT JOIN y ON x.p_brand = y.p_brand
""")
def rows_update(t):
    patch = (
        t.part.groupBy("p_brand")
        .agg(F.max("p_type").alias("p_type"), F.max("p_size").alias("p_size"), F.sum("p_size").alias("s"), F.count(F.lit(1)).alias("n"))
        .where("s * 2 > 51 * n")
        .select("p_brand", "p_type", F.nullif("p_size", F.lit(50)).alias("p_size"))
    )
    return r.rows_update(t.part, patch, ["p_brand"])


@query("q25_rows_patch", """
SELECT c_custkey, c_name, c.c_nationkey, c_acctbal, coalesce(nullif(c.c_mktsegment, 'BUILDING'), y.seg) AS c_mktsegment
FROM customer c LEFT JOIN (SELECT s_nationkey + 5 AS nk, min(s_name) AS seg FROM supplier GROUP BY 1) y ON c.c_nationkey = y.nk
""")
def rows_patch(t):
    customer = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    patch = t.supplier.groupBy((F.col("s_nationkey") + 5).alias("c_nationkey")).agg(F.min("s_name").alias("c_mktsegment"))
    return r.rows_patch(customer, patch, ["c_nationkey"], unmatched="ignore")


@query("q26_unmatched_patches", """
SELECT o_custkey + 300 AS c_custkey, max(o_orderdate) AS last_order FROM orders
WHERE o_custkey + 300 NOT IN (SELECT c_custkey FROM customer) GROUP BY 1
""")
def unmatched_patches(t):
    patch = t.orders.groupBy((F.col("o_custkey") + 300).alias("c_custkey")).agg(F.max("o_orderdate").alias("last_order"))
    return r.unmatched_rows(t.customer, patch, ["c_custkey"])


@query("q27_chained_updates", """
SELECT s_suppkey, s_nationkey, r_name AS region,
       CASE WHEN r_regionkey >= 2 THEN 'G-' || r_name ELSE 'N' END AS grade
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def chained_updates(t):
    suppliers = t.supplier.select("s_suppkey", "s_nationkey", F.lit(None).cast("string").alias("region"), F.lit("N").alias("grade"))
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("region")
    )
    grades = t.region.where("r_regionkey >= 2").select(F.col("r_name").alias("region"), F.concat(F.lit("G-"), "r_name").alias("grade"))
    return r.apply_corrections(suppliers, [(regions, ["s_nationkey"]), (grades, ["region"])])


@query("q28_patch_dup_guard", """
SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1
""")
def patch_dup_guard(t):
    return r.duplicate_keys(t.part, ["p_brand", "p_type", "p_size"])


@query("q33_upsert_union", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def upsert(t):
    preferred = t.part.where("p_type = 'PROMO'").withColumn("p_name", F.upper("p_name"))
    return upsert_union(preferred, t.part, ["p_partkey"])


@query("q77_update_all_matched", """
WITH y AS (SELECT n_regionkey, max(n_name) AS last_nation FROM nation GROUP BY 1)
SELECT r_regionkey, r_name, CASE WHEN n_regionkey IS NULL THEN 'none' ELSE last_nation END AS last_nation
FROM region LEFT JOIN y ON r_regionkey = n_regionkey
""")
def update_all_matched(t):
    """Every patch row must find its target; the job would stop if one did not."""
    regions = t.region.select("r_regionkey", "r_name", F.lit("none").alias("last_nation"))
    patch = t.nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.max("n_name").alias("last_nation"))
    return r.rows_update(regions, patch, ["r_regionkey"], unmatched="error")


@query("q78_fill_single_values", """
SELECT p_partkey, p_brand, CASE WHEN max(p_brand) FILTER (WHERE p_size > 25) OVER (PARTITION BY p_brand) IS NOT NULL THEN upper(p_brand) END AS label
FROM part
""")
def fill_single_values(t):
    """Groups with one known value; the job would stop at a group with two."""
    parts = t.part.select("p_partkey", "p_brand", F.when(F.col("p_size") > 25, F.upper("p_brand")).alias("label"))
    return fill_by_group(parts, ["p_brand"], ["label"], multiple="error")


@query("q79_literal_patch", """
SELECT r_regionkey, r_name, CASE r_name WHEN 'ASIA' THEN 'east' WHEN 'AMERICA' THEN 'west' END AS side, count(n_nationkey) AS nations
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2, 3
""")
def literal_patch(t):
    """A patch whose rows are written out in the program."""
    counted = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_regionkey", "r_name").agg(F.count("n_nationkey").alias("nations"))
    patch = literal_table(t.spark, "r_name string, side string", [("ASIA", "east"), ("AMERICA", "west")])
    return r.rows_patch(counted.withColumn("side", F.lit(None).cast("string")), patch, ["r_name"], small=True)
