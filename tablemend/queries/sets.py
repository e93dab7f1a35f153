"""Set operations, aggregations and conflict reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.operators import aggregates as a
from tablemend.operators import sets as s
from tablemend.queries.registry import query


@query("q29_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return s.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus"))


@query("q30_setdiff_both", """
WITH a AS (SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer),
     b AS (SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier)
SELECT nation, band, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT s_nationkey, band, 'right' FROM (SELECT s_nationkey, 0 AS x, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) q(s_nationkey, x, k2, band)
""")
def setdiff_both(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).alias("band"))
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 1000).alias("band"))
    return s.one_sided(customers, suppliers)


@query("q31_multiset_equal", """
SELECT coalesce(o_custkey, c_custkey) AS custkey, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right
FROM (SELECT o_custkey, count(*) AS n_left FROM orders GROUP BY 1)
FULL JOIN (SELECT c_custkey, count(*) AS n_right FROM customer GROUP BY 1) ON o_custkey = c_custkey
WHERE n_left IS DISTINCT FROM n_right
""")
def multiset_equal(t):
    return s.multiset_difference(t.orders.select(F.col("o_custkey").alias("custkey")), t.customer.select(F.col("c_custkey").alias("custkey")))


@query("q32_coverage_audit", """
SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS n_covered,
       count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_uncovered, 0::BIGINT AS n_null
FROM documents
""")
def coverage_audit(t):
    return s.coverage(t.documents, "doc_id", t.labels, "doc_id")


@query("q34_suffix_collision", """
SELECT regexp_replace(p_brand, '[0-9]$', '') AS stem, count(DISTINCT p_brand) AS n_values,
       min(p_brand) AS first_value, max(p_brand) AS last_value
FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1
""")
def suffix_collision(t):
    return s.collisions(t.part, "p_brand", F.regexp_replace("p_brand", "[0-9]$", ""), "stem")


@query("q35_collapse_groups", """
SELECT p_brand, string_agg(DISTINCT coalesce(nullif(p_type, 'PROMO'), 'NA'), ', ' ORDER BY coalesce(nullif(p_type, 'PROMO'), 'NA')) AS p_type,
       string_agg(DISTINCT CAST(p_size AS VARCHAR), ', ' ORDER BY CAST(p_size AS VARCHAR)) AS p_size
FROM part GROUP BY 1
""")
def collapse_groups(t):
    parts = t.part.withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return a.collapse_groups(parts, ["p_brand"], ["p_type", "p_size"])


def _fd_sql(determinant: str, value: str, dependent: str) -> str:
    return f"""SELECT '{determinant}' AS determinant, '{dependent}' AS dependent, k AS determinant_value, v AS found_value, n_rows, n_values, n_group
FROM (SELECT {value} AS k, CAST({dependent} AS VARCHAR) AS v, count(*) AS n_rows,
             count(*) OVER (PARTITION BY {value}) AS n_values,
             CAST(sum(count(*)) OVER (PARTITION BY {value}) AS BIGINT) AS n_group FROM part GROUP BY 1, 2)
WHERE n_values > 1"""


@query("q37_fd_conflicts", " UNION ALL ".join([
    _fd_sql("p_brand", "p_brand", "p_type"),
    _fd_sql("p_name+p_size", "p_name || '|' || p_size", "p_brand"),
    _fd_sql("p_partkey", "CAST(p_partkey AS VARCHAR)", "p_name"),
]))
def fd_conflicts(t):
    return a.conflict_report(t.part, [(["p_brand"], "p_type"), (["p_name", "p_size"], "p_brand"), (["p_partkey"], "p_name")])


@query("q38_elect_standard_name", """
SELECT p_brand, p_type AS standard FROM (
  SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand
         ORDER BY count(*) DESC, CASE WHEN p_type = 'STANDARD' THEN 0 ELSE 1 END, p_type) AS rn
  FROM part GROUP BY 1, 2) WHERE rn = 1
""")
def elect_standard_name(t):
    return a.elect(t.part, ["p_brand"], "p_type", "standard", F.when(F.col("p_type") == "STANDARD", 0).otherwise(1))


@query("q40_null_out_ambiguous", """
SELECT p_partkey, p_name, p_size, CASE WHEN n = 1 THEN p_brand END AS p_brand, CASE WHEN n = 1 THEN p_type END AS p_type
FROM (SELECT *, count(*) OVER (PARTITION BY p_name, p_size, p_retailprice > 1000) AS n FROM part)
""")
def null_out_ambiguous(t):
    parts = t.part.select("p_partkey", "p_name", "p_size", "p_brand", "p_type", (F.col("p_retailprice") > 1000).alias("dear"))
    return a.null_out_ambiguous(parts, ["p_name", "p_size", "dear"], ["p_brand", "p_type"]).drop("dear")


@query("q64_group_size", """
SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM orders
""")
def group_size(t):
    return a.with_group_size(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_custkey", "o_orderstatus"]).drop("o_orderstatus")
