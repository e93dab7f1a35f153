"""Joins with stated NULL rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.functions.nulls import matches, one_of
from tablemend.operators import columns as c
from tablemend.operators import joins as j
from tablemend.operators.aggregates import groups_with_repeats, repeated_in_group
from tablemend.queries.registry import query

_KEYED_SQL = """
SELECT o_orderkey, k AS custkey, n_customers, first_name
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) o
LEFT JOIN (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS ck, count(*) AS n_customers, min(c_name) AS first_name
           FROM customer GROUP BY 1) c ON {condition}
"""


def _keyed_orders_and_customers(t):
    orders = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey"))
    customers = (
        t.customer.groupBy(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("custkey"))
        .agg(F.count(F.lit(1)).alias("n_customers"), F.min("c_name").alias("first_name"))
    )
    return orders, customers


@query("q14_null_safe_left_join", _KEYED_SQL.format(condition="k IS NOT DISTINCT FROM ck"))
def null_safe_left_join(t):
    orders, customers = _keyed_orders_and_customers(t)
    return j.left_join(orders, customers, "custkey", nulls="match", right_unique=True)


@query("q15_never_null_join", _KEYED_SQL.format(condition="k = ck"))
def never_null_join(t):
    orders, customers = _keyed_orders_and_customers(t)
    return j.left_join(orders, customers, "custkey", nulls="never", right_unique=True)


@query("q16_full_join_append", """
SELECT coalesce(nk, s_nationkey) AS nationkey, n_name, s_name, s_acctbal, 'parties' AS source
FROM (SELECT CASE WHEN n_regionkey <> 0 THEN n_nationkey END AS nk, n_name FROM nation)
FULL JOIN supplier ON nk = s_nationkey
""")
def full_join_append(t):
    nations = t.nation.select(F.when(F.col("n_regionkey") != 0, F.col("n_nationkey")).alias("nationkey"), "n_name")
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nationkey"), "s_name", "s_acctbal")
    return j.full_join(nations, suppliers, "nationkey", nulls="never").withColumn("source", F.lit("parties"))


@query("q17_natural_full_join", """
SELECT coalesce(n.regionkey, r.regionkey) AS regionkey, n_name, r_name
FROM (SELECT n_regionkey + 1 AS regionkey, n_name FROM nation) n
FULL JOIN (SELECT r_regionkey AS regionkey, r_name FROM region) r ON n.regionkey = r.regionkey
""")
def natural_full_join(t):
    nations = t.nation.select((F.col("n_regionkey") + 1).alias("regionkey"), "n_name")
    regions = t.region.select(F.col("r_regionkey").alias("regionkey"), "r_name")
    return j.full_join(nations, regions)


@query("q18_semi_join", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def semi_join(t):
    partial = t.orders.where("o_orderstatus = 'P'")
    return j.semi_join(t.customer.select("c_custkey", "c_name"), partial, [("c_custkey", "o_custkey")])


@query("q19_anti_join", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def anti_join(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    return j.anti_join(t.customer.select("c_custkey", "c_name"), urgent, [("c_custkey", "o_custkey")])


@query("q20_conflict_probe", """
SELECT p_partkey, p_brand, p_name || ' ' || p_size AS label FROM part
WHERE p_brand IN (SELECT p_brand FROM part WHERE p_type = 'PROMO')
  AND p_name || ' ' || p_size NOT IN (SELECT p_name || ' ' || p_size FROM part WHERE p_type = 'PROMO')
""")
def conflict_probe(t):
    parts = t.part.select("p_partkey", "p_brand", "p_type", F.concat_ws(" ", "p_name", "p_size").alias("label"))
    return j.conflict_probe(parts.drop("p_type"), parts.where("p_type = 'PROMO'"), "p_brand", "label")


@query("q21_join_any", """
SELECT event_id, a, b, coalesce(c1.c_name, c2.c_name) AS name, coalesce(c1.c_mktsegment, c2.c_mktsegment) AS segment,
       CASE WHEN c1.c_custkey IS NOT NULL THEN 1 WHEN c2.c_custkey IS NOT NULL THEN 2 END AS pass
FROM (SELECT event_id, CASE WHEN value < 20 THEN user_id END AS a,
             CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS b FROM events) e
LEFT JOIN customer c1 ON a = c1.c_custkey
LEFT JOIN customer c2 ON c1.c_custkey IS NULL AND b = c2.c_custkey
""")
def join_any(t):
    events = t.events.select(
        "event_id",
        F.when(F.col("value") < 20, F.col("user_id")).alias("a"),
        F.when(F.col("event_type") != "error", F.regexp_extract("props", "([0-9]+)", 1).cast("long")).alias("b"),
    )
    customers = t.customer.select(
        F.col("c_custkey").alias("a"), F.col("c_custkey").alias("b"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
    )
    return j.join_any(events, customers, ["a", "b"], pass_column="pass", right_unique=True)


@query("q22_cardinality_check", """
SELECT l_orderkey, count(*) AS n_left FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1 HAVING count(*) > 1
""")
def cardinality_check(t):
    return j.repeated_partners(t.lineitem, t.orders.where("o_orderstatus = 'F'"), [("l_orderkey", "o_orderkey")])


_SEGMENT_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'BUILDING' WHEN '2-HIGH' THEN 'MACHINERY'
     WHEN '3-MEDIUM' THEN 'HOUSEHOLD' WHEN '4-NOT SPECIFIED' THEN 'FURNITURE' ELSE 'AUTOMOBILE' END"""


@query("q23_match_cascade", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey, {_SEGMENT_SQL} AS segment FROM orders),
c AS (SELECT c_custkey, c_mktsegment, c_name FROM customer),
m AS (SELECT o_orderkey, custkey, segment, coalesce(c1.c_name, c2.c_name) AS name,
             CASE WHEN c1.c_name IS NOT NULL THEN 1 WHEN c2.c_name IS NOT NULL THEN 2 END AS pass
      FROM o LEFT JOIN c c1 ON custkey = c1.c_custkey AND segment = c1.c_mktsegment
             LEFT JOIN c c2 ON c1.c_name IS NULL AND custkey = c2.c_custkey)
SELECT * FROM m
UNION ALL
SELECT NULL, c_custkey, c_mktsegment, c_name, NULL FROM c WHERE c_name NOT IN (SELECT name FROM m WHERE name IS NOT NULL)
""")
def match_cascade(t):
    priority = F.col("o_orderpriority")
    segment = (
        F.when(priority == "1-URGENT", "BUILDING").when(priority == "2-HIGH", "MACHINERY")
        .when(priority == "3-MEDIUM", "HOUSEHOLD").when(priority == "4-NOT SPECIFIED", "FURNITURE").otherwise("AUTOMOBILE")
    )
    orders = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey"), segment.alias("segment")
    )
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return j.match_cascade(orders, customers, [["custkey", "segment"], "custkey"], "name", pass_column="pass")


@query("q39_group_size_filter", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (l_orderkey, l_partkey) IN (SELECT (l_orderkey, l_partkey) FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
""")
def group_size_filter(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return repeated_in_group(lines, ["l_orderkey"], "l_partkey")


@query("q49_multi_filter", """
SELECT o_orderkey, o_totalprice, c_name, nation FROM (
  SELECT o_orderkey, o_totalprice, c_name, o_orderpriority, o_orderstatus, c_mktsegment,
         CASE WHEN n_regionkey <> 1 THEN n_name END AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
WHERE o_orderstatus <> 'P' AND starts_with(c_name, 'Customer') AND len(c_name) = 18
  AND c_mktsegment = upper(c_mktsegment) AND o_orderpriority IN ('1-URGENT', '5-LOW')
  AND NOT coalesce(regexp_matches(nation, '_[0-9]$'), false)
  AND (nation IS NULL OR o_totalprice > 100000)
""")
def multi_filter(t):
    orders = t.orders.where(
        (F.col("o_orderstatus") != "P") & one_of(F.col("o_orderpriority"), ["1-URGENT", "5-LOW"])
    )
    joined = j.left_join(orders, t.customer, [("o_custkey", "c_custkey")], right_unique=True)
    joined = j.left_join(joined, t.nation, [("c_nationkey", "n_nationkey")], right_unique=True, hot_rows=None)
    nation = F.when(F.col("n_regionkey") != 1, F.col("n_name"))
    return joined.withColumn("nation", nation).where(
        F.startswith(F.col("c_name"), F.lit("Customer"))
        & (F.length("c_name") == 18)
        & (F.col("c_mktsegment") == F.upper("c_mktsegment"))
        & ~matches(F.col("nation"), "_[0-9]$")
        & (F.col("nation").isNull() | (F.col("o_totalprice") > 100000))
    ).select("o_orderkey", "o_totalprice", "c_name", "nation")


@query("q56_composite_key_join", """
SELECT l_orderkey, l_linenumber, ls AS status, o_orderpriority
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS ls FROM lineitem)
LEFT JOIN (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS os, o_orderpriority FROM orders)
  ON l_orderkey = o_orderkey AND ls IS NOT DISTINCT FROM os
""")
def composite_key_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("status"))
    orders = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_status"), "o_orderpriority")
    return j.left_join(lines, orders, [("l_orderkey", "o_orderkey"), ("status", "o_status")], right_unique=True)


@query("q57_natural_anti_join", """
SELECT n_nationkey AS nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey + 3 FROM supplier)
""")
def natural_anti_join(t):
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    suppliers = t.supplier.select((F.col("s_nationkey") + 3).alias("nationkey"), "s_name")
    return j.anti_join(nations, suppliers)


@query("q62_groups_with_repeats", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey IN (
  SELECT l_orderkey FROM lineitem GROUP BY 1
  HAVING count(*) <> count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_suppkey END) + max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END))
""")
def group_repeats(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("known")
    )
    return c.drop(groups_with_repeats(lines, ["l_orderkey"], "known"), ["known"])


@query("q63_membership_flag", """
SELECT l_orderkey, l_linenumber, l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') AS is_promo FROM lineitem
""")
def membership_flag(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return c.drop(j.in_column(lines, "l_partkey", t.part.where("p_type = 'PROMO'"), "p_partkey", "is_promo"), ["l_partkey"])


@query("q80_one_to_many", """
SELECT coalesce(n_nationkey, c_nationkey) AS n_nationkey, n_name, c_custkey FROM nation FULL JOIN customer ON n_nationkey = c_nationkey
""")
def one_to_many(t):
    """No customer meets two nations; the job would stop if one did."""
    nations, customers = t.nation.select("n_nationkey", "n_name"), t.customer.select("c_custkey", "c_nationkey")
    return j.full_join(nations, customers, [("n_nationkey", "c_nationkey")], one_to_many=True)
