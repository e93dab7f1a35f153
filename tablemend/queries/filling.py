"""Fill missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.operators.fill import fill_by_group, fill_down
from tablemend.operators.joins import left_join
from tablemend.plans.catalogue import fill_from_peers
from tablemend.queries.registry import query


@query("q41_fill_down", """
SELECT event_id, user_id, ts, last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value
FROM (SELECT *, CASE WHEN event_type NOT IN ('view', 'error') THEN value END AS known FROM events)
""")
def fill_down_events(t):
    events = t.events.select(
        "event_id", "user_id", "ts", F.when(~F.col("event_type").isin("view", "error"), F.col("value")).alias("value")
    )
    return fill_down(events, ["value"], ["user_id"], ["ts", "event_id"])


@query("q58_grouped_fill", """
SELECT event_id, user_id, event_type, last_value(known IGNORE NULLS) OVER w AS value, last_value(big IGNORE NULLS) OVER w AS props
FROM (SELECT *, CASE WHEN value < 50 THEN value END AS known, CASE WHEN value > 60 THEN props END AS big FROM events)
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
""")
def grouped_fill(t):
    value = F.col("value")
    events = t.events.select(
        "event_id", "user_id", "event_type", "ts",
        F.when(value > 60, F.col("props")).alias("props"), F.when(value < 50, value).alias("value"),
    )
    filled = fill_down(events, ["value", "props"], ["user_id", "event_type"], ["ts", "event_id"])
    return filled.drop("ts")


@query("q42_fill_by_group", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN p_brand END AS brand,
                  CASE WHEN l_returnflag = 'A' THEN l_suppkey END AS suppkey
           FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT l_partkey, min(brand) AS b, max(brand) AS b2, min(suppkey) AS s, max(suppkey) AS s2 FROM x GROUP BY 1)
SELECT l_orderkey, l_linenumber, x.l_partkey, coalesce(brand, CASE WHEN b = b2 THEN b END) AS brand,
       coalesce(suppkey, CASE WHEN s = s2 THEN s END) AS suppkey
FROM x JOIN g ON x.l_partkey = g.l_partkey
""")
def fill_by_group_parts(t):
    lines = left_join(t.lineitem, t.part.select("p_partkey", "p_brand"), [("l_partkey", "p_partkey")], right_unique=True).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.col("p_brand")).alias("brand"),
        F.when(F.col("l_returnflag") == "A", F.col("l_suppkey")).alias("suppkey"),
    )
    return fill_by_group(lines, ["l_partkey"], ["brand", "suppkey"])


@query("q43_fill_chain", """
WITH x AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
                  CASE WHEN o_totalprice > 350000 THEN o_orderpriority END AS priority,
                  CASE WHEN o_totalprice < 100000 THEN 'day-' || o_orderpriority END AS tag FROM orders),
r AS (SELECT * FROM x WHERE o_orderstatus <> 'P'),
g1 AS (SELECT o_custkey, min(priority) AS lo, max(priority) AS hi FROM r GROUP BY 1),
f1 AS (SELECT o_orderkey, r.o_custkey, o_orderstatus, o_orderdate, coalesce(priority, CASE WHEN lo = hi THEN lo END) AS priority, tag
       FROM r JOIN g1 ON r.o_custkey = g1.o_custkey),
g2 AS (SELECT o_orderdate, priority, min(tag) AS lo, max(tag) AS hi FROM f1 WHERE priority IS NOT NULL GROUP BY 1, 2),
f2 AS (SELECT o_orderkey, o_custkey, o_orderstatus, f1.o_orderdate, f1.priority, coalesce(tag, CASE WHEN lo = hi THEN lo END) AS tag
       FROM f1 LEFT JOIN g2 ON f1.o_orderdate = g2.o_orderdate AND f1.priority = g2.priority)
SELECT * FROM f2 UNION ALL SELECT * FROM x WHERE o_orderstatus = 'P'
""")
def fill_chain(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        F.when(price > 350000, priority).alias("priority"),
        F.when(price < 100000, F.concat(F.lit("day-"), priority)).alias("tag"),
    )
    rules = [(["o_custkey"], ["priority"]), (["o_orderdate", "priority"], ["tag"])]
    return fill_from_peers(orders, rules, held_out=F.col("o_orderstatus") == "P")
