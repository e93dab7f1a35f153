"""Items that share any identifier, and corrections folded into logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.operators.identity import resolve, shared_identifiers
from tablemend.operators.rows import apply_corrections
from tablemend.plans.catalogue import standardise_names
from tablemend.queries.registry import query

_IDENTIFIERS = ["heavy_cust", ["light_day", "light_priority"], "urgent_cust"]

_IDENTITY_SQL = """
x AS (SELECT o_orderkey, o_orderpriority, o_orderstatus,
             CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'F' THEN o_custkey END AS heavy_cust,
             CASE WHEN o_totalprice < 60000 AND o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS light_day,
             CASE WHEN o_totalprice < 60000 THEN o_orderpriority END AS light_priority,
             CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0 THEN o_custkey END AS urgent_cust FROM orders),
i AS (SELECT o_orderkey, '0heavy_cust=' || heavy_cust AS ident FROM x WHERE heavy_cust IS NOT NULL
      UNION SELECT o_orderkey, '1light_day+light_priority=' || light_day || '|' || light_priority FROM x WHERE light_day IS NOT NULL
      UNION SELECT o_orderkey, '2urgent_cust=' || urgent_cust FROM x WHERE urgent_cust IS NOT NULL),
e AS (SELECT DISTINCT p.ident AS u, q.ident AS v FROM i p JOIN i q ON p.o_orderkey = q.o_orderkey),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
m AS (SELECT u, min(v) AS name FROM r GROUP BY 1),
d AS (SELECT x.o_orderkey, x.o_orderpriority, x.o_orderstatus, substr(min(name), 2) AS identity
      FROM x LEFT JOIN i ON x.o_orderkey = i.o_orderkey LEFT JOIN m ON ident = u GROUP BY 1, 2, 3)
"""


def _orders(t):
    t.with_work_folder()
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey", "o_orderpriority", "o_orderstatus",
        F.when((price > 300000) & (status == "F"), F.col("o_custkey")).alias("heavy_cust"),
        F.when((price < 60000) & (status != "P"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("light_day"),
        F.when(price < 60000, F.col("o_orderpriority")).alias("light_priority"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 3 == 0), F.col("o_custkey")).alias("urgent_cust"),
    )


@query("q89_linked_identities", f"WITH RECURSIVE {_IDENTITY_SQL} SELECT o_orderkey, identity FROM d")
def linked_identities(t):
    """Orders that share an identifier of any kind, directly or over others, have one identity."""
    return resolve(_orders(t), _IDENTIFIERS).select("o_orderkey", "identity")


@query("q90_linked_standard_names", f"""
WITH RECURSIVE {_IDENTITY_SQL},
el AS (SELECT identity, name FROM (
         SELECT identity, o_orderpriority AS name, row_number() OVER (PARTITION BY identity ORDER BY count(*) DESC, o_orderpriority) AS rn
         FROM d WHERE identity IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
s AS (SELECT d.*, el.name AS std FROM d LEFT JOIN el ON d.identity = el.identity),
p AS (SELECT o_orderpriority, o_orderstatus, std FROM (
        SELECT o_orderpriority, o_orderstatus, std, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY count(*) DESC, std) AS rn
        FROM s WHERE std IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1)
SELECT o_orderkey, s.o_orderpriority AS "Antigen", s.o_orderstatus AS "Study", coalesce(s.std, p.std) AS "Antigen_std"
FROM s LEFT JOIN p ON s.o_orderpriority = p.o_orderpriority AND s.o_orderstatus = p.o_orderstatus
""")
def linked_standard_names(t):
    """One standard name for each group of linked orders."""
    named = _orders(t).withColumnsRenamed({"o_orderpriority": "Antigen", "o_orderstatus": "Study"})
    return standardise_names(named, _IDENTIFIERS, linked=True).select("o_orderkey", "Antigen", "Study", "Antigen_std")


@query("q91_shared_identifiers", """
WITH x AS (SELECT DISTINCT p_name, p_brand, p_type FROM part)
SELECT 'p_name=' || p_name AS identifier, count(*) AS n_items, (SELECT count(*) FROM part q WHERE q.p_name = x.p_name) AS n_rows
FROM x GROUP BY p_name HAVING count(*) > 2
UNION ALL
SELECT 'p_brand+p_type=' || p_brand || '|' || p_type, count(*), (SELECT count(*) FROM part q WHERE q.p_brand = x.p_brand AND q.p_type = x.p_type)
FROM x GROUP BY p_brand, p_type HAVING count(*) > 2
""")
def overshared(t):
    """Identifiers that too many different items hold to say anything."""
    return shared_identifiers(t.part, ["p_name", ["p_brand", "p_type"]], 2)


@query("q92_folded_corrections", """
WITH b AS (SELECT p_brand, max(p_type) AS t FROM part GROUP BY 1 HAVING count(*) % 2 = 0),
z AS (SELECT p_size, min(p_name) AS n FROM part WHERE p_size < 20 GROUP BY 1)
SELECT p_partkey, x.p_brand, x.p_size, coalesce(z.n, p_name) AS p_name,
       CASE WHEN x.p_brand LIKE '%2' THEN NULL WHEN x.p_brand LIKE '%1' THEN 'LAST' WHEN b.p_brand IS NOT NULL THEN b.t ELSE p_type END AS p_type,
       CASE WHEN x.p_brand NOT LIKE '%2' AND CASE WHEN x.p_brand LIKE '%1' THEN 'LAST' WHEN b.p_brand IS NOT NULL THEN b.t ELSE p_type END = 'LAST'
            THEN 0.0 ELSE p_retailprice END AS p_retailprice
FROM part x LEFT JOIN b ON x.p_brand = b.p_brand LEFT JOIN z ON x.p_size = z.p_size
""")
def folded_corrections(t):
    """Five corrections with three key sets; those of one key become one log, and the last reads what the others wrote."""
    brands = t.part.groupBy("p_brand").agg(F.max("p_type").alias("p_type"), F.count(F.lit(1)).alias("n")).where("n % 2 = 0").drop("n")
    sizes = t.part.where("p_size < 20").groupBy("p_size").agg(F.min("p_name").alias("p_name"))
    listed = t.part.select("p_brand").distinct()
    last = listed.where("p_brand LIKE '%1'").withColumn("p_type", F.lit("LAST"))
    unknown = listed.where("p_brand LIKE '%2'").withColumn("p_type", F.lit(None).cast("string"))
    free = last.select("p_type").distinct().withColumn("p_retailprice", F.lit(0.0))
    log = [(brands, ["p_brand"]), (sizes, ["p_size"]), (last, ["p_brand"]), (unknown, ["p_brand"]), (free, ["p_type"])]
    return apply_corrections(t.part, log).select("p_partkey", "p_brand", "p_size", "p_name", "p_type", "p_retailprice")
