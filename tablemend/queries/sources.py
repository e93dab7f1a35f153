"""Readers and sinks: given tables are written to the work folder as text or Parquet and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.plans.audits import Watch
from tablemend.plans.catalogue import complete
from tablemend.plans.published import AuditFailed, publish, read_published, versions
from tablemend.queries.registry import query
from tablemend.sources import delimited as d
from tablemend.sources.tables import read_table, write_table

_ORDERS_AS_TEXT = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders"


def _orders(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"), "o_custkey")


@query("q81_delimited_scan", _ORDERS_AS_TEXT)
def delimited_scan(t):
    """Numbers stay text, and NULL comes back as NULL."""
    path = t.new_folder("orders")
    write_table(_orders(t), path, fmt="csv")
    return d.read_delimited(t.spark, path)


@query("q82_quoted_line_breaks", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(concat('a "quoted", ', text, chr(10), 'last')) AS digest, lang FROM documents
""")
def quoted_line_breaks(t):
    """Whole texts with separators, quotes and line breaks inside quoted fields, read in byte ranges at the same time."""
    path = t.new_folder("texts")
    text = F.concat(F.lit('a "quoted", '), "text", F.lit("\nlast"))
    t.documents.select("doc_id", text.alias("text"), "lang").write.option("header", True).option("escape", '"').csv(path)
    read = d.read_delimited(t.spark, path, d.ReadOptions(multiline=True, split=True))
    return read.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("q83_directory_scan", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, true AS from_part FROM supplier
""")
def directory_scan(t):
    """Of a folder that also holds other files, the chosen ones, with the name of their source."""
    path = t.new_folder("suppliers")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    suppliers.where("s_suppkey % 2 = 0").write.option("header", True).csv(path)
    # The same columns in another order, and files that are no tables.
    suppliers.where("s_suppkey % 2 = 1").select("s_name", "s_suppkey").write.mode("append").option("header", True).csv(path)
    suppliers.select("s_name").write.mode("append").text(path)
    read = d.read_folder(t.spark, path, include=r"\.csv$")
    return read.select("s_suppkey", "s_name", F.col("_src").startswith("part-").alias("from_part"))


@query("q84_header_repair", "SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation")
def header_repair(t):
    """Blanks around header cells go, and a nameless column goes as a whole."""
    path = t.new_folder("nations")
    t.nation.select(F.col("n_nationkey").alias(" key "), F.col("n_name").alias("name "), F.lit("x").alias("_c2")).write.option("header", True).csv(path)
    return d.read_delimited(t.spark, path)


@query("q85_sheets", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name, CAST(r_regionkey AS VARCHAR) AS sheet FROM region")
def sheets(t):
    """One file per sheet, its name in a column."""
    path = t.new_folder("sheets")
    t.region.select("r_regionkey", "r_name").repartitionByRange(t.region.count(), "r_regionkey").write.option("header", True).csv(path)
    read = d.read_sheets(t.spark, path, "sheet", prefix="part-0000")
    return read.withColumn("sheet", F.substring_index("sheet", "-", 1))


@query("q86_stored_vocabulary", """
WITH v AS (SELECT p_brand, CASE WHEN min(p_type) = max(p_type) THEN min(p_type) END AS t FROM part WHERE p_size < 3 GROUP BY 1)
SELECT p_partkey, p.p_brand, coalesce(CASE WHEN p_size >= 3 THEN p_type END, t) AS p_type FROM part p LEFT JOIN v ON p.p_brand = v.p_brand
""")
def stored_vocabulary(t):
    """A vocabulary is written once, read as a table, and completes another."""
    path = t.new_folder("vocabulary")
    write_table(t.part.where("p_size < 3").select("p_brand", "p_type"), path)
    parts = t.part.select("p_partkey", "p_brand", F.when(F.col("p_size") >= 3, F.col("p_type")).alias("p_type"))
    return complete(parts, read_table(t.spark, path), ["p_brand"], ["p_type"])


@query("q87_partitioned_sink", """
SELECT o_orderstatus, o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'
""")
def partitioned_sink(t):
    """Stored by a column; a filter on it reads only its folders."""
    path = t.new_folder("sink")
    write_table(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), path, ["o_orderstatus"])
    return read_table(t.spark, path).where("o_orderstatus <> 'O'")


@query("q88_published_table", """
SELECT 1 AS version, count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS null_priority, sum(o_custkey) AS custkeys FROM orders
""")
def published_table(t):
    """Halves are watched while they are united and written; a version that fails its audit stays unseen."""
    path = t.new_folder("published")
    watch = Watch()
    halves = [watch.on(_orders(t).where(f"o_orderkey % 2 = {i}"), f"half{i}") for i in range(2)]
    publish(halves[0].unionByName(halves[1]), path, never={"no key": F.col("o_orderkey").isNull()}, watch=watch, conserves=["half0", "half1"])
    try:
        publish(_orders(t).limit(5), path, never={"any row": F.lit(True)})
    except AuditFailed:
        pass
    seen = versions(t.spark, path).select("version", "n_rows", F.col("metrics")["null:o_orderpriority"].alias("null_priority"))
    summed = read_published(t.spark, path).agg(F.sum("o_custkey").alias("custkeys"), F.lit(1).cast("long").alias("version"))
    return summed.join(seen, "version").select("version", "n_rows", "null_priority", "custkeys")
