"""Union of sources and projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.functions.nulls import paste
from tablemend.operators import columns as c
from tablemend.operators.aggregates import null_census
from tablemend.operators.sets import union_sources
from tablemend.plans.audits import row_conservation
from tablemend.queries.registry import Tables, query
from tablemend.sources.delimited import source_name
from tablemend.sources.tables import names_to_rows


def _parties(t: Tables):
    customer = c.rename(t.customer, {"party": "c_name", "nation": "c_nationkey", "balance": "c_acctbal", "segment": "c_mktsegment"})
    supplier = c.rename(t.supplier, {"party": "s_name", "nation": "s_nationkey", "balance": "s_acctbal"})
    return (
        c.drop(customer, ["c_custkey"]).withColumn("source", F.lit("customer")),
        c.drop(supplier, ["s_suppkey"]).withColumn("source", F.lit("supplier")),
    )


@query("q01_unify_parties", """
SELECT c_name AS party, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL
SELECT s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier
""")
def unify_parties(t):
    return union_sources(_parties(t))


@query("q02_unify_count_audit", """
SELECT n_parts, n_whole, n_parts = n_whole AS conserved FROM (
  SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n_parts,
         (SELECT count(*) FROM (SELECT c_name FROM customer UNION ALL SELECT s_name FROM supplier)) AS n_whole)
""")
def unify_count_audit(t):
    parts = _parties(t)
    return row_conservation(parts, union_sources(parts))


@query("q36_null_census", """
SELECT count(*) FILTER (WHERE event_type = 'view') AS event_type,
       count(*) FILTER (WHERE value > 100) AS value,
       0::BIGINT AS user_id
FROM events
""")
def null_census_events(t):
    events = t.events.select(
        "user_id",
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
    )
    return null_census(events)


@query("q50_unpivot_observed", r"""
SELECT DISTINCT conv_id, word FROM (
  SELECT conv_id, unnest(string_split_regex(text, '[ \n]+')) AS word FROM conversations)
""")
def unpivot_observed(t):
    words = t.conversations.select("conv_id", F.split("text", r"[ \n]+").alias("words"))
    return names_to_rows(words, ["conv_id"], "words", "word")


@query("q52_spec_projection", """
SELECT 'S-' || replace(s_name, 'Supplier#', '') AS code,
       coalesce(nullif(CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE '/' END, '/'), 'plain') AS class,
       CAST(s_nationkey AS VARCHAR) AS nation,
       round(s_acctbal * 10) AS balance_tenfold
FROM supplier
""")
def spec_projection(t):
    renamed = c.rename(t.supplier, {"name": "s_name", "nation": "s_nationkey", "balance": "s_acctbal"})
    # Each step reads the one before it.
    derived = c.derive(renamed, [
        ("code", F.regexp_replace("name", "^Supplier#", "")),
        ("code", F.concat(F.lit("S-"), F.col("code"))),
        ("class", F.when(F.col("balance") > 5000, "rich").otherwise("/")),
        ("class", F.nullif("class", F.lit("/"))),
        ("class", F.coalesce("class", F.lit("plain"))),
        ("balance_tenfold", F.round(F.col("balance") * 10)),
    ])
    texts = c.across(derived, lambda x: x.cast("string"), names=["nation"])
    kept = c.drop_matching(c.drop(texts, ["s_suppkey"]), "^(name|balance)$")
    return c.relocate(kept, ["code", "class"])


@query("q53_row_id_paste", """
SELECT n_nationkey, coalesce(name, 'NA') || '__' || coalesce(region, 'NA') AS id, name || '__' || region AS strict_id
FROM (SELECT n_nationkey, n_name AS name, nullif(r_name, 'ASIA') AS region
      FROM nation JOIN region ON n_regionkey = r_regionkey)
""")
def row_id_paste(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("name"), F.nullif("r_name", F.lit("ASIA")).alias("region")
    )
    with_id = c.add_row_id(nations, ["name", "region"], "id")
    strict = paste(F.col("name"), F.col("region"), sep="__", null_text=None)
    return with_id.select("n_nationkey", "id", strict.alias("strict_id"))


@query("q69_select_by_pattern", """
SELECT l_orderkey AS "ORDERKEY", l_partkey AS "PARTKEY", l_suppkey AS "SUPPKEY" FROM lineitem
""")
def select_by_pattern(t):
    keys = c.keep_matching(t.lineitem, "key$")
    return c.rename_with(keys, lambda name: name.removeprefix("l_").upper())


@query("q70_rows_per_source", """
SELECT 'customer' AS source, count(*) AS n, count(DISTINCT c_nationkey) AS n_nations FROM customer
UNION ALL SELECT 'supplier', count(*), count(DISTINCT s_nationkey) FROM supplier
""")
def rows_per_source(t):
    # The source is the file a row was read from.
    source = source_name(F.col("_metadata.file_name")).alias("source")
    files = [t.customer.select(F.col("c_nationkey").alias("nation"), source), t.supplier.select(F.col("s_nationkey").alias("nation"), source)]
    return union_sources(files).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("nation").alias("n_nations"))
