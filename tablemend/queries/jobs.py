"""Whole curation jobs over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.functions import text as x
from tablemend.functions.nulls import matches
from tablemend.operators import columns as c
from tablemend.operators.fill import fill_down
from tablemend.operators.sets import union_sources
from tablemend.plans import audits
from tablemend.plans import catalogue as cat
from tablemend.plans.incremental import read_sources, reconcile_changed
from tablemend.plans.reconcile import (
    NameRule,
    accession_list,
    accession_of_file,
    merge_indistinct,
    observed_names,
    reconcile,
    unmatched_keys,
)
from tablemend.plans.spec import SourceSpec, Split, harmonise
from tablemend.queries.registry import query


@query("q44_alias_lookup", """
WITH n AS (SELECT DISTINCT p_name FROM part WHERE NOT regexp_matches(p_name, 'ring$')),
d AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS value FROM part WHERE p_type <> 'PROMO'
      UNION SELECT DISTINCT split_part(p_name, ' ', 2) FROM part WHERE p_size > 25),
h AS (SELECT DISTINCT p_name, 'W:' || upper(value) AS code, CASE WHEN len(value) > 3 THEN value END AS long_value
      FROM n JOIN d ON value IN (split_part(p_name, ' ', 1), split_part(p_name, ' ', 2))),
f AS (SELECT p_name, string_agg(DISTINCT code, ', ' ORDER BY code) AS code,
             nullif(string_agg(DISTINCT coalesce(long_value, 'NA'), ', ' ORDER BY coalesce(long_value, 'NA')), 'NA') AS long_value
      FROM h GROUP BY 1)
SELECT p_partkey, p.p_name, regexp_matches(p.p_name, 'ring$') AS control, code, long_value FROM part p LEFT JOIN f ON p.p_name = f.p_name
""")
def alias_lookup(t):
    part = t.part.select("p_partkey", "p_name", F.col("p_name").rlike("ring$").alias("control"))
    word = F.split("p_name", " ")
    words = union_sources([
        t.part.where("p_type <> 'PROMO'").select(word[0].alias("value")),
        t.part.where("p_size > 25").select(word[1].alias("value")),
    ]).distinct()
    aliases = words.select(
        "value", F.concat(F.lit("W:"), F.upper("value")).alias("code"), F.when(F.length("value") > 3, F.col("value")).alias("long_value")
    )

    def single_words(name):
        parts = F.split(name, " ")
        return [name, F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))]

    return cat.annotate(part, aliases, "p_name", "control", ["code", "long_value"], single_words)


@query("q45_vocab_enrich", """
WITH vb AS (SELECT p_size, CASE WHEN min(p_brand) = max(p_brand) THEN min(p_brand) END AS brand,
                   CASE WHEN min(p_type) = max(p_type) THEN min(p_type) END AS type FROM part GROUP BY 1)
SELECT l_orderkey, l_linenumber, code_a, code_b,
       coalesce(own, CASE WHEN p.p_partkey IS NOT NULL THEN p.p_brand ELSE vb.brand END) AS brand,
       CASE WHEN p.p_partkey IS NOT NULL THEN p.p_type ELSE vb.type END AS type
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_partkey END AS code_a,
             CAST(l_quantity AS BIGINT) AS code_b, CASE WHEN l_linestatus = 'O' THEN 'own' END AS own FROM lineitem) l
LEFT JOIN part p ON code_a = p.p_partkey
LEFT JOIN vb ON p.p_partkey IS NULL AND code_b = vb.p_size
""")
def vocab_enrich(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.col("l_partkey")).alias("code_a"),
        F.col("l_quantity").cast("long").alias("code_b"),
        F.when(F.col("l_linestatus") == "O", "own").alias("brand"),
    )
    vocabulary = t.part.select(
        F.col("p_partkey").alias("code_a"), F.col("p_size").cast("long").alias("code_b"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
    )
    return cat.enrich(lines, vocabulary, ["code_a", "code_b"], ["brand", "type"])


@query("q68_complete_vocabulary", """
WITH v AS (SELECT p_name, p_size, CASE WHEN min(p_brand) = max(p_brand) THEN min(p_brand) END AS b FROM part GROUP BY 1, 2)
SELECT p_partkey, p.p_name, p.p_size, coalesce(CASE WHEN p_type = 'PROMO' THEN p_brand END, b) AS p_brand
FROM part p JOIN v ON p.p_name = v.p_name AND p.p_size = v.p_size
""")
def complete_vocabulary(t):
    known = F.when(F.col("p_type") == "PROMO", F.col("p_brand"))
    parts = t.part.select("p_partkey", "p_name", "p_size", known.alias("p_brand"))
    return cat.complete(parts, t.part, ["p_name", "p_size"], ["p_brand"])


def _renderings(t):
    part = t.part
    study = F.when(F.col("p_type").isin("PROMO", "SMALL", "LARGE"), "upper").otherwise("dotted")
    catalogue = part.select("p_partkey", study.alias("Study"), F.concat_ws(" ", "p_name", "p_brand").alias("Antigen"))
    loud = F.upper(F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), "p_brand"))
    dotted = F.concat_ws(".", F.replace("p_name", F.lit(" "), F.lit(".")), "p_brand", F.lit("1"))
    is_loud = F.col("p_size") <= 25
    observed = part.select(
        F.when(is_loud, "upper").otherwise("dotted").alias("Study"), F.when(is_loud, loud).otherwise(dotted).alias("Data_Name")
    )
    rules = {
        "upper": NameRule(
            keys=[(lambda: F.lower("Antigen"), lambda: F.lower(F.replace("Data_Name", F.lit("_"), F.lit(" "))))], append="key"
        ),
        "dotted": NameRule(
            keys=[(lambda: F.col("Antigen"), lambda: F.replace(x.gsub(F.col("Data_Name"), r"\.1$", ""), F.lit("."), F.lit(" ")))],
            append="key",
        ),
    }
    return catalogue, observed, rules


def _two_renderings(t):
    catalogue, observed, rules = _renderings(t)
    return catalogue, reconcile(catalogue, observed, rules)


_RECONCILE_SQL = """
c AS (SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN 'upper' ELSE 'dotted' END AS study,
             p_name || ' ' || p_brand AS antigen FROM part),
o AS (SELECT DISTINCT CASE WHEN p_size <= 25 THEN 'upper' ELSE 'dotted' END AS study,
             CASE WHEN p_size <= 25 THEN lower(p_name || ' ' || p_brand) ELSE p_name || ' ' || p_brand END AS k,
             CASE WHEN p_size <= 25 THEN upper(replace(p_name, ' ', '_') || '_' || p_brand)
                  ELSE replace(p_name, ' ', '.') || '.' || p_brand || '.1' END AS data_name FROM part),
r AS (SELECT p_partkey, coalesce(c.study, o.study) AS study, coalesce(antigen, k) AS antigen, data_name
      FROM c FULL JOIN o ON c.study = o.study AND CASE WHEN c.study = 'upper' THEN lower(antigen) ELSE antigen END = k)
"""


@query("q46_reconcile_names", f"""WITH {_RECONCILE_SQL}
SELECT p_partkey, study AS "Study", antigen AS "Antigen", data_name AS "Data_Name" FROM r
""")
def reconcile_names(t):
    return _two_renderings(t)[1]


@query("q71_unmatched_keys", """
WITH c AS (SELECT DISTINCT CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN 'upper' ELSE 'dotted' END AS study,
                  CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN lower(p_name || ' ' || p_brand) ELSE p_name || ' ' || p_brand END AS k FROM part),
o AS (SELECT DISTINCT CASE WHEN p_size <= 25 THEN 'upper' ELSE 'dotted' END AS study,
             CASE WHEN p_size <= 25 THEN lower(p_name || ' ' || p_brand) ELSE p_name || ' ' || p_brand END AS k FROM part)
SELECT study AS "Study", k AS key, 'left' AS side FROM (SELECT * FROM c EXCEPT SELECT * FROM o)
UNION ALL SELECT study, k, 'right' FROM (SELECT * FROM o EXCEPT SELECT * FROM c)
""")
def unmatched_names(t):
    return unmatched_keys(*_renderings(t))


@query("q72_observed_names", """
SELECT d.lang AS "Study", d.source AS "Data_Name", d.file FROM (
  SELECT DISTINCT 'L_' || lang AS lang, source, 'data/features_L' || lang || '-' || source || '.rds' AS file FROM documents) d
""")
def names_by_accession(t):
    seen = t.documents.select(
        F.concat(F.lit("data/features_L"), "lang", F.lit("-"), "source", F.lit(".rds")).alias("file"), F.col("source").alias("data_name")
    ).distinct()
    names = seen.withColumn("accession", accession_of_file(F.col("file")))
    # Without an accession a paper goes by its name without underscores.
    papers = t.documents.select(F.concat(F.lit("L_"), "lang").alias("Name"), F.lit(None).cast("string").alias("Accession")).distinct()
    return observed_names(names, accession_list(papers)).select("Study", "Data_Name", "file")


@query("q73_merge_indistinct", """
WITH x AS (SELECT p_brand AS study, p_name AS antigen, p_type, count(*) OVER (PARTITION BY p_brand, p_name) AS n FROM part)
SELECT DISTINCT study AS "Study", antigen AS "Antigen", CASE WHEN n = 1 THEN p_type END AS "Clone" FROM x WHERE study = 'Brand#7'
UNION ALL SELECT study, antigen, p_type FROM x WHERE study <> 'Brand#7'
""")
def indistinct_items(t):
    parts = t.part.select(F.col("p_brand").alias("Study"), F.col("p_name").alias("Antigen"), F.col("p_type").alias("Clone"))
    return merge_indistinct(parts, "Brand#7", ["Clone"])


@query("q65_merge_back", f"""WITH {_RECONCILE_SQL},
u AS (SELECT p_partkey, study, antigen, data_name FROM r WHERE study = 'upper'),
m AS (SELECT * FROM u UNION ALL
      SELECT p_partkey, study, antigen, NULL FROM c WHERE p_partkey NOT IN (SELECT p_partkey FROM u WHERE p_partkey IS NOT NULL))
SELECT p_partkey, study AS "Study", antigen AS "Antigen", data_name AS "Data_Name", antigen || '__' || study AS "ID" FROM m
""")
def merge_back(t):
    catalogue, reconciled = _two_renderings(t)
    return cat.merge_back(catalogue, [reconciled.where("Study = 'upper'")], ["p_partkey"])


@query("q47_standardise_names", """
WITH x AS (SELECT p_partkey, p_name AS antigen, p_brand AS study, CASE WHEN p_type <> 'PROMO' THEN p_size END AS identity FROM part),
e AS (SELECT identity, antigen AS std FROM (
        SELECT identity, antigen, row_number() OVER (PARTITION BY identity ORDER BY count(*) DESC, antigen) AS rn
        FROM x WHERE identity IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
s AS (SELECT x.*, std FROM x LEFT JOIN e ON x.identity = e.identity),
p AS (SELECT antigen, study, std FROM (
        SELECT antigen, study, std, row_number() OVER (PARTITION BY antigen, study ORDER BY count(*) DESC, std) AS rn
        FROM s WHERE std IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1)
SELECT p_partkey, s.antigen AS "Antigen", s.study AS "Study", identity, coalesce(s.std, p.std) AS "Antigen_std"
FROM s LEFT JOIN p ON s.antigen = p.antigen AND s.study = p.study
""")
def standardise_names(t):
    identity = F.when(F.col("p_type") != "PROMO", F.col("p_size"))
    parts = t.part.select("p_partkey", F.col("p_name").alias("Antigen"), F.col("p_brand").alias("Study"), identity.alias("identity"))
    return cat.standardise_names(parts, ["identity"])


@query("q48_registry_extract", r"""
SELECT page_id AS "RRID", CASE WHEN url LIKE 'https%' THEN 'Mouse' ELSE '' END AS "Species",
       regexp_extract(url, '://([^/]+)', 1) AS "Antigen", regexp_extract(url, '/([0-9]+)', 1) AS "Clone"
FROM pages WHERE url NOT LIKE '%?%'
""")
def registry_extract(t):
    url = F.col("url")
    name = F.concat(
        F.when(url.startswith("https"), "Mouse  Anti-Human ").otherwise("Anti-Human "),
        F.regexp_extract(url, "://([^/]+)", 1),
        F.when(url.contains("?"), " Polyclonal").otherwise(" Monoclonal"),
        F.lit(" Antibody, Clone "),
        F.when(url.contains("#"), "Clone ").otherwise(""),
        F.regexp_extract(url, "/([0-9]+)", 1),
    )
    # Entries that begin with the marker name no species.
    pages = t.pages.select(F.col("page_id").alias("id"), F.concat(F.lit(" "), name).alias("ab_name"), F.lit("x").alias("defining_citation"))
    return cat.registry_extract(pages, renames={"RRID": "id"})


@query("q51_keep_rule_sorted", """
SELECT s_suppkey, s_name, reactivity AS "Reactivity", control AS "Isotype_Control" FROM (
  SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 6000 THEN 'Human/Mouse' WHEN s_acctbal > 3000 THEN 'mouse' END AS reactivity,
         n_regionkey = 0 AS control FROM supplier JOIN nation ON s_nationkey = n_nationkey)
WHERE reactivity IS NULL OR regexp_matches(reactivity, '[Hh]uman') OR control
""")
def keep_rule_sorted(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    balance = F.col("s_acctbal")
    listed = joined.select(
        "s_suppkey", "s_name",
        F.when(balance > 6000, "Human/Mouse").when(balance > 3000, "mouse").alias("Reactivity"),
        (F.col("n_regionkey") == 0).alias("Isotype_Control"),
    )
    return cat.sorted_for_output(cat.keep_species(listed), ["Reactivity", "s_name"], ["s_name"])


_CUSTOMERS = SourceSpec(
    label="customers",
    source="customer",
    rename={"name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal", "segment": "c_mktsegment"},
    split=[Split("name", ("kind", "number"), "#")],
    derive=lambda: [("number", F.regexp_replace("number", "^0+", "")), ("number", x.pad_left(F.col("number"), 4))],
    keep=["kind", "number", "nation", "balance", "segment", "Study"],
)
_SUPPLIERS = SourceSpec(
    label="suppliers",
    source="supplier",
    rename={"name": "s_name", "nation": "s_nationkey", "balance": "s_acctbal"},
    split=[Split("name", ("kind", "number"), "#")],
    derive=lambda: [("number", F.regexp_replace("number", "^0+", "")), ("number", x.pad_left(F.col("number"), 4))],
    constants={"Vendor": "yes"},
    drop=["s_suppkey"],
)


@query("q59_harmonise_correct", """
WITH u AS (
  SELECT 'Customer' AS kind, CAST(c_custkey AS VARCHAR) AS k, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
         'customers' AS study, NULL AS vendor FROM customer
  UNION ALL SELECT 'Supplier', CAST(s_suppkey AS VARCHAR), s_nationkey, s_acctbal, NULL, 'suppliers', 'yes' FROM supplier),
b AS (SELECT study, nation, max(balance) AS top FROM u GROUP BY 1, 2),
u1 AS (SELECT kind, CASE WHEN k = '0' THEN '0000' WHEN len(k) < 4 THEN lpad(k, 4, '0') ELSE k END AS number, u.nation,
              b.top AS balance, segment, u.study, vendor
       FROM u JOIN b ON u.study = b.study AND u.nation = b.nation),
s AS (SELECT nation, min(c_mktsegment) AS seg FROM (SELECT c_nationkey AS nation, c_mktsegment FROM customer) GROUP BY 1)
SELECT kind, number, u1.nation, balance, CASE WHEN study = 'suppliers' AND s.nation IS NOT NULL THEN s.seg ELSE segment END AS segment,
       study AS "Study", vendor AS "Vendor"
FROM u1 LEFT JOIN s ON u1.nation = s.nation
""")
def harmonise_correct(t):
    parties = union_sources([harmonise(t.customer, _CUSTOMERS), harmonise(t.supplier, _SUPPLIERS)])
    top = parties.groupBy("Study", "nation").agg(F.max("balance").alias("balance"))
    segments = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.min("c_mktsegment").alias("segment"))
    segments = segments.withColumn("Study", F.lit("suppliers"))
    return cat.correct(parties, [(top, ["Study", "nation"]), (segments, ["Study", "nation"])])


@query("q66_unify_clean", """
WITH x AS (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS s, CAST(o_orderkey AS VARCHAR) AS k FROM orders)
SELECT o_orderkey, 'orders' AS "Study",
       CASE s WHEN 'F' THEN 'Mouse IgG1 k' WHEN 'O' THEN 'CD4 b' ELSE 'Arm Ham' END AS "Antigen",
       CASE p WHEN '1-URGENT' THEN k WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN 'custom made (similar to ' || k || ')'
              WHEN '4-NOT SPECIFIED' THEN 'custom made' ELSE CASE WHEN s = 'O' THEN 'A/' || k ELSE 'ERROR' END END AS "Cat_Number",
       CASE s WHEN 'F' THEN 'BioLegend' WHEN 'O' THEN 'R&D Systems' ELSE 'BD' END AS "Vendor",
       CASE p WHEN '1-URGENT' THEN '5E10' WHEN '2-HIGH' THEN '10E2' ELSE 'HI30' END AS "Clone",
       CASE p WHEN '1-URGENT' THEN 'human/mouse' ELSE CASE s WHEN 'F' THEN 'mouse' WHEN 'P' THEN 'armenian hamster' END END AS "Reactivity",
       CASE p WHEN '2-HIGH' THEN 'IgG1' WHEN '1-URGENT' THEN 'IgG2a' END AS "Isotype",
       CASE p WHEN '2-HIGH' THEN 'Mouse' END AS "Origin_Species",
       s <> 'O' AS "Isotype_Control"
FROM x
""")
def unify_clean(t):
    return c.keep(_order_catalogue(t), [
        "o_orderkey", "Study", "Antigen", "Cat_Number", "Vendor", "Clone", "Reactivity", "Isotype", "Origin_Species", "Isotype_Control"
    ])


@query("q67_catalogue_audits", """
SELECT 'unclassified number' AS audit, 'orders' AS "Study", count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'O'
UNION ALL
SELECT 'no clone name', 'orders', count(*) FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderpriority <> '2-HIGH'
UNION ALL
SELECT 'unannotated', 'orders', count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '3-MEDIUM'
""")
def catalogue_audits(t):
    orders = _order_catalogue(t).withColumn("ALT_ID", F.when(F.col("Cat_Number").startswith("custom made ("), "known"))
    return audits.count_conditions(orders, {
        "unclassified number": audits.is_sentinel(),
        "no clone name": ~matches(F.col("Clone"), "^[0-9]+E"),
        "unannotated": audits.is_unannotated(),
    })


def _order_catalogue(t):
    p, s, k = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    raw = t.orders.select(
        "o_orderkey",
        F.lit("orders").alias("Study"),
        F.when(s == "F", "Mouse  IgG1 κ").when(s == "O", " CD4 β").otherwise("Arm Ham").alias("Antigen"),
        F.when(p == "1-URGENT", k).when(p == "2-HIGH", "N/A").when(p == "3-MEDIUM", F.concat(F.lit("*"), k, F.lit(" x")))
        .when(p == "4-NOT SPECIFIED", "N/A (Custom Order)").otherwise(F.concat(F.lit("A/"), k)).alias("Cat_Number"),
        F.when(s == "F", "Biolegend").when(s == "O", "R&D Systems").otherwise("BD").alias("Vendor"),
        F.when(p == "1-URGENT", "5E+10").when(p == "2-HIGH", "1000").otherwise("HI30").alias("Clone"),
        F.when(p == "1-URGENT", "Human, Mouse").when(p == "2-HIGH", "n/a").alias("Reactivity"),
        F.when(p == "2-HIGH", "Mouse IgG1").when(p == "1-URGENT", "IgG2a").alias("Isotype"),
    )
    halves = [raw.where(s == "F"), raw.where(s != "F")]
    return cat.unify(halves)


@query("q74_shared_names", """
WITH c AS (SELECT p_partkey, CASE WHEN p_size <= 25 THEN 'a' ELSE 'b' END AS study, p_name, p_type FROM part),
o AS (SELECT DISTINCT study, p_name, p_type FROM part CROSS JOIN (VALUES ('a'), ('b')) v(study))
SELECT p_partkey, coalesce(c.study, o.study) AS "Study", coalesce(c.p_name, o.p_name) AS "Antigen", o.p_name AS "Data_Name",
       coalesce(c.p_type, o.p_type) AS "TotalSeq_Cat"
FROM c FULL JOIN o ON c.study = o.study AND c.p_name = o.p_name AND c.p_type = o.p_type
""")
def shared_names(t):
    """Both sources have seen all names in all categories: what one has matched is still new to the other."""
    study = F.when(F.col("p_size") <= 25, "a").otherwise("b")
    catalogue = t.part.select("p_partkey", study.alias("Study"), F.col("p_name").alias("Antigen"), F.col("p_type").alias("TotalSeq_Cat"))
    observed = t.part.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("Study"), F.col("p_name").alias("Data_Name"), F.col("p_type").alias("kind"))
    rule = NameRule(
        keys=[(lambda: F.concat_ws("|", "Antigen", "TotalSeq_Cat"), lambda: F.concat_ws("|", "Data_Name", "kind"))],
        fields={"TotalSeq_Cat": lambda: F.col("kind")}, append="name",
    )
    return reconcile(catalogue, observed, {"a": rule, "b": rule}).select("p_partkey", "Study", "Antigen", "Data_Name", "TotalSeq_Cat")


@query("q75_annotate_controls", """
WITH d AS (SELECT p_name, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS "ALT_ID" FROM part GROUP BY 1),
looked AS (SELECT DISTINCT p_name FROM part WHERE p_size >= 10)
SELECT p_partkey, p.p_name AS "Antigen", p_size < 10 AS "Isotype_Control", CASE WHEN p_size >= 10 THEN "ALT_ID" END AS "ALT_ID"
FROM part p LEFT JOIN d ON p.p_name = d.p_name
""")
def annotate_controls(t):
    """The default spellings; a name that is a control in one row gets no identifier there, but in the others."""
    catalogue = t.part.select("p_partkey", F.col("p_name").alias("Antigen"), (F.col("p_size") < 10).alias("Isotype_Control"))
    aliases = t.part.select(F.upper(F.regexp_replace("p_name", "[ _-]", "")).alias("value"), F.col("p_type").alias("ALT_ID")).distinct()
    return cat.annotate(catalogue, aliases, id_columns=["ALT_ID"])


@query("q76_fill_down_null_order", """
SELECT event_id, user_id, last_value(known IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts2 NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known
FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN event_id // 100 END AS ts2,
             CASE WHEN event_id % 5 = 0 THEN event_id END AS known FROM events)
""")
def fill_down_null_order(t):
    """Rows whose order is NULL come first and hand their last value on, also where groups are cut."""
    place = F.when(F.col("event_id") % 7 != 0, F.floor(F.col("event_id") / 100).cast("long"))
    known = F.when(F.col("event_id") % 5 == 0, F.col("event_id"))
    events = t.events.select("event_id", "user_id", place.alias("place"), known.alias("known"))
    filled = fill_down(events, ["known"], ["user_id"], ["place", "event_id"], F.floor(F.col("place") / 7), hot_rows=20)
    return filled.select("event_id", "user_id", "known")


@query("q93_reconcile_changed", f"""WITH {_RECONCILE_SQL}
SELECT p_partkey, study AS "Study", antigen AS "Antigen", data_name AS "Data_Name" FROM r
""")
def reconcile_changed_sources(t):
    """Results of an earlier state of one source are there; only that source is computed again."""
    catalogue, observed, rules = _renderings(t)
    path = t.new_folder("reconciled")
    reconcile_changed(catalogue, observed.where("Study <> 'dotted' OR Data_Name LIKE '%1.1'"), rules, path)
    if reconcile_changed(catalogue, observed, rules, path) not in ([], ["dotted"]):
        raise RuntimeError("a source that did not change was computed again")
    return read_sources(t.spark, path).select("p_partkey", "Study", "Antigen", "Data_Name")
