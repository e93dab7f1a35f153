"""Text, split and choice expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.functions import nulls as n
from tablemend.functions import text as x
from tablemend.functions.split import separate
from tablemend.queries.registry import query


@query("q03_squish_clean", r"""
SELECT doc_id, trim(regexp_replace(text, '[\s\p{Z}\x{0b}\x{85}]+', ' ', 'g'), ' ') AS text FROM documents
""")
def squish_clean(t):
    return t.documents.select("doc_id", x.squish(F.col("text")).alias("text"))


@query("q04_separate_code", """
SELECT c_custkey, split_part(c_name, '#', 1) AS prefix, split_part(c_name, '#', 2) AS number FROM customer
""")
def separate_code(t):
    return separate(t.customer.select("c_custkey", "c_name"), "c_name", ("prefix", "number"), "#")


@query("q05_separate_merge", """
SELECT o_orderkey, substr(o_orderpriority, 1, strpos(o_orderpriority, '-') - 1) AS level,
       substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS label
FROM orders
""")
def separate_merge(t):
    return separate(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ("level", "label"), "-", extra="merge")


@query("q06_separate_fill_left", """
SELECT p_partkey, CASE WHEN len(w) >= 3 THEN w[len(w) - 2] END AS first_word,
       CASE WHEN len(w) >= 2 THEN w[len(w) - 1] END AS adjective, w[len(w)] AS noun
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
""")
def separate_fill_left(t):
    return separate(t.part.select("p_partkey", "p_name"), "p_name", ("first_word", "adjective", "noun"), " ", fill="left")


@query("q07_extract_or_null", r"""
SELECT page_id,
       CASE WHEN regexp_matches(url, '^https?://[^/]+/[a-z]{2}/') THEN regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) END AS lang,
       CASE WHEN regexp_matches(url, '[?&]ref=[^&#]+') THEN regexp_extract(url, '[?&]ref=([^&#]+)', 1) END AS ref,
       CASE WHEN regexp_matches(url, '#.+$') THEN regexp_extract(url, '#(.+)$', 1) ELSE url END AS anchor_or_url,
       nullif(regexp_replace(url, '^https://', ''), url) AS secure_rest
FROM pages
""")
def extract_or_null(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        x.extract(url, "^https?://[^/]+/([a-z]{2})/").alias("lang"),
        x.extract(url, "[?&]ref=([^&#]+)").alias("ref"),
        x.extract_or_self(url, "#(.+)$").alias("anchor_or_url"),
        x.if_changed(x.gsub(url, "^https://", ""), url).alias("secure_rest"),
    )


@query("q08_pad_no_truncate", """
SELECT p_partkey, CASE WHEN len(k) < 3 THEN lpad(k, 3, '0') ELSE k END AS code
FROM (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS k FROM part)
""")
def pad_no_truncate(t):
    return t.part.select("p_partkey", x.pad_left(F.col("p_partkey").cast("string"), 3).alias("code"))


@query("q09_canonical_key", """
SELECT p_partkey, upper(regexp_replace(p_brand || ' / ' || p_type, '[^A-Za-z0-9]', '', 'g')) AS key FROM part
""")
def canonical_key(t):
    return t.part.select("p_partkey", x.match_key(F.concat_ws(" / ", "p_brand", "p_type")).alias("key"))


@query("q10_case_when_sentinel", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush'
                        WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'done'
                        WHEN o_orderpriority LIKE '_-%D' THEN 'open'
                        ELSE 'ERROR' END AS class
FROM orders
""")
def case_when_sentinel(t):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(n.one_of(priority, ["1-URGENT", "2-HIGH"]), "rush")
        .when((priority == "5-LOW") & (status == "F"), "done")
        .when(n.matches(priority, "^.-.*D$"), "open")
        .otherwise("ERROR")
        .alias("class"),
    )


@query("q11_ifelse_null", """
SELECT event_id, CASE WHEN t IS NULL THEN NULL WHEN t = 'click' THEN 'yes' ELSE 'no' END AS clicked
FROM (SELECT event_id, nullif(event_type, 'error') AS t FROM events)
""")
def ifelse_null(t):
    kind = F.nullif("event_type", F.lit("error"))
    return t.events.select("event_id", n.if_else(kind == "click", F.lit("yes"), F.lit("no")).alias("clicked"))


@query("q12_scale_unit", "SELECT event_id, value * 10 AS per_ml FROM events")
def scale_unit(t):
    return t.events.select("event_id", (F.col("value") * 10).alias("per_ml"))


# The accented letters the SQL twin folds.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


@query("q13_translit", f"""
SELECT doc_id, replace(translate(text, '{_ACCENTED}', '{_PLAIN}'), 'ß', 'ss') AS text,
       source || ' fwsDA ee "x" - fi Ж' AS marked FROM documents
""")
def translit(t):
    odd = F.concat("source", F.lit(" φωσΔΑ ếe\u0301 “x” – ﬁ Ж"))
    return t.documents.select("doc_id", x.to_ascii(F.col("text")).alias("text"), x.to_ascii(odd).alias("marked"))


@query("q54_case_change_capture", """
SELECT c_custkey, substr(c_mktsegment, 1, len(c_mktsegment) - 1) || lower(substr(c_mktsegment, len(c_mktsegment))) AS segment
FROM customer
""")
def case_change_capture(t):
    return t.customer.select("c_custkey", x.lower_tail(F.col("c_mktsegment"), "[A-Z]{3}", "[A-Z]").alias("segment"))


@query("q55_replace_by_column", """
SELECT p_partkey, substr(label, 1, strpos(label, p_brand) - 1) || substr(label, strpos(label, p_brand) + len(p_brand)) AS label
FROM (SELECT p_partkey, p_brand, p_name || ' ' || p_brand || ' ' || p_brand || ' ' || p_type AS label FROM part)
""")
def replace_by_column(t):
    label = F.concat_ws(" ", "p_name", "p_brand", "p_brand", "p_type")
    return t.part.select("p_partkey", x.remove_first(label, F.col("p_brand")).alias("label"))


@query("q60_split_keep_source", """
SELECT c_name, split_part(c_name, '#', 1) AS prefix, split_part(c_name, '#', 2) AS number,
       starts_with(c_name, 'Customer') AS is_customer
FROM customer WHERE len(split_part(c_name, '#', 2)) = 9
""")
def split_keep_source(t):
    split = separate(t.customer.select("c_name"), "c_name", ("prefix", "number"), remove=False)
    return split.where(F.length("number") == 9).withColumn("is_customer", F.startswith(F.col("c_name"), F.lit("Customer")))


@query("q61_greek_names", """
SELECT p_partkey, replace(replace(replace(greek, 'α', 'a'), 'β', 'b'), 'γ', 'g') || ' wDs' AS from_symbols, letters AS from_words
FROM (SELECT p_partkey,
             CASE WHEN p_size < 20 THEN 'α-' WHEN p_size < 40 THEN 'β-' ELSE 'γ-' END || p_name AS greek,
             CASE WHEN p_size < 20 THEN 'a-' WHEN p_size < 40 THEN 'b-' ELSE 'g-' END || p_name || ' immune metal' AS letters
      FROM part)
""")
def greek_names(t):
    size = F.col("p_size")
    symbol = F.when(size < 20, "α-").when(size < 40, "β-").otherwise("γ-")
    word = F.when(size < 20, "alpha-").when(size < 40, "beta-").otherwise("gamma-")
    return t.part.select(
        "p_partkey",
        x.greek_symbols_to_letters(F.concat(symbol, "p_name", F.lit(" ωΔς"))).alias("from_symbols"),
        x.greek_words_to_letters(F.concat(word, "p_name", F.lit(" immune metal"))).alias("from_words"),
    )
