from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablemend.functions import nulls as n
from tablemend.functions import text as x
from tablemend.functions.split import separate
from tablemend.operators import columns as c


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


CASES = [
    (x.squish, ["  a \t b\n", "a  b", "", None], ["a b", "a b", "", None]),
    (lambda v: x.pad_left(v, 4), ["7", "0123", "AHS0189", None], ["0007", "0123", "AHS0189", None]),
    (lambda v: x.extract(v, r"\(([^)]*)\)"), ["CD3 (x)", "CD3", "", None], ["x", None, None, None]),
    (lambda v: x.extract_or_self(v, r".*([ABC])$"), ["TotalSeqB", "x", "two\nlines C", None], ["B", "x", "C", None]),
    (lambda v: x.extract_or_self(v, "^anti-([a-z]+) (.*)$", 2), ["anti-human CD4", "CD4"], ["CD4", "CD4"]),
    (lambda v: x.gsub(v, r"^(.*) \((.*)\)$", "$2-$1"), ["CD4 (T4)", "CD4"], ["T4-CD4", "CD4"]),
    (lambda v: x.gsub(v, "a.b", "_"), ["a\nb", "axb"], ["_", "_"]),
    (lambda v: x.if_changed(x.gsub(v, "x$", ""), v), ["ax", "a", None], ["a", None, None]),
    (lambda v: x.lower_tail(v, "CD[0-9]+", "[A-Z]"), ["CD8A", "my CD11B", "CD8", "A", None], ["CD8a", "my CD11b", "CD8", "A", None]),
    (lambda v: x.remove_first(v, F.lit("b.")), ["ab.b.", "abx", None], ["ab.", "abx", None]),
    (x.greek_symbols_to_letters, ["TCR α/β", "µm", None], ["TCR a/b", "mm", None]),
    (x.greek_words_to_letters, ["TCR alphabeta", "IL-2 gamma", "immune metal", "TCR mu"], ["TCR ab", "IL-2 g", "immune metal", "TCR m"]),
    (x.to_ascii, ["Éà ñ ß æ ﬁ", "λ", "plain", None], ["Ea n ss ae fi", "l", "plain", None]),
    (x.strip_non_alnum, ["CD3-é 4!", "[:alnum:]"], ["CD3é4", "alnum"]),
    (x.match_key, ["TCR α/β", "tcr-ab"], ["TCRAB", "TCRAB"]),
    (lambda v: n.matches(v, "^a"), ["ab", "b", None], [True, False, False]),
    (lambda v: n.one_of(v, ["a"]), ["a", "b", None], [True, False, False]),
    (lambda v: n.if_else(v == "a", F.lit(1), F.lit(2)), ["a", "b", None], [1, 2, None]),
    (lambda v: n.null_if_any(v, ["n/a", "N/A"]), ["n/a", "x", None], [None, "x", None]),
    (lambda v: n.paste(v, F.lit("s"), sep="__"), ["a", None], ["a__s", "NA__s"]),
    (lambda v: n.paste(v, F.lit("s"), sep="__", null_text=None), ["a", None], ["a__s", None]),
]


@pytest.mark.parametrize("fn, values, want", CASES)
def test_expression(spark, fn, values, want):
    assert apply(spark, fn, values) == want


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "x")], "k string, v string")
    assert rows(df.groupBy("k").agg(n.distinct_with_null(F.col("v")))) == [("a", 2), ("b", 1)]


def split(spark, values, *args, **kwargs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in separate(df, "v", *args, **kwargs).orderBy("i").collect()]


def test_separate(spark):
    assert split(spark, ["A0034", "B1", None], ("cat", "oligo"), "(?<=[ABC])") == [("A", "0034"), ("B", "1"), (None, None)]
    assert split(spark, ["Mouse IgG1", "IgG2"], ("species", "isotype"), " (?=Ig)", fill="left") == [("Mouse", "IgG1"), (None, "IgG2")]
    assert split(spark, ["a b c d", "a"], ("p", "q"), " ", extra="merge") == [("a", "b c d"), ("a", None)]
    assert split(spark, ["a b c"], ("p", "q"), " ") == [("a", "b")]
    assert split(spark, ["a b c"], ("p", None, "r"), " ") == [("a", "c")]
    assert split(spark, ["x-y_z"], ("p", "q", "r")) == [("x", "y", "z")]
    assert split(spark, ["a#b"], ("p", "q"), "#", remove=False) == [("a#b", "a", "b")]
    with pytest.raises(ValueError):
        split(spark, ["a"], ("p",), " ", extra="keep")


def test_projection(spark):
    df = spark.createDataFrame([(" a ", 1, None)], "`Cat #` string, `conc. 1` int, note string")
    renamed = c.rename(df, {"Cat_Number": "Cat #"})
    assert renamed.columns == ["Cat_Number", "conc. 1", "note"]
    for bad in (lambda: c.rename(df, {"x": "none"}), lambda: c.drop(df, ["none"]), lambda: c.keep(df, ["none"]), lambda: c.relocate(df, ["none"])):
        with pytest.raises(ValueError, match="none"):
            bad()
    assert c.drop(df, ["none"], absent="ignore").columns == df.columns
    assert c.keep(df, ["note", "none"], absent="ignore").columns == ["note"]
    assert c.drop_matching(df, "^CONC").columns == ["Cat #", "note"]
    assert c.keep_matching(df, "conc").columns == ["conc. 1"]
    assert c.rename_with(df, str.upper).columns == ["CAT #", "CONC. 1", "NOTE"]
    assert c.relocate(df, ["note"]).columns == ["note", "Cat #", "conc. 1"]
    assert rows(c.across(renamed, x.squish, dtype="string"), "Cat_Number") == [("a",)]
    sequential = c.derive(renamed, [("n", F.col("`conc. 1`") + 1), ("n", F.col("n") * 10), ("m", F.col("n") + 1)])
    assert rows(sequential, "n", "m") == [(20, 21)]
