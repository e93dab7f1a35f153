from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablemend.operators import identity
from tablemend.plans.catalogue import standardise_names

SLOW = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROW = st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.sampled_from(["p", "q", "r", None]), st.sampled_from([1, 2, 3, None]))
SCHEMA = "x string, y string, z int"
IDENTIFIERS = ["x", ["y", "z"]]


def brute(data, most_items=None):
    """(x, y, z, identity) by merging sets until nothing changes."""
    def ids(row):
        x, y, z = row
        return [(0, (x,))] * (x is not None) + [(1, (y, str(z)))] * (y is not None and z is not None)

    holders = {}
    for row in set(data):
        for i in ids(row):
            holders.setdefault(i, set()).add(row)
    counted = {i for i, h in holders.items() if most_items is None or len(h) <= most_items}
    sets = [{i for i in ids(row) if i in counted} for row in set(data)]
    merged = True
    while merged:
        merged = False
        for a in sets:
            for b in sets:
                if a is not b and a & b:
                    a |= b
                    b.clear()
                    merged = True
    names = {}
    for s in sets:
        if s:
            kind, values = min(s)
            names |= {i: ("x", "y+z")[kind] + "=" + "|".join(values) for i in s}
    return sorted(((*row, next((names[i] for i in ids(row) if i in names), None)) for row in data), key=repr)


@pytest.mark.parametrize("hot_rows", [None, 1])
@SLOW
@given(data=st.lists(ROW, max_size=12))
def test_linked_rows_have_one_identity(no_broadcast, spark, hot_rows, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(identity.resolve(df, IDENTIFIERS, hot_rows=hot_rows)) == brute(data)


def test_a_long_chain_is_one_identity(spark):
    """Each row shares one identifier with the next; rows repeat and come in any order."""
    chain = [(f"x{i // 2:03d}", f"y{(i + 1) // 2:03d}", 1) for i in range(80)]
    df = spark.createDataFrame(chain[::-1] + chain[:5] + [(None, "lonely", None), (None, None, None)], SCHEMA).repartition(3)
    out = rows(identity.resolve(df, IDENTIFIERS), "identity", "y")
    assert {i for i, y in out if y and y != "lonely"} == {"x=x000"} and len(out) == 87
    assert [i for i, y in out if y is None or y == "lonely"] == [None, None]


def test_placeholders_link_nothing(spark):
    data = [("NA", f"y{i % 4}", i % 2) for i in range(8)] + [("NA", None, None), ("real", "y1", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    assert {r[3] for r in rows(identity.resolve(df, IDENTIFIERS))} == {"x=NA"}
    assert rows(identity.resolve(df, IDENTIFIERS, most_items=3)) == brute(data, 3)
    assert rows(identity.shared_identifiers(df, IDENTIFIERS, 3)) == [("x=NA", 5, 9)]


def test_a_name_for_each_identity(spark):
    data = [("s", "CD3", "a", None), ("s", "CD3e", "a", "p"), ("t", "CD3e", None, "p"), ("t", "other", "b", None), ("s", "CD3e", None, None), ("t", "alone", None, None)]
    df = spark.createDataFrame(data, "Study string, Antigen string, x string, y string")
    out = rows(standardise_names(df, ["x", "y"], linked=True), "Study", "Antigen", "Antigen_std")
    assert out == sorted([("s", "CD3", "CD3e"), ("s", "CD3e", "CD3e"), ("t", "CD3e", "CD3e"), ("t", "other", "other"), ("s", "CD3e", "CD3e"), ("t", "alone", None)], key=repr)
    assert standardise_names(df, ["x", "y"], linked=True).columns == [*df.columns, "Antigen_std"]
    clashing = df.toDF("item", "kind", "values", "node")
    assert [r[0] for r in rows(identity.resolve(clashing, ["values", "node"]).select("identity"))] == [r[0] for r in rows(identity.resolve(df, ["x", "y"]).select(F.regexp_replace(F.regexp_replace("identity", "^x", "values"), "^y", "node")))]
    with pytest.raises(ValueError, match="exists"):
        identity.resolve(df, ["x"], "Study")


def test_components_of_a_star_and_a_path(spark):
    star = spark.range(1, 200).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    path = spark.range(1000, 1050).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = dict(rows(identity.components(star.union(path), hot_rows=20)))
    assert out == {i: 0 for i in range(200)} | {i: 1000 for i in range(1000, 1051)}
    assert identity.components(star.where("a < 0")).count() == 0
