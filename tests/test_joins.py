from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablemend.operators import joins as j

KEY = st.sampled_from(["a", "b", "c", None])
LEFT = st.lists(st.tuples(KEY, KEY, st.integers(0, 99)), max_size=12)
RIGHT = st.lists(st.tuples(KEY, KEY, st.integers(100, 199)), max_size=12)
SLOW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def meet(a, b, nulls):
    return a == b and (nulls == "match" or a is not None)


def brute_left(left, right, nulls):
    out = []
    for k, m, v in left:
        partners = [r for r in right if meet(k, r[0], nulls)]
        out += [(k, m, v, r[1], r[2]) for r in partners] or [(k, m, v, None, None)]
    return out


def brute_full(left, right, nulls):
    lonely = [r for r in right if not any(meet(l[0], r[0], nulls) for l in left)]
    return brute_left(left, right, nulls) + [(r[0], None, None, r[1], r[2]) for r in lonely]


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "k string, m string, v int"),
        spark.createDataFrame(right, "k string, n string, w int"),
    )


@pytest.mark.parametrize("nulls", ["match", "never"])
@pytest.mark.parametrize("hot_rows", [None, 1])
@SLOW
@given(left=LEFT, right=RIGHT)
def test_joins_equal_brute_force(no_broadcast, spark, nulls, hot_rows, left, right):
    l, r = frames(spark, left, right)
    assert rows(j.left_join(l, r, "k", nulls, hot_rows=hot_rows)) == sorted(brute_left(left, right, nulls), key=repr)
    assert rows(j.full_join(l, r, "k", nulls, hot_rows=hot_rows)) == sorted(brute_full(left, right, nulls), key=repr)
    partner = [x for x in left if any(meet(x[0], y[0], nulls) for y in right)]
    lonely = [x for x in left if not any(meet(x[0], y[0], nulls) for y in right)]
    assert rows(j.semi_join(l, r, "k", nulls, hot_rows=hot_rows)) == sorted(partner, key=repr)
    assert rows(j.anti_join(l, r, "k", nulls, hot_rows=hot_rows)) == sorted(lonely, key=repr)


@pytest.mark.parametrize("nulls", ["match", "never"])
@pytest.mark.parametrize("hot_rows", [None, 1])
@SLOW
@given(left=LEFT, right=RIGHT)
def test_join_any_takes_the_first_key_that_matches(no_broadcast, spark, nulls, hot_rows, left, right):
    want = []
    for k, m, v in left:
        first = [r for r in right if meet(k, r[0], nulls)]
        second = [r for r in right if meet(m, r[1], nulls)]
        if first:
            want += [(k, m, v, r[2], 1) for r in first]
        elif second:
            want += [(k, m, v, r[2], 2) for r in second]
        else:
            want.append((k, m, v, None, None))
    l, r = frames(spark, left, [x for x in right])
    got = j.join_any(l, r.withColumnRenamed("n", "m"), ["k", "m"], nulls, "pass", hot_rows=hot_rows)
    assert rows(got) == sorted(want, key=repr)


def test_hot_keys_on_both_sides(no_broadcast, spark):
    l = spark.range(300).select(F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    r = spark.range(60).select(F.when(F.col("id") < 20, "hot").otherwise((F.col("id") + 200).cast("string")).alias("k"), F.col("id").alias("w"))
    plain = rows(j.left_join(l, r, "k", hot_rows=None))
    assert len(plain) == 200 * 20 + 100
    assert rows(j.left_join(l, r, "k", hot_rows=10)) == plain
    assert rows(j.full_join(l, r, "k", hot_rows=10)) == rows(j.full_join(l, r, "k", hot_rows=None))


def test_hot_key_rows_are_spread_over_tasks(no_broadcast, spark):
    """A key with a third of all rows, all of them copies, ends up in many sub-keys."""
    l = spark.range(0, 3000, 1, 50).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    keyed = j._with_keys(l, [F.col("k")])
    hot = j.hot_keys(["__k0"], 100, __lhot=keyed)
    assert rows(hot) == [("hot", 10)]
    spread = j._spread(j.mark_hot(keyed, hot, ["__k0"], ["__lhot"]), F.col("__lhot"), "sub")
    assert max(r["count"] for r in spread.groupBy("k", "sub").count().collect()) <= 150
    r = l.distinct().withColumn("w", F.length("k"))
    assert j.left_join(l, r, "k", hot_rows=100).where("w is not null").count() == 3000


def test_joins_read_only_the_columns_used(no_broadcast, spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).select("id", *[F.lit(i).alias(f"c{i}") for i in range(5)]).write.parquet(path)
    wide = spark.read.parquet(path)
    joined = j.left_join(wide, wide.select("id", F.col("c1").alias("w")), "id").select("id", "c0", "w")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "c0" in plan and "c3" not in plan and "c4" not in plan


@pytest.mark.parametrize("arranged", ["repartition", "window"])
def test_hot_rows_of_one_task_are_spread(no_broadcast, spark, arranged):
    """An earlier shuffle by the key has brought the whole key into one task."""
    l = spark.range(8000).select(F.lit("hot").alias("k"), "id")
    if arranged == "window":
        l = l.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    else:
        l = l.repartition(8, "k")
    keyed = j._with_keys(l, [F.col("k")])
    hot = j.hot_keys(["__k0"], 1000, __lhot=keyed)
    spread = j._spread(j.mark_hot(keyed, hot, ["__k0"], ["__lhot"]), F.col("__lhot"), "sub")
    counts = [r["count"] for r in spread.groupBy("k", "sub").count().collect()]
    assert len(counts) == 8 and max(counts) <= 2000


def test_the_list_of_hot_keys_is_bounded(no_broadcast, spark, monkeypatch):
    monkeypatch.setattr(j, "HOT_KEYS", 2)
    l = spark.createDataFrame([("a", n) for n in range(5)] + [("b", n) for n in range(4)] + [("c", n) for n in range(3)], "k string, v int")
    r = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, w int")
    assert {x[0] for x in rows(j.hot_keys(["__k0"], 1, __lhot=j._with_keys(l, [F.col("k")])))} == {"a", "b"}
    assert rows(j.left_join(l, r, "k", hot_rows=1), "k", "v", "w") == sorted((k, v, "abc".index(k) + 1) for k, v in rows(l))


def test_only_surely_small_tables_count_as_small(spark, tmp_path):
    few = spark.range(20)
    many = few.select(F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("k"))
    assert j.known_small(few) and not j.known_small(many)


@pytest.mark.parametrize("nulls", ["match", "never"])
@pytest.mark.parametrize("small", ["v", "w"])
def test_one_small_side(spark, monkeypatch, small, nulls):
    """One side is broadcast, the other counted as large; the result is the same."""
    left = [("a", "p", 1), ("b", "q", 2), (None, "r", 3), ("a", "s", 4)]
    right = [("a", "x", 10), ("a", "y", 11), (None, "z", 12), ("c", "u", 13)]
    l, r = frames(spark, left, right)
    monkeypatch.setattr(j, "known_small", lambda df: small in df.columns)
    assert rows(j.left_join(l, r, "k", nulls, hot_rows=1)) == sorted(brute_left(left, right, nulls), key=repr)
    assert rows(j.full_join(l, r, "k", nulls, hot_rows=1)) == sorted(brute_full(left, right, nulls), key=repr)
    assert rows(j.semi_join(l, r, "k", nulls, hot_rows=1), "v") == [(x[2],) for x in left if any(meet(x[0], y[0], nulls) for y in right)]


def test_key_pairs_and_suffix(spark):
    l = spark.createDataFrame([(1, "x")], "a int, note string")
    r = spark.createDataFrame([(1, "y")], "b int, note string")
    out = j.left_join(l, r, [("a", "b")])
    assert out.columns == ["a", "note", "note_right"] and rows(out) == [(1, "x", "y")]
    with pytest.raises(ValueError, match="both tables"):
        j.left_join(l, r, [("a", "b")], suffix=None)


def test_natural_joins_need_a_shared_column(spark):
    l = spark.createDataFrame([(1, "x")], "a int, s string")
    r = spark.createDataFrame([(1, "y"), (2, "z")], "a int, t string")
    assert rows(j.full_join(l, r)) == [(1, "x", "y"), (2, None, "z")]
    assert rows(j.anti_join(r, l)) == [(2, "z")]
    with pytest.raises(ValueError, match="shared column"):
        j.full_join(l, r.select("t"))


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_cascade_appends_unused_names_once(no_broadcast, spark, hot_rows):
    x = spark.createDataFrame([("A", "1"), ("B", None), ("C", "9"), ("A", None)], "item string, code string")
    y = spark.createDataFrame([("A", "1", "n1"), ("B", "7", "n2"), ("Z", "8", "n3"), ("Z", None, "n3")], "item string, code string, name string")
    out = j.match_cascade(x, y, [["item", "code"], "item"], "name", pass_column="step", hot_rows=hot_rows)
    assert rows(out, "item", "code", "name", "step") == sorted([
        ("A", "1", "n1", 1), ("B", None, "n2", 2), ("C", "9", None, None), ("A", None, "n1", 2),
        ("Z", "8", "n3", None), ("Z", None, "n3", None),
    ], key=repr)


def test_no_nested_loop_in_any_join(spark):
    l = spark.createDataFrame([("a", "b", 1)], "k string, m string, v int")
    r = spark.createDataFrame([("a", "b", 2)], "k string, m string, w int")
    for df in (j.join_any(l, r, ["k", "m"]), j.left_join(l, r, ["k", "m"], suffix="_r"), j.full_join(l, r, "k"), j.anti_join(l, r, "k")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_contract_audit_and_probe(spark):
    l = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2)], "k string, v int")
    r = spark.createDataFrame([("a", 5), ("b", 1)], "k string, v int")
    assert rows(j.repeated_partners(l, r, "k")) == [("a", 2)]
    assert rows(j.conflict_probe(l, r, "k", "v")) == [("a", 2)]
    with pytest.raises(Exception, match="more than one left row"):
        j.full_join(l, r.withColumnRenamed("v", "w"), "k", one_to_many=True).collect()
    once = l.where("v = 1")
    assert j.full_join(once, r.withColumnRenamed("v", "w"), "k", one_to_many=True).count() == 3


def test_membership_flag_is_never_null(spark):
    l = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    r = spark.createDataFrame([("a",), ("a",)], "q string")
    assert rows(j.in_column(l, "k", r, "q", "seen")) == [("a", True), ("b", False), (None, False)]


def exchanges(df):
    """(hash exchanges, scans, joins that are not broadcast) of the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("FileScan"), plan.count("SortMergeJoin")


@pytest.fixture
def stored_pair(spark, tmp_path):
    left = spark.range(400).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 7).cast("string").alias("m"), "id")
    right = spark.range(90).select(F.when(F.col("id") < 30, "hot").otherwise((F.col("id") * 3).cast("string")).alias("k"), (F.col("id") % 9).cast("string").alias("m"), F.col("id").alias("w"))
    left.write.parquet(str(tmp_path / "l"))
    right.write.parquet(str(tmp_path / "r"))
    return spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))


def test_a_full_join_counts_once_and_joins_once(no_broadcast, spark, stored_pair):
    l, r = stored_pair
    r = r.drop("m")
    joined = j.full_join(l, r, "k", hot_rows=20)
    hashed, scans, joins = exchanges(joined)
    # The count of hot keys stands in the plan of both sides, and runs once.
    assert joins == 1 and hashed <= 4 and scans <= 6
    joined.collect()
    ran = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("FileScan") <= 4
    assert rows(joined) == rows(j.full_join(l, r, "k", hot_rows=None))


def test_hot_keys_of_one_side_only_are_not_lost(no_broadcast, spark):
    l = spark.createDataFrame([("a", i) for i in range(9)] + [(None, i) for i in range(9)] + [("c", 1)], "k string, v int")
    r = spark.createDataFrame([("b", i) for i in range(9)] + [(None, 100), ("c", 2)], "k string, w int")
    for nulls in ("match", "never"):
        assert rows(j.full_join(l, r, "k", nulls, hot_rows=2)) == rows(j.full_join(l, r, "k", nulls, hot_rows=None))


def test_any_number_of_keys_meets_in_one_join(no_broadcast, spark, stored_pair):
    """More passes, the same joins: one of key rows, one that brings the result back."""
    l, r = stored_pair
    r = r.dropDuplicates(["k"])
    two = exchanges(j.join_any(l, r, ["k", "m"], hot_rows=None, right_unique=True))
    three = exchanges(j.join_any(l.withColumn("q", F.col("m")), r.withColumn("q", F.col("m")), ["k", "m", "q"], hot_rows=None, right_unique=True))
    assert two == three and two[2] == 2


def test_keys_of_several_types_meet(spark):
    x = spark.createDataFrame([(1, 2.0, None, "p"), (2, -0.0, None, "q"), (3, None, "z", "r"), (None, None, None, "s")], "i int, d double, t string, name string")
    y = spark.createDataFrame([(1, 9.0, "z", "one"), (7, 0.0, "y", "zero"), (8, 5.0, "z", "other")], "i long, d float, t string, w string")
    got = rows(j.join_any(x, y, ["i", "d", "t"], pass_column="pass").select("name", "w", "pass"))
    assert got == sorted([("p", "one", 1), ("q", "zero", 2), ("r", "one", 3), ("r", "other", 3), ("s", None, None)], key=repr)
