from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablemend.operators import aggregates as a
from tablemend.operators import fill, sets
from tablemend.operators import rows as r
from tablemend.plans import audits
from tablemend.plans.catalogue import fill_from_peers

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEY = st.sampled_from(["a", "b", None])
VALUE = st.sampled_from(["x", "y", None])
TABLE = st.lists(st.tuples(KEY, VALUE, st.integers(0, 3)), max_size=14)


def table(spark, data):
    return spark.createDataFrame(data, "k string, c string, i int")


@pytest.mark.parametrize("hot_rows", [None, 1])
@SLOW
@given(data=TABLE, patch=st.dictionaries(KEY, VALUE, max_size=3))
def test_update_and_patch(no_broadcast, spark, hot_rows, data, patch):
    x, y = table(spark, data), spark.createDataFrame(list(patch.items()), "k string, c string")
    updated = [(k, patch[k] if k in patch else c, i) for k, c, i in data]
    patched = [(k, c if c is not None else patch.get(k), i) for k, c, i in data]
    assert rows(r.rows_update(x, y, ["k"], hot_rows=hot_rows)) == sorted(updated, key=repr)
    assert rows(r.rows_patch(x, y, ["k"], hot_rows=hot_rows)) == sorted(patched, key=repr)
    stray = [(k, v) for k, v in patch.items() if k not in {d[0] for d in data}]
    assert rows(r.unmatched_rows(x, y, ["k"], hot_rows=hot_rows)) == sorted(stray, key=repr)


def test_patch_guards(spark):
    x = table(spark, [("a", None, 1)])
    twice = spark.createDataFrame([("a", "x"), ("a", "x")], "k string, c string")
    assert rows(r.duplicate_keys(twice, ["k"])) == [("a", 2)]
    with pytest.raises(Exception, match="not unique"):
        r.rows_update(x, twice, ["k"]).collect()
    stray = spark.createDataFrame([("z", "x")], "k string, c string")
    assert r.rows_update(x, stray, ["k"]).count() == 1
    with pytest.raises(Exception, match="not in the table"):
        r.rows_update(x, stray, ["k"], unmatched="error").collect()
    with pytest.raises(ValueError, match="not in the table"):
        r.rows_update(x, stray.withColumnRenamed("c", "new"), ["k"])
    with pytest.raises(ValueError, match="audit"):
        audits.require_empty(r.unmatched_rows(x, stray, ["k"]), "audit")
    audits.require_empty(stray.where("false"), "audit")


def test_chained_corrections_see_earlier_results(spark):
    x = spark.createDataFrame([("s", "old", None)], "study string, item string, code string")
    first = spark.createDataFrame([("s", "old", "1")], "study string, item string, code string")
    second = spark.createDataFrame([("1", "new")], "code string, item string")
    assert rows(r.apply_corrections(x, [(first, ["study", "item"]), (second, ["code"])], small=True)) == [("s", "new", "1")]


PATCH = st.tuples(st.sampled_from(["k", "i"]), st.dictionaries(st.sampled_from(["a", 0, 1]), st.tuples(VALUE, VALUE), max_size=2), st.booleans())


@SLOW
@given(data=TABLE, patches=st.lists(PATCH, min_size=2, max_size=5))
def test_folded_corrections_equal_one_after_the_other(spark, data, patches):
    """Patches on two keys in any order: one log per key gives what single updates give."""
    x = table(spark, data).withColumn("d", F.lit("old"))
    log = []
    for key, values, both in patches:
        kind, wanted = ("string", "a") if key == "k" else ("int", None)
        listed = [(v, c, d) for v, (c, d) in values.items() if (v == "a") == (wanted == "a")]
        y = spark.createDataFrame(listed, f"{key} {kind}, c string, d string")
        log.append((y if both else y.drop("d"), [key]))
    want = x
    for y, by in log:
        want = r.rows_update(want, y, by)
    assert rows(r.apply_corrections(x, log)) == rows(want)


def test_corrections_are_folded_where_order_allows(spark):
    def patch(*columns):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    def shape(*log):
        return [(by, len(patches)) for by, patches in r.compacted([(patch(*by, *values), list(by)) for by, values in log])]

    # Same key; a patch in between that neither reads nor writes what they touch stays out of the way.
    assert shape((("a",), ("x",)), (("b",), ("y",)), (("a",), ("x", "z"))) == [(["a"], 2), (["b"], 1)]
    assert shape((("a", "b"), ("x",)), (("b", "a"), ("y",))) == [(["a", "b"], 2)]
    # It writes the same column, writes the key, or reads what the later one writes.
    assert shape((("a",), ("x",)), (("b",), ("x",)), (("a",), ("x",))) == [(["a"], 1), (["b"], 1), (["a"], 1)]
    assert shape((("a",), ("x",)), (("b",), ("a",)), (("a",), ("x",))) == [(["a"], 1), (["b"], 1), (["a"], 1)]
    assert shape((("a",), ("x",)), (("b",), ("y",)), (("a",), ("b",))) == [(["a"], 1), (["b"], 1), (["a"], 1)]
    twice = spark.createDataFrame([("a", "x"), ("a", "x")], "k string, c string")
    once = spark.createDataFrame([("a", "y")], "k string, c string")
    x = table(spark, [("a", None, 1)])
    assert rows(r.apply_corrections(x, [(once, ["k"]), (once.withColumn("c", F.lit(None).cast("string")), ["k"])])) == [("a", None, 1)]
    with pytest.raises(Exception, match="not unique"):
        r.apply_corrections(x, [(once, ["k"]), (twice, ["k"])]).collect()
    with pytest.raises(ValueError, match="not in the table"):
        r.apply_corrections(x, [(once, ["k"]), (once.withColumnRenamed("c", "new"), ["k"])])


@pytest.mark.parametrize("hot_rows", [None, 1])
@SLOW
@given(data=TABLE)
def test_fill_by_group(no_broadcast, spark, hot_rows, data):
    def known(k):
        return {c for key, c, _ in data if key == k and c is not None}

    want = [(k, next(iter(known(k))) if c is None and k is not None and len(known(k)) == 1 else c, i) for k, c, i in data]
    once = fill.fill_by_group(table(spark, data), ["k"], ["c"], hot_rows=hot_rows)
    assert rows(once) == sorted(want, key=repr)
    assert rows(fill.fill_by_group(once, ["k"], ["c"], hot_rows=hot_rows)) == sorted(want, key=repr)


def test_fill_by_group_can_stop_on_conflict(spark):
    with pytest.raises(Exception, match="several values"):
        fill.fill_by_group(table(spark, [("a", "x", 1), ("a", "y", 2)]), ["k"], ["c"], multiple="error").collect()


@pytest.mark.parametrize("sampled", [1, 2, 32])
@SLOW
@given(data=st.lists(st.tuples(KEY, VALUE), max_size=20), width=st.sampled_from([None, None, 1, 3, 50]))
def test_fill_down(no_broadcast, spark, monkeypatch, sampled, data, width):
    monkeypatch.setattr(fill, "SAMPLED", sampled)
    numbered = [(k, c, n) for n, (k, c) in enumerate(data)]
    last, want = {}, []
    for k, c, n in numbered:
        last[k] = c if c is not None else last.get(k)
        want.append((k, last[k], n))
    chunk = None if width is None else F.floor(F.col("i") / width)
    assert rows(fill.fill_down(table(spark, numbered), ["c"], ["k"], ["i"], chunk, hot_rows=3)) == sorted(want, key=repr)


def test_fill_down_hands_on_rows_without_order(no_broadcast, spark, monkeypatch):
    """Rows whose order is NULL sort first; their last value starts the next piece."""
    df = spark.createDataFrame([("k", None, "x")] + [("k", i, None) for i in range(1, 7)] + [("l", None, None), ("l", 3, "y"), ("l", 4, None)], "k string, i int, c string")
    monkeypatch.setattr(fill, "SAMPLED", 1)
    for hot_rows, chunk in ((3, F.floor(F.col("i") / 2)), (None, None), (3, None), (2, None)):
        out = fill.fill_down(df, ["c"], ["k"], ["i"], chunk, hot_rows=hot_rows)
        assert rows(out, "k", "i", "c") == sorted([("k", None, "x")] + [("k", i, "x") for i in range(1, 7)] + [("l", None, None), ("l", 3, "y"), ("l", 4, "y")], key=repr)


def test_a_hot_group_is_cut_evenly(no_broadcast, spark):
    """A third of all rows in one group, most of them in a small part of the order: no piece far above the mean."""
    n = 60_000
    events = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.when(F.col("id") % 5 == 0, F.col("id").cast("double")).otherwise(F.col("id") / n).alias("t"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("c"),
    )
    named = events.withColumn("__k0", F.col("k"))
    marked = fill.mark_hot(named, fill.hot_keys(["__k0"], 1000, __parts=named), ["__k0"], ["__parts"])
    cuts = fill._cuts(marked, ["__k0"], [F.col("t")], 1000)
    (places,) = cuts.collect()
    assert 17 <= len(places["__cuts"]) <= 23
    pieces = marked.where("k = 'hot'").join(F.broadcast(cuts), fill._same(["__k0"])).groupBy(fill._piece(F.col("__cuts"), F.struct("t")).alias("p")).count().collect()
    assert len(pieces) >= 19 and max(r["count"] for r in pieces) <= 2000
    plain = rows(fill.fill_down(events, ["c"], ["k"], ["t"], hot_rows=None))
    assert rows(fill.fill_down(events, ["c"], ["k"], ["t"], hot_rows=1000)) == plain


def test_pieces_are_found_by_binary_search(spark):
    cuts = [1, 3, 3, 10, 40]
    df = spark.range(-2, 50).select("id", F.array(*[F.struct(F.lit(c).cast("long")) for c in cuts]).alias("cuts"))
    out = df.select("id", fill._piece(F.col("cuts"), F.struct("id"))).collect()
    assert [p for _, p in out] == [sum(c <= i for c in cuts) for i, _ in out]


def test_fill_down_needs_a_group(spark):
    with pytest.raises(ValueError, match="group"):
        fill.fill_down(table(spark, []), ["c"], [], ["i"])


def test_fill_chain_holds_rows_out_and_keeps_all(spark):
    data = [("a", "x", 1), ("a", None, 1), ("a", None, 2), (None, None, 1), ("b", "custom", 2), ("b", None, 2)]
    held = F.col("c") == "custom"
    out = fill_from_peers(table(spark, data), [(["k"], ["c"]), (["i"], ["c"])], held_out=held)
    assert rows(out) == sorted([
        ("a", "x", 1), ("a", "x", 1), ("a", "x", 2), (None, "x", 1), ("b", "custom", 2), ("b", "x", 2),
    ], key=repr)


def test_union_checks_types_and_case(spark):
    one = spark.createDataFrame([("1", "u")], "id string, a string")
    two = spark.createDataFrame([("2", 5)], "id string, b int")
    assert rows(sets.union_sources([one, two, one]), "id", "a", "b") == [("1", "u", None), ("1", "u", None), ("2", None, 5)]
    with pytest.raises(TypeError, match="'a'"):
        sets.union_sources([one, two.withColumnRenamed("b", "a")])
    with pytest.raises(ValueError, match="case"):
        sets.union_sources([one, one.withColumnRenamed("a", "A")])
    assert rows(audits.row_conservation([one, two], sets.union_sources([one, two]))) == [(2, 2, True)]


@SLOW
@given(x=TABLE, y=TABLE)
def test_set_operations(spark, x, y):
    l, q = table(spark, x), table(spark, y)
    assert rows(sets.set_difference(l, q)) == sorted(set(x) - set(y), key=repr)
    sides = [(*t, "left") for t in set(x) - set(y)] + [(*t, "right") for t in set(y) - set(x)]
    assert rows(sets.one_sided(l, q)) == sorted(sides, key=repr)
    copies = [(*t, x.count(t), y.count(t)) for t in set(x) | set(y) if x.count(t) != y.count(t)]
    assert rows(sets.multiset_difference(l, q)) == sorted(copies, key=repr)
    allowed = {t[0] for t in y}
    covered = sum(t[0] in allowed for t in x)
    nulls = sum(t[0] is None for t in x)
    assert rows(sets.coverage(l, "k", q, "k")) == [(covered, len(x) - covered, nulls)]


def test_upsert_and_collisions(spark):
    base = table(spark, [("a", "x", 1), ("b", "y", 2)])
    new = table(spark, [("b", "z", 9), ("c", "w", 3)])
    assert rows(sets.upsert_union(new, base, ["k"])) == [("a", "x", 1), ("b", "z", 9), ("c", "w", 3)]
    names = spark.createDataFrame([("CD3.1",), ("CD3",), ("CD4.1",), ("CD4.1",)], "n string")
    assert rows(sets.collisions(names, "n", F.regexp_replace("n", r"\.1$", ""))) == [("CD3", 2, "CD3", "CD3.1")]


def test_group_reports(spark):
    data = [("a", "x", 1), ("a", None, 1), ("a", "x", 2), ("b", None, 1), ("b", None, 2)]
    df = table(spark, data)
    assert rows(a.collapse_groups(df, ["k"], ["c"])) == [("a", "NA, x"), ("b", None)]
    assert rows(a.null_census(df)) == [(0, 3, 0)]
    assert rows(a.conflicts(df, ["k"], "i")) == [("a", "1", 2, 2, 3), ("a", "2", 1, 2, 3), ("b", "1", 1, 2, 2), ("b", "2", 1, 2, 2)]
    assert rows(a.conflicts(df, ["k"], "c")) == []
    assert rows(a.groups_with_repeats(df, ["k"], "i")) == sorted([d for d in data if d[0] == "a"], key=repr)
    assert rows(a.repeated_in_group(df, ["k"], "c")) == sorted([data[0], data[2], data[3], data[4]], key=repr)
    assert rows(a.null_out_ambiguous(df, ["k", "i"], ["c"])) == sorted(
        [("a", None, 1), ("a", None, 1), ("a", "x", 2), ("b", None, 1), ("b", None, 2)], key=repr)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_groups_with_and_without_hot_ones(no_broadcast, spark, hot_rows):
    data = [("a", "x", 1), ("a", None, 1), ("a", "x", 2), ("b", "y", 1), (None, "z", 5), (None, "z", 6)]
    df = table(spark, data)
    size = {"a": 3, "b": 1, None: 2}
    assert rows(a.with_group_size(df, ["k"], hot_rows=hot_rows)) == sorted([(*d, size[d[0]]) for d in data], key=repr)
    several = a.groups_where(df, ["k"], F.count(F.lit(1)) > 1, hot_rows)
    assert rows(several) == sorted([d for d in data if d[0] != "b"], key=repr)
    assert rows(a.null_out_ambiguous(df, ["k"], ["c"], hot_rows)) == sorted([(k, c if k == "b" else None, i) for k, c, i in data], key=repr)


def scans(df):
    """Table scans in the plan as it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan")


def test_all_dependencies_come_from_one_scan(no_broadcast, spark, tmp_path):
    data = [(k, c, i) for k in "abc" for c in ("x", "y", None) for i in range(3)] + [("d", "x", 1), (None, "x", 9)]
    table(spark, data).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [(["k"], "c"), (["c"], "k"), (["k", "c"], "i"), (["i"], "c")]
    report = a.conflict_report(df, rules)
    want = []
    for determinant, dependent in rules:
        part = a.conflicts(df, determinant, dependent)
        want += [("+".join(determinant), dependent, "|".join(str(v) for v in row[: len(determinant)]), *row[len(determinant) :]) for row in rows(part)]
    assert rows(report) == sorted(want, key=repr)
    assert scans(report) == 1


def test_a_group_filter_joins_no_unwanted_rows(no_broadcast, spark, tmp_path):
    table(spark, [("a", "x", i) for i in range(40)] + [("b", "y", 1), ("c", "z", 1), ("c", "z", 2)]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plain = a.groups_where(df, ["k"], F.count(F.lit(1)) == 2, None)
    assert "LeftSemi" in (plan := plain._jdf.queryExecution().executedPlan().toString()) and "LeftOuter" not in plan
    for condition in (F.count(F.lit(1)) > 1, F.count(F.lit(1)) == 2, F.count(F.lit(1)) > 99):
        want = rows(a.groups_where(df, ["k"], condition, None))
        assert rows(a.groups_where(df, ["k"], condition, 5)) == want


def test_group_summary_is_computed_once(no_broadcast, spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, [("a", "x", 1), ("b", "y", 2)]).write.parquet(path)
    plan = fill.fill_by_group(spark.read.parquet(path), ["k"], ["c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3 and "NestedLoop" not in plan


def test_election_breaks_ties_by_preference_then_name(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("h", "q"), ("h", "q"), ("h", "p"), ("i", None)], "k string, n string")
    assert rows(a.elect(df, ["k"], "n", "std")) == [("g", "a"), ("h", "q")]
    assert rows(a.elect(df, ["k"], "n", "std", F.when(F.col("n") == "b", 0).otherwise(1))) == [("g", "b"), ("h", "q")]
