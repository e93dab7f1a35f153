"""Equi-joins with a stated NULL rule that survive hot keys.

Every join here is an equi-join, so Spark hashes or sorts; none falls back to a
nested loop. No side is broadcast by hint except the list of hot keys, which
has at most ``HOT_KEYS`` entries, and tables the caller declares
``small`` because their rows are written out in a program. All other sides are
left to Spark, which broadcasts by measured size and shuffles beyond it.

Hot keys. ``hot_rows`` is the number of rows of one key that a single task may
hold. Keys above it, the ``HOT_KEYS`` largest at most, are found by a map-side
combined count of the key columns and cut into rows / ``hot_rows`` sub-keys; the
rows of the other side with that key are repeated once per sub-key. The result is
the same with or without this, so the threshold only moves work. A row's sub-key
is a hash of its position in a scan, or, behind a shuffle, where positions may change
when a lost task runs again, a hash of its columns plus the number of its task: rows
spread whatever the input is partitioned by. Only copies of one row that an earlier
shuffle has brought into one task stay together. Where a side
surely is below Spark's own broadcast limit, Spark needs no shuffle on that account
and the count is left out; a large right side is then first reduced to the keys of
a small left one, by whatever join Spark finds best at run time.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, FractionalType

from tablemend.operators.columns import col
from tablemend.operators.guards import stop_on

HOT_ROWS = 1_000_000
#: Most keys that are cut; a key beyond these has fewer rows than a hundred-thousandth of the table.
HOT_KEYS = 100_000
#: How many times larger rows may be than the files they are read from.
INFLATION = 20

Key = str | tuple[str, str]

_MULTIPLYING = re.compile(r"^[\s:+|-]*(?:Generate|Join|Expand|ExternalRDD|LogicalRDD|MapIn|FlatMap)", re.MULTILINE)
_REARRANGING = re.compile(r"^[\s:+|-]*(?:Aggregate|Join|Distinct|Deduplicate|Window|Sort|Repartition|Generate|MapIn|FlatMap)", re.MULTILINE)


def broadcast_limit(df: DataFrame) -> int:
    """Spark's broadcast limit in bytes; negative if broadcasting is off."""
    value = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB").lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", value).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def known_small(df: DataFrame) -> bool:
    """Is the table surely below the broadcast limit?

    Plan statistics rest on the size of files, which may be compressed, and do not
    see rows multiply. So only plans without generators, joins and expansions count,
    with room for compression.
    """
    limit = broadcast_limit(df)
    try:
        query = df._jdf.queryExecution()
        # The plan as written tells most cases, and is there without being optimised.
        if limit < 0 or _MULTIPLYING.search(query.analyzed().toString()):
            return False
        plan = query.optimizedPlan()
        size = plan.stats().sizeInBytes()
    except AttributeError:
        # A client without a local plan cannot tell.
        return False
    if _MULTIPLYING.search(plan.toString()):
        return False
    return int(str(size)) * INFLATION <= limit


def key_pairs(on: str | Sequence[Key]) -> list[tuple[str, str]]:
    """Normalise join keys to (left name, right name) pairs."""
    keys = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else k for k in keys]


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have; a natural join needs at least one."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("natural join of tables without a shared column")
    return shared


def _equal(left: Column, right: Column, nulls: str) -> Column:
    if nulls not in ("match", "never"):
        raise ValueError(f"nulls must be 'match' or 'never', not {nulls!r}")
    return left.eqNullSafe(right) if nulls == "match" else left == right


def _all_equal(pairs: Sequence[tuple[Column, Column]], nulls: str) -> Column:
    condition = _equal(*pairs[0], nulls)
    for left, right in pairs[1:]:
        condition = condition & _equal(left, right, nulls)
    return condition


def key_names(n: int) -> list[str]:
    return [f"__k{i}" for i in range(n)]


def _with_keys(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return df.withColumns(dict(zip(key_names(len(keys)), keys)))


def hot_keys(keys: Sequence[str], hot_rows: int, **sides: DataFrame) -> DataFrame:
    """Keys with more than ``hot_rows`` rows on a side, with the number of sub-keys per side."""
    tagged = [
        df.select(*keys, *[F.lit(int(other == side)).alias(other) for other in sides])
        for side, df in sides.items()
    ]
    rows = tagged[0] if len(tagged) == 1 else tagged[0].unionAll(tagged[1])
    counts = rows.groupBy(*keys).agg(*[F.sum(side).alias(side) for side in sides])
    hot = [F.col(side) > hot_rows for side in sides]
    is_hot = hot[0] if len(hot) == 1 else hot[0] | hot[1]
    largest = counts.where(is_hot).orderBy(F.greatest(*sides, F.lit(0)).desc(), *keys).limit(HOT_KEYS)
    return largest.select(
        *[F.col(k).alias(f"{k}_hot") for k in keys],
        *[F.ceil(F.col(side) / hot_rows).cast("int").alias(side) for side in sides],
    )


def mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str], sides: Sequence[str]) -> DataFrame:
    """Look the number of sub-keys up in the short list of hot keys; 1 if the key is not hot."""
    condition = _all_equal([(F.col(k), F.col(f"{k}_hot")) for k in keys], "match")
    marked = df.join(F.broadcast(hot), condition, "left").drop(*[f"{k}_hot" for k in keys])
    return marked.withColumns({s: F.greatest(F.coalesce(F.col(s), F.lit(1)), F.lit(1)) for s in sides})


def _any_null(keys: Sequence[str]) -> Column:
    out = F.col(keys[0]).isNull()
    for k in keys[1:]:
        out = out | F.col(k).isNull()
    return out


def in_scan_order(df: DataFrame) -> bool:
    """Are the rows as a scan gives them, in the same order whenever a task runs again?"""
    try:
        query = df._jdf.queryExecution()
        if _REARRANGING.search(query.analyzed().toString()):
            return False
        plan = query.optimizedPlan().toString()
    except AttributeError:
        return False
    nodes = re.findall(r"^[\s:+|-]*(\w+)", plan, re.MULTILINE)
    return set(nodes) <= {"Project", "Filter", "Relation", "LocalRelation", "Range", "Union", "true"}


def _spread(df: DataFrame, parts: Column, sub_key: str, unmatchable: Column | None = None, scanned: bool = False) -> DataFrame:
    """Give each row one of its key's sub-keys; rows that meet no partner need not stay together.

    ``scanned`` says that the rows are in scan order, so that their position is a
    stable number; else their columns are hashed.
    """
    task = F.spark_partition_id()
    if scanned:
        mixed = F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts)
    else:
        hashable = [F.col(f"`{n}`") for n, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        mixed = F.pmod(F.pmod(F.xxhash64(*hashable), parts) + F.pmod(task, parts), parts)
    chosen = F.when(parts > 1, mixed.cast("int")).otherwise(F.lit(0))
    return df.withColumn(sub_key, chosen if unmatchable is None else F.when(unmatchable, task).otherwise(chosen))


def _repeat(df: DataFrame, parts: Column, sub_key: str) -> DataFrame:
    """Repeat each row once per sub-key of its key."""
    return df.withColumn(sub_key, F.explode(F.sequence(F.lit(0), parts - 1)))


def _meeting(large: DataFrame, large_keys: Sequence[str], small: DataFrame, small_keys: Sequence[str], nulls: str) -> DataFrame:
    """The rows of a large table that meet a small one."""
    wanted = small.select(*[F.col(k).alias(f"{k}_wanted") for k in small_keys]).distinct()
    condition = _all_equal([(F.col(a), F.col(f"{b}_wanted")) for a, b in zip(large_keys, small_keys)], nulls)
    return large.join(wanted, condition, "left_semi")


def _left_keyed(
    left: DataFrame,
    right: DataFrame,
    n_keys: int,
    nulls: str,
    hot_rows: int | None,
    right_unique: bool,
    counted: DataFrame | None = None,
    unmatchable: Column | None = None,
) -> DataFrame:
    """Left join of ``__k*`` on the left with ``__r*`` on the right; adds ``__hit``.

    ``counted`` replaces the left table when counting keys, and ``unmatchable``
    tells which left rows cannot meet any partner, so may go to any task.
    """
    keys = key_names(n_keys)
    right_keys = [f"__r{i}" for i in range(n_keys)]
    right = right.withColumn("__hit", F.lit(True))
    if nulls == "never":
        right = right.dropna(subset=right_keys)
    pairs = [(F.col(a), F.col(b)) for a, b in zip(keys, right_keys)]
    plain = hot_rows is None or known_small(right)
    if not plain and known_small(left):
        right = _meeting(right, right_keys, left, keys, nulls)
        plain = right_unique
    if plain:
        return left.join(right, _all_equal(pairs, nulls), "left").drop(*right_keys)

    counted = (left if counted is None else counted).select(*keys)
    if nulls == "never":
        counted = counted.where(~_any_null(keys))
        loose = _any_null(keys)
        unmatchable = loose if unmatchable is None else unmatchable | loose
    sides = {"__lhot": counted}
    if not right_unique:
        sides["__rhot"] = right.select(*[F.col(r).alias(k) for k, r in zip(keys, right_keys)])
    hot = hot_keys(keys, hot_rows, **sides)

    left_scanned, right_scanned = in_scan_order(left), in_scan_order(right)
    left = mark_hot(left, hot, keys, list(sides))
    left = _spread(left, F.col("__lhot"), "__ls", None if unmatchable is None else F.coalesce(unmatchable, F.lit(False)), left_scanned)
    right = right.withColumnsRenamed(dict(zip(right_keys, keys)))
    right = mark_hot(right, hot, keys, list(sides))
    if not right_unique:
        right = _spread(right, F.col("__rhot"), "__rs", scanned=right_scanned).drop("__rhot")
        left = _repeat(left, F.col("__rhot"), "__lrs")
    right = _repeat(right, F.col("__lhot"), "__rls").drop("__lhot")
    right = right.withColumnsRenamed(dict(zip(keys, right_keys)))

    condition = _all_equal(pairs, nulls) & (F.col("__ls") == F.col("__rls"))
    if not right_unique:
        condition = condition & (F.col("__lrs") == F.col("__rs"))
    joined = left.join(right, condition, "left")
    if not right_unique:
        # A key that is hot on the right has partners; a repeat without one is no result.
        joined = joined.where((F.col("__rhot") == 1) | F.col("__hit"))
    return joined.drop(*right_keys, "__lhot", "__rhot", "__ls", "__rls", "__lrs", "__rs")


def _payload(left: DataFrame, right: DataFrame, right_keys: Sequence[str], suffix: str | None) -> dict[str, str]:
    """Right columns to carry over: old name → name in the result."""
    names = {}
    for c in right.columns:
        if c in right_keys:
            continue
        if c in left.columns and suffix is None:
            raise ValueError(f"both tables have column {c!r}; give a suffix")
        names[c] = c + suffix if c in left.columns else c
        if c in left.columns and names[c] in left.columns:
            raise ValueError(f"column {names[c]!r} already exists")
    return names


def _right_side(right: DataFrame, pairs: Sequence[tuple[str, str]], names: dict[str, str]) -> DataFrame:
    return right.select(
        *[col(r).alias(f"__r{i}") for i, (_, r) in enumerate(pairs)],
        *[col(old).alias(new) for old, new in names.items()],
    )


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[Key],
    nulls: str = "match",
    suffix: str | None = "_right",
    small: bool = False,
    right_unique: bool = False,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Every left row with the matching right rows, or NULLs.

    ``nulls='match'`` lets a NULL key meet a NULL key. Right columns whose name
    the left table already has get ``suffix``. ``small`` says the right rows are
    written out in a program, so they may be broadcast. ``counted`` is a table with
    the same key values as the left one that is cheaper to count hot keys in, such
    as the left table before other columns were joined to it.
    """
    pairs = key_pairs(on)
    names = _payload(left, right, [r for _, r in pairs], suffix)
    keyed = _with_keys(left, [col(l) for l, _ in pairs])
    side = _right_side(right, pairs, names)
    if small:
        side, hot_rows = F.broadcast(side), None
    if counted is not None:
        counted = _with_keys(counted, [col(l) for l, _ in pairs])
    joined = _left_keyed(keyed, side, len(pairs), nulls, hot_rows, right_unique, counted)
    return joined.select(*[col(c) for c in left.columns], *[col(c) for c in names.values()])


def attach_groups(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    nulls: str = "match",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add aggregates of the row's own group, without bringing a group together.

    The groups are summed up once, combined on the map side. Summaries of groups
    with more than ``hot_rows`` rows are few enough to broadcast; the others are
    joined by key. With ``nulls='never'`` rows with a NULL key have no group.
    """
    names = key_names(len(keys))
    keyed = _with_keys(df, [col(k) for k in keys])
    grouped = keyed if nulls == "match" else keyed.dropna(subset=names)
    summary = grouped.groupBy(*names).agg(
        F.count(F.lit(1)).alias("__size"), *[a.alias(f"__agg_{n}") for n, a in aggregates.items()]
    )
    values = [f"__agg_{n}" for n in aggregates]

    def side(groups: DataFrame, mark: str) -> DataFrame:
        return groups.select(
            *[F.col(k).alias(f"{k}{mark}") for k in names], F.lit(0).alias(f"__sub{mark}"), *[F.col(v).alias(f"{v}{mark}") for v in values]
        )

    def meeting(mark: str) -> Column:
        return _all_equal([(F.col(k), F.col(f"{k}{mark}")) for k in names], nulls)

    if hot_rows is None or known_small(summary):
        joined = keyed.join(side(summary, "_all"), meeting("_all"), "left")
        value = {n: F.col(f"__agg_{n}_all") for n in aggregates}
    else:
        hot, rest = side(summary.where(F.col("__size") > hot_rows), "_hot"), side(summary.where(F.col("__size") <= hot_rows), "_rest")
        marked = keyed.join(F.broadcast(hot), meeting("_hot"), "left")
        done = F.col("__sub_hot").isNotNull()
        done = done if nulls == "match" else done | _any_null(names)
        # Finished rows wait for no partner, so they stay where they are read.
        marked = marked.withColumn("__sub", F.when(done, F.spark_partition_id() + 1).otherwise(F.lit(0)))
        joined = marked.join(rest, meeting("_rest") & (F.col("__sub") == F.col("__sub_rest")), "left")
        value = {n: F.coalesce(F.col(f"__agg_{n}_hot"), F.col(f"__agg_{n}_rest")) for n in aggregates}
    return joined.select(*[col(c) for c in df.columns], *[v.alias(n) for n, v in value.items()])


def rows_of_groups(df: DataFrame, keys: Sequence[str], condition: Column, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows of the groups for which an aggregate condition holds.

    The groups are summed up once, combined on the map side, and only the summary is filtered; its groups
    meet the rows in a semi join that passes nothing but the rows wanted. The summary tells the hot groups too:
    their rows are cut into sub-keys if wanted, and dropped before the shuffle if not.
    """
    names = key_names(len(keys))
    keyed = _with_keys(df, [col(k) for k in keys])
    summary = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__size"), condition.alias("__keep"))
    kept = summary.where("__keep")
    wanted = kept.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(names)])
    pairs = [(F.col(k), F.col(r)) for k, r in zip(names, wanted.columns)]
    if hot_rows is None or known_small(summary):
        return keyed.join(wanted, _all_equal(pairs, "match"), "left_semi").select(*[col(c) for c in df.columns])
    parts = F.ceil(F.col("__size") / hot_rows).cast("int")
    # As many rows as hot_rows goes into the table at most; a group that is not wanted has no sub-key.
    hot = summary.where(F.col("__size") > hot_rows).select(
        *[F.col(k).alias(f"{k}_hot") for k in names], F.when(F.col("__keep"), parts).otherwise(F.lit(0)).alias("__parts")
    )
    met = _all_equal([(F.col(k), F.col(f"{k}_hot")) for k in names], "match")
    scanned = in_scan_order(keyed)
    marked = keyed.join(F.broadcast(hot), met, "left").where("__parts IS NULL OR __parts > 0").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    marked = _spread(marked.drop(*[f"{k}_hot" for k in names]), F.col("__parts"), "__ls", scanned=scanned)
    own = F.when(F.col("__size") > hot_rows, parts).otherwise(F.lit(1))
    wanted = kept.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(names)], F.explode(F.sequence(F.lit(0), own - 1)).alias("__rls"))
    return marked.join(wanted, _all_equal(pairs, "match") & (F.col("__ls") == F.col("__rls")), "left_semi").select(*[col(c) for c in df.columns])


def _exists(left: DataFrame, right: DataFrame, on, nulls: str, how: str, small: bool, hot_rows: int | None, right_unique: bool = False) -> DataFrame:
    pairs = key_pairs(on)
    keyed = _with_keys(left, [col(l) for l, _ in pairs])
    keys = key_names(len(pairs))
    side = right.select(*[col(r).alias(f"__r{i}") for i, (_, r) in enumerate(pairs)])
    right_keys = side.columns
    plain = small or hot_rows is None or known_small(side)
    if not plain and known_small(keyed):
        side = _meeting(side, right_keys, keyed, keys, nulls)
        plain = True
    side = side if right_unique else side.distinct()
    if nulls == "never":
        side = side.dropna()
    condition = _all_equal([(F.col(a), F.col(b)) for a, b in zip(keys, right_keys)], nulls)
    if small:
        side = F.broadcast(side)
    elif not plain:
        hot = hot_keys(keys, hot_rows, __lhot=keyed)
        scanned = in_scan_order(keyed)
        keyed = mark_hot(keyed, hot, keys, ["__lhot"])
        keyed = _spread(keyed, F.col("__lhot"), "__ls", None if nulls == "match" else _any_null(keys), scanned)
        side = mark_hot(side.toDF(*keys), hot, keys, ["__lhot"])
        side = _repeat(side, F.col("__lhot"), "__rls").drop("__lhot").withColumnsRenamed(dict(zip(keys, right_keys)))
        condition = condition & (F.col("__ls") == F.col("__rls"))
    return keyed.join(side, condition, how).select(*[col(c) for c in left.columns])


def semi_join(
    left, right, on, nulls: str = "match", small: bool = False, right_unique: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Left rows that have a partner; the right side is reduced to distinct keys first."""
    return _exists(left, right, on, nulls, "left_semi", small, hot_rows, right_unique)


def anti_join(left, right, on=None, nulls: str = "match", small: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Left rows without a partner; without ``on`` all shared columns are the key."""
    return _exists(left, right, shared_columns(left, right) if on is None else on, nulls, "left_anti", small, hot_rows)


def full_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[Key] | None = None,
    nulls: str = "match",
    suffix: str | None = "_right",
    right_unique: bool = False,
    one_to_many: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All rows of both tables; without ``on`` all shared columns are the key.

    ``one_to_many`` states that no right row meets two left rows; the job stops if one does.
    One count of both sides finds the hot keys; both sides are then cut into sub-keys as
    in a left join, and Spark's own full join runs over (key, sub-key). A row of a hot key
    whose partners lie in other sub-keys only is left out there, as its key is known to
    have partners. ``hot_rows=None`` leaves the join wholly to Spark.
    """
    pairs = key_pairs(shared_columns(left, right) if on is None else on)
    names = _payload(left, right, [r for _, r in pairs], suffix)
    if one_to_many:
        whole = full_join(left, right, pairs, nulls, suffix, right_unique, hot_rows=hot_rows)
        return stop_on(whole, repeated_partners(left, right, pairs, nulls), "a right row meets more than one left row")
    keys = key_names(len(pairs))
    keyed = _with_keys(left, [col(l) for l, _ in pairs])
    side = _right_side(right, pairs, names)
    right_keys = side.columns[: len(pairs)]
    condition = _all_equal([(F.col(a), F.col(b)) for a, b in zip(keys, right_keys)], nulls)
    stray = F.lit(False)
    if hot_rows is not None and not (known_small(keyed) and known_small(side)):
        keyed, side = _cut_both(keyed, side, keys, right_keys, nulls, hot_rows)
        condition = condition & (F.col("__ls") == F.col("__rls")) & (F.col("__lrs") == F.col("__rs"))
        # A hot key with rows on both sides has partners; what found none in its sub-key is no result.
        stray = F.coalesce((F.col("__rs").isNull() & F.col("__lmet")) | (F.col("__ls").isNull() & F.col("__rmet")), F.lit(False))
    merged = {l: F.coalesce(col(l), F.col(r)) for (l, _), r in zip(pairs, right_keys)}
    return keyed.join(side, condition, "full").where(~stray).select(
        *[merged.get(c, col(c)).alias(c) for c in left.columns], *[col(c) for c in names.values()]
    )


def _cut_both(keyed: DataFrame, side: DataFrame, keys: Sequence[str], right_keys: Sequence[str], nulls: str, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Sub-keys for both sides of a full join, and for each row whether its key is hot and has rows on both sides."""
    left_scanned, right_scanned = in_scan_order(keyed), in_scan_order(side)
    renamed = side.withColumnsRenamed(dict(zip(right_keys, keys)))
    counted = [d.select(*keys) if nulls == "match" else d.select(*keys).dropna() for d in (keyed, renamed)]
    hot = hot_keys(keys, hot_rows, __lhot=counted[0], __rhot=counted[1])
    both = (F.col("__lhot") > 0) & (F.col("__rhot") > 0)
    hot = hot.withColumn("__met", both).withColumn("__lhot", F.greatest("__lhot", F.lit(1))).withColumn("__rhot", F.greatest("__rhot", F.lit(1)))
    loose = None if nulls == "match" else _any_null(keys)

    def cut(df: DataFrame, own: str, other: str, sub: str, repeated: str, met: str, scanned: bool) -> DataFrame:
        marked = mark_hot(df, hot, keys, ["__lhot", "__rhot"]).withColumnRenamed("__met", met)
        # Without partners a row need not be repeated.
        times = F.when(F.coalesce(F.col(met), F.lit(False)), F.col(other)).otherwise(F.lit(1))
        return _repeat(_spread(marked, F.col(own), sub, loose, scanned), times, repeated).drop("__lhot", "__rhot")

    left = cut(keyed, "__lhot", "__rhot", "__ls", "__lrs", "__lmet", left_scanned)
    right = cut(renamed, "__rhot", "__lhot", "__rs", "__rls", "__rmet", right_scanned)
    return left, right.withColumnsRenamed(dict(zip(keys, right_keys)))


def in_column(df: DataFrame, column: str, values: DataFrame, value_column: str, flag: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add a boolean: does the value occur in another table's column? Never NULL."""
    seen = values.select(col(value_column).alias(column)).distinct().withColumn(flag, F.lit(True))
    joined = left_join(df, seen, column, right_unique=True, hot_rows=hot_rows)
    return joined.withColumn(flag, F.coalesce(col(flag), F.lit(False)))


def conflict_probe(x: DataFrame, y: DataFrame, same: str, differs: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows of ``x`` whose ``same`` value occurs in ``y`` while their ``differs`` value does not."""
    return anti_join(semi_join(x, y, same, hot_rows=hot_rows), y, differs, hot_rows=hot_rows)


def join_any(
    x: DataFrame,
    y: DataFrame,
    keys: Sequence[Key],
    nulls: str = "never",
    pass_column: str | None = None,
    right_unique: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left join on the first key that matches; each key is tried only for rows still unmatched.

    A join on ``a = a OR b = b`` would be a nested loop. Here the distinct key
    combinations of ``x`` and the rows of ``y`` become (pass, key) rows that meet in one
    equi-join, whatever the number of keys; the first pass of each combination is then
    joined back, so ``x`` itself is shuffled once. ``y``'s key columns are not carried over.
    """
    return _passes(x, y, [[k] for k in keys], nulls, pass_column, right_unique, hot_rows)


def _passes(x, y, passes, nulls, pass_column, right_unique, hot_rows) -> DataFrame:
    pass_pairs = [key_pairs(p) for p in passes]
    payload = _cascade_payload(x, y, pass_pairs)
    lefts, found = first_matches(x, y, passes, payload, nulls, right_unique)
    return _attached(x, lefts, found, payload, pass_pairs, nulls, pass_column, right_unique, hot_rows)


def _cascade_payload(x: DataFrame, y: DataFrame, pass_pairs) -> list[str]:
    right_keys = {r for pairs in pass_pairs for _, r in pairs}
    payload = [c for c in y.columns if c not in right_keys]
    clash = [c for c in payload if c in x.columns]
    if clash:
        raise ValueError(f"both tables have {clash}; rename or drop them first")
    return payload


def _key_text(name: str, kind: DataType, nulls: str) -> Column:
    """A key as text of a type that both sides have in common; equal texts are equal keys."""
    value = col(name).cast(kind)
    if isinstance(kind, FractionalType):
        # No negative zero.
        value = value + F.lit(0).cast(kind)
    text = value.cast("string") if isinstance(kind, AtomicType) else F.to_json(F.struct(value))
    return text if nulls == "never" else F.coalesce(F.concat(F.lit("="), text), F.lit("-"))


def _pass_rows(df: DataFrame, keys: Sequence[Sequence[Column]], kept: Sequence[Column]) -> DataFrame:
    """A row for each pass whose keys are known: __pass, and its keys as __k0, __k1, ..."""
    width = max(len(k) for k in keys)
    choices = []
    for number, values in enumerate(keys, start=1):
        named = [v.alias(n) for v, n in zip([*values, *[F.lit("")] * (width - len(values))], key_names(width))]
        known = values[0].isNotNull()
        for v in values[1:]:
            known = known & v.isNotNull()
        choices.append(F.when(known, F.struct(F.lit(number).alias("__pass"), *named)))
    return df.select(*kept, F.inline(F.array_compact(F.array(*choices))))


def first_matches(
    x: DataFrame,
    y: DataFrame,
    passes: Sequence[str | Sequence[Key]],
    payload: Sequence[str],
    nulls: str = "never",
    right_unique: bool = False,
) -> tuple[list[str], DataFrame]:
    """What a cascade attaches to each key combination of ``x``: the names of the keys, and a table of
    them (as ``__c0``, ``__c1``, ...) with ``__pass`` and the ``payload`` columns of the ``y`` rows as ``__found``.

    Combinations that match nothing are left out.
    """
    if nulls not in ("match", "never"):
        raise ValueError(f"nulls must be 'match' or 'never', not {nulls!r}")
    pass_pairs = [key_pairs(p) for p in passes]
    lefts = list(dict.fromkeys(l for pairs in pass_pairs for l, _ in pairs))
    places = {l: f"__c{i}" for i, l in enumerate(lefts)}
    combinations = x.select(*[col(l).alias(c) for l, c in places.items()]).distinct()
    kinds, x_types, y_types = {}, x.schema, y.schema
    for l, r in {pair for pairs in pass_pairs for pair in pairs}:
        one, other = x_types[l].dataType, y_types[r].dataType
        kinds[l, r] = one
        if one != other:
            both = F.coalesce(F.lit(None).cast(one), F.lit(None).cast(other))
            kinds[l, r] = x.sparkSession.range(0).select(both.alias("k")).schema["k"].dataType
    left_keys = [[_key_text(places[l], kinds[l, r], nulls) for l, r in pairs] for pairs in pass_pairs]
    right_keys = [[_key_text(r, kinds[l, r], nulls) for l, r in pairs] for pairs in pass_pairs]
    asked = _pass_rows(combinations, left_keys, [F.col(c) for c in places.values()])
    packed = F.struct(F.lit(True).alias("__present"), *[col(c) for c in payload]).alias("__found")
    told = _pass_rows(y, right_keys, [packed])
    keys = [c for c in asked.columns if c not in places.values()]
    names = key_names(len(keys))
    asked = _with_keys(asked.withColumnsRenamed({k: f"__t_{k}" for k in keys}), [F.col(f"__t_{k}") for k in keys])
    told = told.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(keys)})
    # An inner join of key rows: Spark splits either side where it is skewed, so no keys need be counted.
    met = _left_keyed(asked, told, len(keys), "never", None, right_unique).where("__hit").drop("__hit", *names)
    met = met.withColumnRenamed("__t___pass", "__pass").select(*places.values(), "__pass", "__found")
    if right_unique:
        return lefts, met.groupBy(*places.values()).agg(F.min("__pass").alias("__pass"), F.min_by("__found", "__pass").alias("__found"))
    first = met.groupBy(*[F.col(c).alias(f"{c}_of") for c in places.values()]).agg(F.min("__pass").alias("__first"))
    own = _all_equal([(F.col(c), F.col(f"{c}_of")) for c in places.values()], "match") & (F.col("__pass") == F.col("__first"))
    return lefts, met.join(first, own, "left_semi")


def _attached(x, lefts, found, payload, pass_pairs, nulls, pass_column, right_unique, hot_rows) -> DataFrame:
    """The rows of ``x`` with what their key combination found."""
    side = found.withColumnsRenamed({f"__c{i}": f"__r{i}" for i in range(len(lefts))})
    unmatchable = None
    if nulls == "never":
        open_pass = [[col(l).isNotNull() for l, _ in pairs] for pairs in pass_pairs]
        unmatchable = ~F.greatest(*[F.least(*p, F.lit(True)) for p in open_pass], F.lit(False))
    out = _left_keyed(_with_keys(x, [col(l) for l in lefts]), side, len(lefts), "match", hot_rows, right_unique, unmatchable=unmatchable)
    extra = [] if pass_column is None else [F.col("__pass").alias(pass_column)]
    return out.select(*[col(c) for c in x.columns], *[F.col("__found")[c].alias(c) for c in payload], *extra)


def match_cascade(
    x: DataFrame,
    y: DataFrame,
    passes: Sequence[str | Sequence[Key]],
    name: str,
    nulls: str = "never",
    pass_column: str | None = None,
    append_rest: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Try key sets from strong to weak, then append the ``y`` rows whose ``name`` was never used."""
    if not append_rest:
        return _passes(x, y, passes, nulls, pass_column, False, hot_rows)
    pass_pairs = [key_pairs(p) for p in passes]
    payload = _cascade_payload(x, y, pass_pairs)
    lefts, found = first_matches(x, y.withColumn("__own_name", col(name)), passes, [*payload, "__own_name"], nulls)
    matched = _attached(x, lefts, found, payload, pass_pairs, nulls, pass_column, False, hot_rows)
    rest = anti_join(y, found.select(F.col("__found.__own_name").alias("__own_name")), [(name, "__own_name")], hot_rows=hot_rows)
    kept = [c for c in rest.columns if c in matched.columns]
    return matched.unionByName(rest.select(*[col(c) for c in kept]), allowMissingColumns=True)


def unused_rows(
    x: DataFrame,
    y: DataFrame,
    passes: Sequence[str | Sequence[Key]],
    on: Sequence[str],
    nulls: str = "never",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The ``y`` rows whose ``on`` values a cascade would attach to no row of ``x``.

    ``on`` may name keys too: they are compared as the ``y`` rows have them. What a
    cascade attaches depends on the keys alone, so it runs over the distinct key
    combinations of ``x``, not over its rows again.
    """
    own = {c: f"__own_{c}" for c in on}
    marked = y.withColumns({copy: col(c) for c, copy in own.items()})
    _, found = first_matches(x, marked, passes, list(own.values()), nulls)
    used = found.select(*[F.col("__found")[copy].alias(copy) for copy in own.values()])
    return anti_join(y, used, list(own.items()), hot_rows=hot_rows)


def repeated_partners(left: DataFrame, right: DataFrame, on: str | Sequence[Key], nulls: str = "match") -> DataFrame:
    """Audit of a one-to-many contract: left keys that repeat and also occur on the right."""
    pairs = key_pairs(on)
    repeated = left.groupBy(*[col(l) for l, _ in pairs]).agg(F.count(F.lit(1)).alias("n_left")).where("n_left > 1")
    return semi_join(repeated, right, pairs, nulls, hot_rows=None)
