"""Fill missing values from earlier rows or from peers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.operators.columns import col
from tablemend.operators.guards import fail_if
from tablemend.operators.joins import HOT_ROWS, attach_groups, hot_keys, key_names, known_small, mark_hot


#: Most pieces that a group is cut into, and sampled rows for each piece.
PIECES = 1 << 13
SAMPLED = 32


def fill_down(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Carry the last known value down within each group, in the given order.

    A group with more than ``hot_rows`` rows is cut into ordered pieces, `PIECES` at most, at places of the
    order drawn from a sample of its rows. Each piece is filled on its own, and the value to start with comes from
    a table with one row per piece, so no task holds a whole hot group. Rows with equal order stay in one piece.
    ``chunk`` gives the pieces instead: a function of ``order`` that never falls, such as the minute of a time
    stamp, and NULL only for the rows that sort first.
    """
    keys = [col(b) for b in by]
    ordering = [col(o) for o in order]
    if not keys:
        raise ValueError("fill_down needs a group; without one all rows would meet in one task")
    if hot_rows is None or known_small(df):
        window = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(col(c), ignorenulls=True).over(window) for c in columns})

    named = key_names(len(keys))
    keyed = df.withColumns(dict(zip(named, keys)))
    hot = hot_keys(named, hot_rows, __parts=keyed)
    marked = mark_hot(keyed, hot, named, ["__parts"])
    if chunk is None:
        marked = marked.join(F.broadcast(_cuts(marked, named, ordering, hot_rows)), _same(named), "left").drop(*[f"{n}_cut" for n in named])
        chunk = _piece(F.col("__cuts"), F.struct(*ordering))
    # Being hot is a column of its own: a NULL piece holds the rows whose order is NULL, which sort first.
    cut = marked.withColumns({"__hot": F.col("__parts") > 1, "__piece": F.when(F.col("__parts") > 1, chunk)}).drop("__parts", "__cuts", *named)
    position = F.struct(*ordering)
    tails = cut.where("__hot").groupBy(*keys, "__hot", "__piece").agg(
        *[F.max_by(col(c), F.when(col(c).isNotNull(), position)).alias(f"__tail_{c}") for c in columns]
    )
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = tails.select(
        *keys, "__hot", "__piece", *[F.last(F.col(f"__tail_{c}"), ignorenulls=True).over(before).alias(c) for c in columns]
    )
    # The start of a piece is one more row that sorts first: one shuffle, no join back.
    rows = cut.withColumn("__row", F.lit(1)).unionByName(starts.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    inside = (
        Window.partitionBy(*keys, "__hot", "__piece").orderBy("__row", *ordering).rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = rows.withColumns({c: F.last(col(c), ignorenulls=True).over(inside) for c in columns})
    return filled.where("__row = 1").select(*[col(c) for c in df.columns])


def _same(named: Sequence[str]) -> Column:
    condition = F.lit(True)
    for n in named:
        condition = condition & F.col(n).eqNullSafe(F.col(f"{n}_cut"))
    return condition


def _cuts(marked: DataFrame, named: Sequence[str], ordering: Sequence[Column], hot_rows: int) -> DataFrame:
    """For each hot group the places where its pieces begin: every `SAMPLED`-th of a sample, which a hash of the order draws.

    As many places in all as hot_rows goes into the rows at most. The sample depends on the values alone, not on the place of rows.
    """
    pieces = F.least(F.col("__parts"), F.lit(PIECES))
    share = SAMPLED * pieces / (F.col("__parts") * hot_rows)
    drawn = marked.where("__parts > 1").where(F.pmod(F.xxhash64(F.lit("cut"), *ordering), F.lit(1 << 40)) < share * (1 << 40))
    sample = drawn.groupBy(*[F.col(n).alias(f"{n}_cut") for n in named]).agg(F.array_sort(F.collect_list(F.struct(*ordering))).alias("s"))
    spaced = F.filter("s", lambda _, i: (i + 1) % SAMPLED == 0)
    return sample.select(*[f"{n}_cut" for n in named], F.array_distinct(spaced).alias("__cuts"))


def _piece(cuts: Column, position: Column) -> Column:
    """How many cuts lie at or before a position, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(PIECES.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= position, at + step).otherwise(at))


def fill_by_group(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    multiple: str = "ignore",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Copy a group's only known value into its NULLs.

    A group with several values is left alone, or stops the job with
    ``multiple='error'``. Rows with a NULL in the group key belong to no group.
    The known values come from a combined aggregation that is joined back; the
    rows of one group never have to meet.
    """
    if multiple not in ("ignore", "error"):
        raise ValueError(f"multiple must be 'ignore' or 'error', not {multiple!r}")
    bounds = {}
    for c in columns:
        bounds[f"__low_{c}"], bounds[f"__high_{c}"] = F.min(col(c)), F.max(col(c))
    joined = attach_groups(df, list(group), bounds, nulls="never", hot_rows=hot_rows)
    for c in columns:
        low, high = col(f"__low_{c}"), col(f"__high_{c}")
        if multiple == "error":
            joined = joined.where(fail_if(low != high, f"several values of {c} in one group"))
        joined = joined.withColumn(c, F.coalesce(col(c), F.when(low == high, low)))
    return joined.select(*[col(c) for c in df.columns])
