"""Row updates: correct a table from a patch table with unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.operators.columns import col
from tablemend.operators.guards import fail_if, stop_on
from tablemend.operators.joins import HOT_ROWS, anti_join, left_join


def duplicate_keys(y: DataFrame, by: Sequence[str]) -> DataFrame:
    """Patch keys that occur more than once, with their number."""
    return y.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unmatched_rows(x: DataFrame, y: DataFrame, by: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Patch rows whose key does not occur in the table."""
    return anti_join(y, x, list(by), hot_rows=hot_rows)


def unique_keys(y: DataFrame, by: Sequence[str]) -> DataFrame:
    """The patch table, checked while it runs: a repeated key stops the job."""
    values = [c for c in y.columns if c not in by]
    checked = y.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(1).alias("__one"), *[col(c) for c in values])).alias("__v")
    )
    checked = checked.where(fail_if(F.col("__n") > 1, f"patch key ({', '.join(by)}) is not unique"))
    return checked.select(*[col(b) for b in by], *[F.col("__v")[c].alias(c) for c in values])


def _apply(x, y, by, unmatched, small, check_unique, hot_rows, counted, choose) -> DataFrame:
    if unmatched not in ("ignore", "error"):
        raise ValueError(f"unmatched must be 'ignore' or 'error', not {unmatched!r}")
    by = list(by)
    values = [c for c in y.columns if c not in by]
    absent = [c for c in y.columns if c not in x.columns]
    if absent or not values:
        raise ValueError(f"patch columns {absent} are not in the table" if absent else "the patch sets no column")
    patch = unique_keys(y, by) if check_unique else y
    patch = patch.select(*[col(b) for b in by], *[col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__patched"))
    joined = left_join(x, patch, by, small=small, right_unique=True, hot_rows=hot_rows, counted=counted)
    types = dict(x.dtypes)
    hit = F.coalesce(F.col("__patched"), F.lit(False))
    out = joined.select(*[
        choose(hit, col(c), col(f"__new_{c}").cast(types[c])).alias(c) if c in values else col(c) for c in x.columns
    ])
    if unmatched == "error":
        out = stop_on(out, unmatched_rows(x, y, by, hot_rows), f"patch key ({', '.join(by)}) not in the table")
    return out


def rows_update(
    x, y, by: Sequence[str], unmatched: str = "ignore", small: bool = False, check_unique: bool = True,
    hot_rows: int | None = HOT_ROWS, counted: DataFrame | None = None,
) -> DataFrame:
    """Overwrite the patched columns in matching rows, also with NULL; a NULL key meets a NULL key.

    Rows without a patch and the number of rows stay as they are. A patch row
    without a target is skipped (see ``unmatched_rows``) or, with
    ``unmatched='error'``, stops the job.
    """
    return _apply(x, y, by, unmatched, small, check_unique, hot_rows, counted, lambda hit, old, new: F.when(hit, new).otherwise(old))


def rows_patch(
    x, y, by: Sequence[str], unmatched: str = "ignore", small: bool = False, check_unique: bool = True,
    hot_rows: int | None = HOT_ROWS, counted: DataFrame | None = None,
) -> DataFrame:
    """Like ``rows_update``, but only fills values that are NULL."""
    return _apply(x, y, by, unmatched, small, check_unique, hot_rows, counted, lambda hit, old, new: F.coalesce(old, new))


def apply_corrections(x: DataFrame, corrections: Sequence[tuple[DataFrame, Sequence[str]]], small: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Updates applied in order, each with its own key; later ones see earlier results.

    Updates with equal keys are folded into one log first, so the table is joined once per key
    set, unless an update in between changes what they read or write.
    """
    start, changed = x, set()
    for by, patches in compacted(corrections):
        # Key columns no earlier update touched are counted in the table as it came.
        counted = None if changed & set(by) else start
        if len(patches) == 1:
            x = rows_update(x, patches[0], by, small=small, hot_rows=hot_rows, counted=counted)
        else:
            x = _apply_log(x, patches, by, small, hot_rows, counted)
        changed |= {c for p in patches for c in p.columns} - set(by)
    return x


def compacted(corrections: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[tuple[list[str], list[DataFrame]]]:
    """Corrections in order, those with one key set together where nothing in between keeps them apart."""
    logs: list[tuple[list[str], list[DataFrame]]] = []
    for patch, by in corrections:
        keys, values = set(by), set(patch.columns) - set(by)
        for own_keys, patches in reversed(logs):
            if set(own_keys) == keys:
                patches.append(patch)
                break
            written = {c for p in patches for c in p.columns} - set(own_keys)
            if written & (keys | values) or values & set(own_keys):
                logs.append((list(by), [patch]))
                break
        else:
            logs.append((list(by), [patch]))
    return logs


def patch_log(x: DataFrame, patches: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One row per key: for each column the value of the last patch that sets it, in a struct, or NULL if none does.

    A key that one patch has twice stops the job.
    """
    types = dict(x.dtypes)
    values = [c for c in x.columns if c not in by and any(c in p.columns for p in patches)]
    listed = []
    for number, patch in enumerate(patches):
        absent = [c for c in patch.columns if c not in types]
        if absent or set(patch.columns) <= set(by):
            raise ValueError(f"patch columns {absent} are not in the table" if absent else "the patch sets no column")
        stated = [
            F.struct(col(c).cast(types[c]).alias("value")).alias(c) if c in patch.columns else F.lit(None).cast(f"struct<value:{types[c]}>").alias(c)
            for c in values
        ]
        listed.append(patch.select(*[col(b) for b in by], *stated, F.lit(number).alias("__number")))
    log = listed[0]
    for one in listed[1:]:
        log = log.unionByName(one)
    last = [F.max_by(col(c), F.when(col(c).isNotNull(), F.col("__number"))).alias(c) for c in values]
    repeats = F.greatest(*[F.count_if(F.col("__number") == n) for n in range(len(patches))], F.lit(0))
    folded = log.groupBy(*[col(b) for b in by]).agg(*last, repeats.alias("__most"))
    return folded.where(fail_if(F.col("__most") > 1, f"patch key ({', '.join(by)}) is not unique")).drop("__most")


def _apply_log(x, patches, by, small, hot_rows, counted) -> DataFrame:
    log = patch_log(x, patches, by)
    values = [c for c in log.columns if c not in by]
    log = log.select(*[col(b) for b in by], *[col(c).alias(f"__new_{c}") for c in values])
    joined = left_join(x, log, by, small=small, right_unique=True, hot_rows=hot_rows, counted=counted)
    return joined.select(*[
        F.when(col(f"__new_{c}").isNotNull(), col(f"__new_{c}")["value"]).otherwise(col(c)).alias(c) if c in values else col(c) for c in x.columns
    ])
