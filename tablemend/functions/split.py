"""Split one text column into several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_ALNUM = r"(?U)[^\p{Alnum}]+"


def split_parts(col: Column, n: int, sep: str, extra: str = "drop", fill: str = "right") -> list[Column]:
    """``n`` columns cut from ``col`` at ``sep``; missing pieces are NULL.

    ``extra='merge'`` keeps the rest in the last piece; ``fill='left'`` aligns
    the pieces to the right when there are too few.
    """
    if extra not in ("drop", "merge") or fill not in ("right", "left"):
        raise ValueError(f"unknown extra={extra!r} or fill={fill!r}")
    parts = F.split(col, sep, n if extra == "merge" else -1)
    if fill == "right":
        return [F.try_element_at(parts, F.lit(i + 1)) for i in range(n)]
    shift = F.greatest(F.lit(n) - F.size(parts), F.lit(0))
    return [
        F.when(F.lit(i) >= shift, F.try_element_at(parts, F.greatest(F.lit(i + 1) - shift, F.lit(1))))
        for i in range(n)
    ]


def separate(
    df: DataFrame,
    column: str,
    into: Sequence[str | None],
    sep: str = NON_ALNUM,
    extra: str = "drop",
    fill: str = "right",
    remove: bool = True,
) -> DataFrame:
    """Replace ``column`` by the pieces named in ``into`` (None skips a piece)."""
    pieces = split_parts(F.col(f"`{column}`"), len(into), sep, extra, fill)
    named = {name: piece for name, piece in zip(into, pieces) if name is not None}
    out = df.withColumns(named)
    return out.drop(column) if remove and column not in named else out
