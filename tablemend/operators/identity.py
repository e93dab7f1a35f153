"""Items that share any identifier are one: connected components over rows and identifier values.

Rows stand for their combination of identifiers, so the graph is as large as the distinct combinations. A value links all
combinations that hold it through the smallest of them, by one combined aggregation, not by pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.operators.columns import col
from tablemend.operators.joins import HOT_ROWS, attach_groups, left_join
from tablemend.sources.tables import cut_lineage

#: A column, or several that identify together.
Identifier = str | Sequence[str]


def parts_of(identifier: Identifier) -> list[str]:
    return [identifier] if isinstance(identifier, str) else list(identifier)


def components(edges: DataFrame, hot_rows: int | None = HOT_ROWS, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected edges (a, b) of whole numbers; a component is named by its smallest node.

    In every round a node's larger neighbours, and then its smaller ones, are pointed at the smallest node it
    knows, until nothing changes: a number of rounds like the logarithm of a component's size. Minima are combined before the
    shuffle and come back by a join that cuts hot nodes, so no component meets in one task. Rounds are stored in the shared work folder.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs, before = cut_lineage(ordered, "edges"), None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        known = attach_groups(both, ["a"], {"least": F.min("b")}, hot_rows=hot_rows).where("b > a")
        larger = known.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        met = attach_groups(larger, ["a"], {"least": F.min("b")}, hot_rows=hot_rows)
        smaller = met.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b")).where("a > b").distinct()
        pairs = cut_lineage(smaller, "edges")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == before:
            # Settled: every node points at the smallest one, which points at none.
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
    raise RuntimeError("components did not settle")


def _identifier_rows(combinations: DataFrame, identifiers: Sequence[Identifier]) -> DataFrame:
    """(item, kind, values): a row for each identifier that a combination knows whole."""
    place, listed = _places(identifiers), []
    for kind, identifier in enumerate(identifiers):
        parts = [F.col(place[p]) for p in parts_of(identifier)]
        known = parts[0].isNotNull()
        for p in parts[1:]:
            known = known & p.isNotNull()
        listed.append(F.when(known, F.struct(F.lit(kind).alias("kind"), F.array(*[p.cast("string") for p in parts]).alias("values"))))
    return combinations.select("item", F.inline(F.array_compact(F.array(*listed))))


def _places(identifiers: Sequence[Identifier]) -> dict[str, str]:
    """Column -> name in the table of combinations, where no caller's name can meet one of ours."""
    return {c: f"__i{n}" for n, c in enumerate(dict.fromkeys(p for i in identifiers for p in parts_of(i)))}


def _text(kind: Column, values: Column, identifiers: Sequence[Identifier]) -> Column:
    """An identifier as text: its columns' names and its values."""
    names = F.array(*[F.lit("+".join(parts_of(i))) for i in identifiers])
    return F.concat(F.get(names, kind), F.lit("="), F.array_join(values, "|"))


def shared_identifiers(df: DataFrame, identifiers: Sequence[Identifier], most_items: int) -> DataFrame:
    """Audit: identifiers of more than so many combinations, such as placeholders, with the number of combinations and rows."""
    combinations = df.groupBy(*[col(c).alias(i) for c, i in _places(identifiers).items()]).agg(F.count(F.lit(1)).alias("item"))
    held = _identifier_rows(combinations, identifiers).groupBy("kind", "values").agg(F.count(F.lit(1)).alias("n_items"), F.sum("item").alias("n_rows"))
    return held.where(F.col("n_items") > most_items).select(_text(F.col("kind"), F.col("values"), identifiers).alias("identifier"), "n_items", "n_rows")


def resolve(
    df: DataFrame,
    identifiers: Sequence[Identifier],
    identity: str = "identity",
    most_items: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add an identity that all rows share which are linked by equal identifiers, directly or over other rows.

    An identifier is a column or several columns together; one with a NULL links nothing. ``most_items``
    guards against placeholders: a value that more combinations of identifiers hold links nothing either (see
    ``shared_identifiers``). The identity is the first of its identifiers, as text, so it does not depend on
    the order of rows; rows without an identifier that counts have none.
    """
    if identity in df.columns:
        raise ValueError(f"column {identity!r} already exists")
    place = _places(identifiers)
    distinct = df.select(*[col(c).alias(i) for c, i in place.items()]).distinct().withColumn("item", F.monotonically_increasing_id())
    combinations = cut_lineage(distinct, "combinations")
    held = attach_groups(
        _identifier_rows(combinations, identifiers), ["kind", "values"], {"first": F.min("item"), "n_items": F.count(F.lit(1))}, hot_rows=hot_rows
    )
    if most_items is not None:
        held = held.where(F.col("n_items") <= most_items)
    held = cut_lineage(held.select("item", "kind", "values", "first"), "identifiers")
    grouped = components(held.select(F.col("item").alias("a"), F.col("first").alias("b")), hot_rows)
    whole = left_join(held, grouped, [("item", "node")], right_unique=True, hot_rows=hot_rows)
    whole = whole.withColumn("component", F.coalesce("component", "item"))
    named = whole.groupBy("component").agg(F.min(F.struct("kind", "values")).alias("name"))
    of_item = whole.select("item", "component").distinct()
    told = left_join(of_item, named, "component", right_unique=True, hot_rows=hot_rows)
    told = told.select("item", _text(F.col("name.kind"), F.col("name.values"), identifiers).alias(identity))
    known = left_join(combinations, told, "item", right_unique=True, hot_rows=hot_rows).drop("item")
    return left_join(df, known, list(place.items()), right_unique=True, hot_rows=hot_rows)
