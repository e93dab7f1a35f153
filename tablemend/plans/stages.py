"""The four stages in order. Each reads the stored result of the one before.

A stage boundary is a written table: it keeps plans small, survives lost
executors, and lets a stage be run again on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.functions.nulls import matches
from tablemend.functions.text import squish
from tablemend.operators import columns as c
from tablemend.operators.columns import col
from tablemend.operators.identity import Identifier
from tablemend.operators.joins import HOT_ROWS, left_join
from tablemend.operators.rows import rows_patch
from tablemend.plans import catalogue as cat
from tablemend.plans.name_rules import CATALOGUE_NEEDS, NAME_RULES, OBSERVED_NEEDS, with_needed
from tablemend.plans.reconcile import NameRule, merge_indistinct, reconcile
from tablemend.plans.source_specs import ALIAS_SPELLINGS
from tablemend.sources.tables import cut_lineage, literal_table, read_table, write_table

VOCABULARY_KEY = ("Clone", "Oligo_ID", "TotalSeq_Cat")
FRONT = ("Study", "Antigen", "Clone", "Cat_Number", "Oligo_ID", "TotalSeq_Cat")


def build_catalogue(
    tables: Sequence[DataFrame],
    corrections: Sequence[tuple[DataFrame, Sequence[str]]] = (),
    vocabulary: DataFrame | None = None,
    species: str = "[Hh]uman",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Unite harmonised sources, correct them, fill numbers from the vocabulary, keep one species."""
    unified = cut_lineage(cat.unify(tables), "unified")
    corrected = cat.correct(unified, corrections)
    if vocabulary is not None:
        corrected = cat.complete(corrected, vocabulary, VOCABULARY_KEY, ["Cat_Number"], hot_rows)
    return c.relocate(cat.keep_species(corrected, species), FRONT)


def annotate_catalogue(
    catalogue: DataFrame,
    aliases: DataFrame,
    vocabulary: DataFrame | None = None,
    id_columns: Sequence[str] = cat.ID_COLUMNS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Attach identifiers, enrich from the vendor vocabulary, fill gaps from peers."""
    named = c.add_row_id(cat.annotate(catalogue, aliases, id_columns=id_columns, hot_rows=hot_rows))
    if vocabulary is not None:
        known = [n for n in vocabulary.columns if n in named.columns and n not in ("Cat_Number", "Clone")]
        named = cat.enrich(named, vocabulary, ["Cat_Number", "Clone"], known, hot_rows)
    spelled = literal_table(catalogue.sparkSession, *ALIAS_SPELLINGS)
    stated = cat.only_value_per_key(cat.search_aliases(spelled, aliases, hot_rows=None), ["Antigen"], id_columns)
    named = rows_patch(named, stated, ["Antigen"], check_unique=False, hot_rows=None)
    stored = cut_lineage(named, "annotated")
    return cat.fill_from_peers(stored, held_out=cat.is_custom(stored), hot_rows=hot_rows, store=True)


def reconcile_catalogue(
    catalogue: DataFrame,
    observed: DataFrame,
    vocabulary: DataFrame | None = None,
    rules: Mapping[str, NameRule] = NAME_RULES,
    indistinct: Sequence[str] = ("Mimitou_2021",),
    barcodes_from_vocabulary: Sequence[str] = ("Leader_2021",),
    carry: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Give each catalogue row the name observed in its source's data; add unseen names."""
    base = with_needed(c.drop(catalogue, ["ID", "TEMP"], absent="ignore"), CATALOGUE_NEEDS)
    if vocabulary is not None and barcodes_from_vocabulary:
        known = cat.only_value_per_key(vocabulary, ["Cat_Number"], ["Barcode_Sequence"])
        base = _barcodes(base, known, barcodes_from_vocabulary, hot_rows)
    for label in indistinct:
        one_name = matches(col("Antigen"), "^CD275") & (col("Study") == label)
        base = base.withColumn("Antigen", F.when(one_name, "CD275").otherwise(col("Antigen")))
        base = cut_lineage(merge_indistinct(base, label, hot_rows=hot_rows), "indistinct")
    named = reconcile(base, with_needed(observed, OBSERVED_NEEDS), rules, carry=carry, store_keys=True, hot_rows=hot_rows)
    squished = c.across(named, squish, dtype="string")
    return c.relocate(c.add_row_id(squished), ["Antigen", "Data_Name"])


def _barcodes(base: DataFrame, known: DataFrame, labels: Sequence[str], hot_rows: int | None) -> DataFrame:
    """Barcodes of the sources that give catalogue numbers only."""
    joined = left_join(base, known.withColumnRenamed("Barcode_Sequence", "__barcode"), "Cat_Number", nulls="never", right_unique=True, hot_rows=hot_rows)
    filled = F.when(col("Study").isin(list(labels)), F.coalesce(col("Barcode_Sequence"), col("__barcode"))).otherwise(col("Barcode_Sequence"))
    return joined.withColumn("Barcode_Sequence", filled).drop("__barcode")


def standardise_catalogue(
    catalogue: DataFrame, identity: Sequence[Identifier] = ("ALT_ID",), hot_rows: int | None = HOT_ROWS, linked: bool = False, most_items: int | None = None
) -> DataFrame:
    """One standard name per identity; with ``linked`` rows that share any of the identifiers have one identity."""
    return cat.standardise_names(catalogue, identity, hot_rows=hot_rows, linked=linked, most_items=most_items)


def run_all(
    tables: Sequence[DataFrame],
    aliases: DataFrame,
    observed: DataFrame,
    out: str,
    corrections: Sequence[tuple[DataFrame, Sequence[str]]] = (),
    vocabulary: DataFrame | None = None,
    carry: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """All stages, each stored under ``out`` by source and read back by the next one."""

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/{name}"
        write_table(df, path, ["Study"])
        return read_table(df.sparkSession, path)

    built = stored("catalogue", build_catalogue(tables, corrections, vocabulary, hot_rows=hot_rows))
    annotated = stored("annotated", annotate_catalogue(built, aliases, vocabulary, hot_rows=hot_rows))
    named = stored("named", reconcile_catalogue(annotated, observed, vocabulary, carry=carry, hot_rows=hot_rows))
    standard = stored("standard", standardise_catalogue(named, hot_rows=hot_rows))
    return {"catalogue": built, "annotated": annotated, "named": named, "standard": standard}
