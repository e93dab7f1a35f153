"""Attach the names observed in independent data to the catalogue.

Every source writes its names in its own way, so each has a rule that turns
catalogue rows and observed names into comparable keys. The rules are columns:
they are merged into one CASE per key over the source label, and the whole
catalogue is matched in one cascade on (source, key), not once per source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.operators import columns as c
from tablemend.operators.aggregates import count_by, null_out_ambiguous
from tablemend.operators.columns import col
from tablemend.operators.joins import HOT_ROWS, left_join, match_cascade, unused_rows
from tablemend.operators.sets import one_sided, union_sources
from tablemend.sources.tables import cut_lineage

Expression = Callable[[], Column]

LABEL, NAME, ITEM = "Study", "Data_Name", "Antigen"


def _item() -> Column:
    return col(ITEM)


def _name() -> Column:
    return col(NAME)


@dataclass(frozen=True)
class NameRule:
    """How one source's catalogue rows and observed names meet.

    ``keys`` are pairs (catalogue key, observed key), strong to weak.
    ``item_keys`` and ``name_keys`` state the first key of single catalogue items
    or observed names that the expressions do not reach. With ``direct`` the
    catalogue key is the observed name itself, also where it was not seen.
    ``fields`` are catalogue columns the observed name spells out. ``append`` adds
    observed names nothing matched: their item is the 'key', the 'name', or an
    expression.
    """

    keys: Sequence[tuple[Expression, Expression]] = ((_item, _name),)
    item_keys: Mapping[str, str | None] = field(default_factory=dict)
    name_keys: Mapping[str, str | None] = field(default_factory=dict)
    direct: bool = False
    observed_where: Expression | None = None
    fields: Mapping[str, Expression] = field(default_factory=dict)
    append: str | Expression | None = None
    constants: Mapping[str, str] = field(default_factory=dict)


def _per_label(choices: Mapping[str, Column | None]) -> Column:
    """One CASE over the source label; other sources give NULL."""
    out = None
    for label, value in choices.items():
        if value is None:
            continue
        is_label = col(LABEL) == label
        out = F.when(is_label, value) if out is None else out.when(is_label, value)
    return F.lit(None).cast("string") if out is None else out


def _stated(value: Column, of: Column, table: Mapping[str, str | None]) -> Column:
    """Keys written out for single values replace the general expression."""
    if not table:
        return value
    known = F.create_map(*[F.lit(p).cast("string") for pair in table.items() for p in pair])
    return F.when(of.isin(list(table)), F.try_element_at(known, of)).otherwise(value)


def _key_columns(rules: Mapping[str, NameRule], side: int) -> list[tuple[str, Column]]:
    of = (col(ITEM), col(NAME))[side]
    n_keys = max(len(r.keys) for r in rules.values())
    out = []
    for i in range(n_keys):
        choices = {}
        for label, rule in rules.items():
            if i < len(rule.keys):
                stated = (rule.item_keys, rule.name_keys)[side] if i == 0 else {}
                choices[label] = _stated(rule.keys[i][side](), of, stated)
        out.append((f"__key{i + 1}", _per_label(choices)))
    return out


def keyed_observed(observed: DataFrame, rules: Mapping[str, NameRule]) -> DataFrame:
    """Observed names with keys and the fields they spell out; names a rule excludes are gone."""
    wanted = {label: rule.observed_where() for label, rule in rules.items() if rule.observed_where is not None}
    if wanted:
        observed = observed.where(F.coalesce(_per_label(wanted), F.lit(True)))
    spelled = {}
    for name in _unique([f for r in rules.values() for f in r.fields]):
        value = _per_label({label: r.fields[name]() for label, r in rules.items() if name in r.fields})
        spelled[name] = F.coalesce(value, col(name)) if name in observed.columns else value
    # Keys first: they may read columns that a field replaces.
    return observed.withColumns({**dict(_key_columns(rules, 1)), **spelled})


def keyed_catalogue(catalogue: DataFrame, rules: Mapping[str, NameRule]) -> DataFrame:
    """Catalogue rows with the keys of their source's rule."""
    return catalogue.withColumns(dict(_key_columns(rules, 0)))


def reconcile(
    catalogue: DataFrame,
    observed: DataFrame,
    rules: Mapping[str, NameRule],
    patch: Sequence[str] = ("Oligo_ID", "Barcode_Sequence", "TotalSeq_Cat"),
    carry: Sequence[str] = (),
    store_keys: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The catalogue with a ``Data_Name`` per row, plus rows for observed names nothing matched.

    ``observed`` has (Study, Data_Name) and whatever columns the rules read. Its
    ``patch`` columns fill NULLs of the matched rows; ``carry`` columns are added,
    one row per combination. A NULL key matches nothing. Appended rows carry their
    source's label and constants. ``store_keys`` writes both keyed tables out
    before they are matched: with many rules the keys are long expressions that
    should be computed once and stay out of join filters.
    """
    keyed = keyed_observed(observed, rules)
    patched = [p for p in patch if p in keyed.columns and p in catalogue.columns]
    key_names = [n for n, _ in _key_columns(rules, 1)]
    names = c.keep(keyed, [LABEL, NAME, *key_names, *patched, *carry])
    base = keyed_catalogue(c.drop(catalogue, [NAME, *carry], absent="ignore"), rules)
    if store_keys:
        names, base = cut_lineage(names, "observed"), cut_lineage(base, "keyed")
    names = names.distinct()
    side = names.withColumnsRenamed({p: f"__obs_{p}" for p in patched})
    passes = [[LABEL, k] for k in key_names]
    matched = match_cascade(base, side, passes, NAME, append_rest=False, hot_rows=hot_rows)
    matched = matched.withColumns({p: F.coalesce(col(p), col(f"__obs_{p}")) for p in patched})
    direct = _per_label({label: col("__key1") for label, r in rules.items() if r.direct})
    matched = matched.withColumn(NAME, F.coalesce(col(NAME), direct)).drop(*key_names, *[f"__obs_{p}" for p in patched])

    appending = {label: r for label, r in rules.items() if r.append is not None}
    if not appending:
        return matched
    # The label is a key of every pass, so sources that append can be looked at alone.
    open_names, open_rows = (t.where(col(LABEL).isin(list(appending))) for t in (names, base))
    # Used or not is a matter of the observed row: another source may have matched the same name.
    rest = unused_rows(open_rows, open_names, passes, [LABEL, *key_names, *carry, NAME], hot_rows=hot_rows)
    item = {"key": lambda: col("__key1"), "name": lambda: col(NAME)}
    rest = rest.withColumn(ITEM, _per_label({label: item.get(r.append, r.append)() for label, r in appending.items()}))
    constants = _unique([k for r in appending.values() for k in r.constants])
    stated = {}
    for k in constants:
        value = _per_label({label: F.lit(r.constants[k]) for label, r in appending.items() if k in r.constants})
        stated[k] = F.coalesce(value, col(k)) if k in rest.columns else value
    rest = rest.withColumns(stated)
    types = dict(matched.dtypes)
    appended = rest.select(*[col(n).cast(types[n]).alias(n) for n in rest.columns if n in types])
    return union_sources([matched, appended])


def _unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def unmatched_keys(catalogue: DataFrame, observed: DataFrame, rules: Mapping[str, NameRule]) -> DataFrame:
    """Audit: first keys found only in the catalogue ('left') or only in the observed names ('right')."""
    left = keyed_catalogue(catalogue, rules).select(LABEL, "__key1").where("__key1 IS NOT NULL")
    right = keyed_observed(observed, rules).select(LABEL, "__key1").where("__key1 IS NOT NULL")
    return one_sided(left, right).withColumnRenamed("__key1", "key")


def null_key_matches(catalogue: DataFrame, observed: DataFrame, rules: Mapping[str, NameRule]) -> DataFrame:
    """Audit: rows per source without a key, on both sides; they are matched to nothing."""
    left = count_by(keyed_catalogue(catalogue, rules).where("__key1 IS NULL"), [LABEL], "n_catalogue")
    right = count_by(keyed_observed(observed, rules).where("__key1 IS NULL"), [LABEL], "n_observed")
    both = union_sources([left, right])
    return both.groupBy(LABEL).agg(F.coalesce(F.sum("n_catalogue"), F.lit(0)).alias("n_catalogue"), F.coalesce(F.sum("n_observed"), F.lit(0)).alias("n_observed"))


def merge_indistinct(
    catalogue: DataFrame,
    label: str,
    columns: Sequence[str] = ("Cat_Number", "Clone", "Oligo_ID", "Barcode_Sequence", "Reactivity"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """For one source: items listed with several clones that names cannot tell apart become one row."""
    of_label = F.coalesce(col(LABEL) == label, F.lit(False))
    merged = null_out_ambiguous(catalogue.where(of_label), [ITEM], columns, hot_rows).distinct()
    return union_sources([merged, catalogue.where(~of_label)])


def observed_names(names: DataFrame, accessions: DataFrame, accession: str = "accession", name: str = "data_name") -> DataFrame:
    """(Study, Data_Name, file) from names per accession and the accession of each source."""
    pairs = accessions.select(col("Study").alias(LABEL), col("Accession").alias(accession)).distinct()
    met = left_join(names, pairs.withColumn("__known", F.lit(True)), accession, nulls="never")
    return met.where("__known").drop("__known").withColumnRenamed(name, NAME)


# How a file name tells the accession, tried in this order, and a wrong accession in the list of papers.
ACCESSION_PATTERNS = (r".*_(E-MTAB-[0-9]+)-.*", r".*_(10x[0-9]+[A-z]+[0-9]+(-2)?).*", r".*features_([^-]*)-.*")
ACCESSION_MISTAKES = {"Triana2021": "Triana2022"}


def accession_of_file(path: Column) -> Column:
    """Accession named in a file path; NULL if none is."""
    out = F.lit(None).cast("string")
    for pattern in reversed(ACCESSION_PATTERNS):
        out = F.when(path.rlike(pattern), F.regexp_extract(path, pattern, 1)).otherwise(out)
    return out


def accession_list(papers: DataFrame) -> DataFrame:
    """Source label and accession of each paper; a paper without accession goes by its name."""
    found = F.coalesce(col("Accession"), F.replace(col("Name"), F.lit("_"), F.lit("")))
    entries = F.create_map(*[F.lit(p) for pair in ACCESSION_MISTAKES.items() for p in pair])
    return papers.select(col("Name").alias(LABEL), F.coalesce(F.try_element_at(entries, found), found).alias("Accession"))
