"""Jobs on the unified catalogue."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions import text as x
from tablemend.functions.nulls import matches, null_if_any, one_of
from tablemend.functions.split import separate, split_parts
from tablemend.operators import columns as c
from tablemend.operators.aggregates import collapse_groups, count_by, elect
from tablemend.operators.columns import col
from tablemend.operators.fill import fill_by_group
from tablemend.operators.identity import Identifier, resolve
from tablemend.operators.joins import HOT_ROWS, join_any, left_join
from tablemend.operators.rows import apply_corrections, rows_patch
from tablemend.operators.sets import union_sources, upsert_union
from tablemend.sources.tables import cut_lineage

ID_COLUMNS = ("ALT_ID", "HGNC_ID", "HGNC_SYMBOL", "ENSEMBL_ID", "UNIPROT_ID", "ENTREZ_ID", "SOURCE")

# Every catalogue has these columns, whatever its sources bring.
CORE_COLUMNS = {
    "Study": "string", "Antigen": "string", "Clone": "string", "Cat_Number": "string", "Oligo_ID": "string",
    "TotalSeq_Cat": "string", "RRID": "string", "Ensembl_ID": "string", "Reactivity": "string",
    "Origin_Species": "string", "Vendor": "string", "Dilution": "string", "Barcode_Sequence": "string",
    "Isotype": "string", "Gene_Name": "string",
}

# Texts that stand for a missing value, spellings, and clone names a spreadsheet turned into numbers.
MISSING = ("n/a", "N/A")
VENDOR_SPELLING = {"Biolegend": "BioLegend"}
DAMAGED_CLONES = {"50000000000": "5E10", "5E+10": "5E10", "500000000": "5E8", "9E+02": "9E2", "1E+03": "10E2", "1000": "10E2"}
CATALOGUE_NUMBER = "^(AHS)?[0-9-]+$"
CUSTOM_MADE = ("N/A (Custom Order)", "custom made")
FREE_FORM_VENDORS = "Biozol|R&D|Fluidigm"
CONTROL_NAME = "Mouse|Ra[tg]|[Hh]am|[Cc]ontrol|Ctrl|[Ii]so"
CONTROL_SPECIES = (("Mouse|^mIg", "mouse"), ("Rat|^rIg", "rat"), ("Armenian Hamster|^[Aa]rm", "armenian hamster"))


def _mapped(value: Column, table: Mapping[str, str]) -> Column:
    """Replace the values the table lists."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), value), value)


def clean(catalogue: DataFrame) -> DataFrame:
    """Squish all texts, unify spellings, classify catalogue numbers, repair clone names."""
    absent = {n: F.lit(None).cast(t) for n, t in CORE_COLUMNS.items() if n not in catalogue.columns}
    df = c.across(catalogue.withColumns(absent), x.squish, dtype="string")
    number, vendor = col("Cat_Number"), col("Vendor")
    custom_like = r"^\*([0-9]+).*$"
    df = df.withColumns({
        "Vendor": _mapped(vendor, VENDOR_SPELLING),
        "Cat_Number": F.when(matches(number, CATALOGUE_NUMBER), number)
        .when(number.isNull() | one_of(number, MISSING), F.lit(None).cast("string"))
        .when(one_of(number, CUSTOM_MADE), "custom made")
        .when(number.startswith("*"), F.regexp_replace(number, custom_like, "custom made (similar to $1)"))
        .when(matches(vendor, FREE_FORM_VENDORS), number)
        .otherwise("ERROR"),
        "RRID": null_if_any(col("RRID"), MISSING),
        "Reactivity": F.replace(F.lower(null_if_any(col("Reactivity"), ("", *MISSING))), F.lit(", "), F.lit("/")),
        "Gene_Name": F.nullif(col("Gene_Name"), F.lit("/")),
        "Clone": _mapped(col("Clone"), DAMAGED_CLONES),
        "Antigen": x.greek_symbols_to_letters(col("Antigen")),
    })
    species, isotype = split_parts(col("Isotype"), 2, " (?=Ig)", fill="left")
    return df.withColumns({"Isotype": isotype, "Origin_Species": F.coalesce(col("Origin_Species"), species)})


def classify_controls(catalogue: DataFrame) -> DataFrame:
    """Mark isotype controls by name and read their species from it where none is given."""
    name = col("Antigen")
    control = matches(name, CONTROL_NAME)
    species = F.lit(None).cast("string")
    for pattern, value in reversed(CONTROL_SPECIES):
        species = F.when(control & matches(name, pattern), value).otherwise(species)
    return catalogue.withColumns({"Isotype_Control": control, "Reactivity": F.coalesce(col("Reactivity"), species)})


def unify(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of harmonised sources, cleaned and classified; rows are conserved."""
    return classify_controls(clean(union_sources(tables)))


def keep_species(catalogue: DataFrame, species: str = "[Hh]uman") -> DataFrame:
    """Rows for a species, of unknown species, or controls."""
    return catalogue.where(matches(col("Reactivity"), species) | col("Reactivity").isNull() | col("Isotype_Control"))


def sorted_for_output(df: DataFrame, by: Sequence[str], front: Sequence[str] = ()) -> DataFrame:
    """Columns to the front and rows in order with NULLs last; only useful right before a sink."""
    moved = c.relocate(df, front) if front else df
    return moved.orderBy(*[col(b).asc_nulls_last() for b in by])


correct = apply_corrections


def only_value_per_key(vocabulary: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per known key; a column with several values for the key is NULL."""
    low_high = [f(col(n)).alias(p + n) for n in columns for f, p in ((F.min, "__low_"), (F.max, "__high_"))]
    grouped = vocabulary.dropna(subset=list(keys)).groupBy(*[col(k) for k in keys]).agg(*low_high)
    return grouped.select(
        *[col(k) for k in keys],
        *[F.when(col(f"__low_{n}") == col(f"__high_{n}"), col(f"__low_{n}")).alias(n) for n in columns],
    )


def complete(catalogue: DataFrame, vocabulary: DataFrame, by: Sequence[str], columns: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Fill NULLs from a reference vocabulary where it knows exactly one value for the key."""
    known = only_value_per_key(vocabulary, by, columns)
    return rows_patch(catalogue, known, by, check_unique=False, hot_rows=hot_rows)


def enrich(catalogue: DataFrame, vocabulary: DataFrame, keys: Sequence[str], columns: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Fill NULLs from a vocabulary by the first key that matches; ambiguous keys fill nothing.

    The vocabulary of each key is made unique before the join, so rows never multiply.
    """
    parts = []
    for number, key in enumerate(keys):
        known = only_value_per_key(vocabulary, [key], columns)
        # Each pass has its own key column, so an entry of one pass cannot answer another.
        parts.append(known.select(
            *[(col(key) if k == key else F.lit(None).cast(dict(vocabulary.dtypes)[k])).alias(k) for k in keys],
            *[col(n).alias(f"__voc_{n}") for n in columns],
        ))
    joined = join_any(catalogue, union_sources(parts), list(keys), right_unique=True, hot_rows=hot_rows)
    present = set(catalogue.columns)
    filled = joined.withColumns({
        n: F.coalesce(col(n), col(f"__voc_{n}")) if n in present else col(f"__voc_{n}") for n in columns
    })
    return filled.drop(*[f"__voc_{n}" for n in columns])


Variants = Callable[[Column], Sequence[Column]]


def default_variants(name: Column) -> Sequence[Column]:
    """Spellings under which an alias dictionary may know a name."""
    plain = x.greek_symbols_to_letters(name)
    outside = F.trim(x.gsub(plain, r"\s*\([^)]*\)", ""))
    return [
        name,
        plain,
        outside,
        x.extract(plain, r"\(([^)]+)\)"),
        x.greek_words_to_letters(outside),
        F.upper(F.regexp_replace(outside, "[ _-]", "")),
        F.regexp_replace(outside, "[ _]", "-"),
    ]


def name_variants(names: DataFrame, key: str, name: str, control: str | None = None, variants: Variants = default_variants) -> DataFrame:
    """Long table (key, value) of the distinct spellings of each name; controls are left out."""
    if control is not None:
        names = names.where(~F.coalesce(col(control), F.lit(False)))
    spelled = names.select(col(key).alias(key), col(name).alias("__name")).distinct()
    listed = F.array_distinct(F.array_compact(F.array(*variants(F.col("__name")))))
    return spelled.select(col(key), F.explode(listed).alias("value")).where("value <> ''").distinct()


def search_aliases(queries: DataFrame, aliases: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Dictionary rows whose ``value`` is one of the query spellings."""
    hit = aliases.withColumn("__known", F.lit(True))
    return left_join(queries, hit, "value", nulls="never", hot_rows=hot_rows).where("__known").drop("__known")


def annotate(
    catalogue: DataFrame,
    aliases: DataFrame,
    name: str = "Antigen",
    control: str | None = "Isotype_Control",
    id_columns: Sequence[str] = ID_COLUMNS,
    variants: Variants = default_variants,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Attach identifiers by looking up spellings of each name.

    The lookup runs once per distinct name, not per row. Several hits are listed
    in one text per column. Controls get no identifiers, also where another row
    has their name. Identifiers from an earlier run are dropped first.
    """
    base = c.drop(catalogue, id_columns, absent="ignore")
    spellings = name_variants(base.withColumn("__key", col(name)), "__key", name, control, variants)
    hits = search_aliases(spellings, aliases.select("value", *[col(i) for i in id_columns]), hot_rows)
    found = collapse_groups(hits, ["__key"], id_columns)
    looked_up = col(name) if control is None else F.when(~F.coalesce(col(control), F.lit(False)), col(name))
    named = left_join(base.withColumn("__name", looked_up), found, [("__name", "__key")], nulls="never", right_unique=True, hot_rows=hot_rows)
    return named.drop("__name")


PEER_RULES = (
    (("Cat_Number",), ("Clone", "Oligo_ID", "TotalSeq_Cat", "ALT_ID", "HGNC_ID", "ENSEMBL_ID", "Reactivity")),
    (("RRID",), ("Clone", "Reactivity")),
    (("Clone", "Oligo_ID", "TotalSeq_Cat"), ("Cat_Number",)),
    (("Antigen", "Barcode_Sequence", "TotalSeq_Cat", "Clone"), ("Cat_Number",)),
)


def is_custom(catalogue: DataFrame) -> Column:
    """Rows of custom-made items, whose numbers say nothing about other rows."""
    flagged = F.coalesce(col("Custom_Antibody"), F.lit(False)) if "Custom_Antibody" in catalogue.columns else F.lit(False)
    return matches(col("Cat_Number"), "custom") | flagged


def fill_from_peers(
    catalogue: DataFrame,
    rules: Sequence[tuple[Sequence[str], Sequence[str]]] = PEER_RULES,
    held_out: Column | None = None,
    multiple: str = "ignore",
    hot_rows: int | None = HOT_ROWS,
    store: bool = False,
) -> DataFrame:
    """Fill gaps from rows that share a key, one rule after the other; later rules see earlier fills.

    ``held_out`` rows neither give nor get values. Every rule reads its input
    twice; with ``store`` the table is written out between rules, so that the
    plan does not double.
    """
    hold = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rest = catalogue.where(~hold)
    for number, (group, columns) in enumerate(rules):
        if number and store:
            rest = cut_lineage(rest, "peers")
        rest = fill_by_group(rest, group, columns, multiple, hot_rows)
    return rest if held_out is None else union_sources([rest, catalogue.where(hold)])


def merge_back(
    catalogue: DataFrame,
    fragments: Sequence[DataFrame],
    key: Sequence[str] = ("ID",),
    id_parts: Sequence[str] = ("Antigen", "Study"),
    hot_rows: int | None = HOT_ROWS,
    store: bool = False,
) -> DataFrame:
    """Reconciled fragments plus the catalogue rows they do not cover, with fresh ids and clean texts.

    The fragments are read twice, as rows and for the keys they cover; ``store`` writes them out before.
    """
    combined = union_sources(fragments)
    if store:
        combined = cut_lineage(combined, "fragments")
    if "Data_Name" in combined.columns:
        combined = combined.withColumn("Antigen", F.coalesce(col("Antigen"), col("Data_Name")))
    merged = upsert_union(combined, catalogue, key, hot_rows)
    merged = c.drop(merged, ["TEMP", "ID"], absent="ignore")
    return c.across(c.add_row_id(merged, id_parts), x.squish, dtype="string")


def standardise_names(
    catalogue: DataFrame,
    identity: Sequence[Identifier],
    name: str = "Antigen",
    label: str = "Study",
    standard: str = "Antigen_std",
    preference: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
    linked: bool = False,
    most_items: int | None = None,
) -> DataFrame:
    """One standard name per identity; rows without an identity take the one of their name and source.

    The identity columns together are one identity; with ``linked`` each is an identifier of its own, and rows
    that share any of them, directly or over other rows, have one identity (see ``identity.resolve``, also for ``most_items``).
    The standard is the name most rows of the identity use; ``preference`` is a
    function of the name. Everything is decided on counts of (name, source,
    identity); the rows themselves are only read to attach the result.
    """
    if linked:
        resolved = resolve(catalogue, identity, "__identity", most_items, hot_rows)
        return standardise_names(resolved, ["__identity"], name, label, standard, preference, hot_rows).drop("__identity")
    counts = count_by(catalogue, _unique([name, label, *identity]), "__n_rows")
    elected = elect(counts.dropna(subset=list(identity)), identity, name, standard, preference, "__n_rows")
    voted = left_join(counts, elected, list(identity), nulls="never", right_unique=True, hot_rows=hot_rows)
    peers = elect(voted, [name, label], standard, "__peer", weight="__n_rows")
    named = left_join(catalogue, elected, list(identity), nulls="never", right_unique=True, hot_rows=hot_rows)
    filled = left_join(named, peers, [name, label], right_unique=True, hot_rows=hot_rows, counted=catalogue)
    return filled.withColumn(standard, F.coalesce(col(standard), col("__peer"))).drop("__peer")


def _unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


# How registry entries name species, clone and antigen.
REGISTRY_KEEP = ("Anti-Human", "Monoclonal", "[Cc]lone")
REGISTRY_SKIP = "Fluorescein|PE Conju"
REGISTRY_SPECIES_END = " Anti-Human"
REGISTRY_CLONE_START = "[,]? ?[Cc]lone[s]? "
REGISTRY_ANTIGEN_END = " Monoclonal.*"


def registry_extract(
    registry: DataFrame,
    name: str = "ab_name",
    renames: Mapping[str, str] | None = None,
    drop: Sequence[str] = ("defining_citation",),
) -> DataFrame:
    """Human monoclonal entries with a clone, split into species, antigen and clone."""
    entry = col(name)
    chosen = registry.where(~matches(entry, REGISTRY_SKIP))
    for pattern in REGISTRY_KEEP:
        chosen = chosen.where(matches(entry, pattern))
    chosen = chosen.withColumn(name, x.gsub(entry, "Clone [Cc]lone", "Clone"))
    split = separate(chosen, name, ("Species", name), REGISTRY_SPECIES_END, fill="left")
    split = separate(c.across(split, x.squish, dtype="string"), name, (name, "Clone"), REGISTRY_CLONE_START, extra="merge", remove=False)
    named = c.drop(split, drop).withColumn("Antigen", x.gsub(entry, REGISTRY_ANTIGEN_END, ""))
    kept = named.where((entry != col("Antigen")) & ~matches(col("Clone"), "[Cc]lone"))
    renames = renames if renames is not None else {"RRID": "id", "Citation": "proper_citation", "Cat_Number": "catalog_num", "Vendor": "vendor"}
    return c.drop(c.rename(kept, renames), [name])
