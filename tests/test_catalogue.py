from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablemend.operators.sets import union_sources
from tablemend.plans import audits
from tablemend.plans import catalogue as cat
from tablemend.plans import incremental
from tablemend.plans import source_specs as specs
from tablemend.plans.name_rules import FEATURE_LABELS, NAME_RULES, panel_names, portal_names
from tablemend.plans.reconcile import (
    NameRule,
    accession_list, accession_of_file, merge_indistinct, null_key_matches, observed_names, reconcile, unmatched_keys,
)
from tablemend.plans.spec import SourceSpec, Split, harmonise
from tablemend.plans import stages


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` string" for k in values))


def raw(spark, label, header, *lines):
    """Rows of a source as its file gives them, in the shape the spec expects."""
    df = spark.createDataFrame([tuple(l) for l in lines], ", ".join(f"`{h}` string" for h in header))
    return harmonise(df, specs.SOURCES[label])


def test_spec_parts_apply_in_order(spark):
    spec = SourceSpec(
        "lab", "file", rename={"Antigen": "ab"}, split=[Split("tag", ("cat", "oligo"), "(?<=[ABC])")],
        derive=lambda: [("oligo", F.lpad("oligo", 4, "0")), ("both", F.concat("cat", "oligo"))],
        where=lambda: F.col("Antigen") != "skip", constants={"Vendor": "v"},
        corrections=[("Antigen string, both string", ["Antigen"], [("CD4", None)])],
        drop=["junk"], distinct=True,
    )
    df = spark.createDataFrame([("CD3", "A34", "j"), ("CD3", "A34", "k"), ("CD4", "B1", "j"), ("skip", "A1", "j")], "ab string, tag string, junk string")
    out = harmonise(df, spec)
    assert rows(out, "Antigen", "cat", "oligo", "both", "Vendor", "Study") == sorted([
        ("CD3", "A", "0034", "A0034", "v", "lab"), ("CD4", "B", "0001", None, "v", "lab")], key=repr)


def test_all_sources_are_registered():
    assert len(specs.SOURCES) == 46 and len({s.label for s in specs.SOURCES.values()}) == 46
    assert [s.label for s in specs.SOURCES.values() if s.optional] == ["PomboAntunes_2021"]
    assert specs.SOURCES["Triana_2021"].source == "Triana_2021"
    assert set(FEATURE_LABELS) <= set(NAME_RULES) and len(NAME_RULES) == 46 + len(FEATURE_LABELS)


def test_free_text_source(spark):
    out = raw(
        spark, "Leader_2021", ("Antigen", "Vendor", "Cat_Number"),
        ("TotalSeq™-A0062 anti-human CD10 Antibody", "Biolegend", "Cat #312231; RRID: AB_1"),
        ("Anti-human CD326 (clone 9C4)", "Biolegend", "Cat#:324202; RRID: AB_2"),
        ("CD39 anti-human purified (clone A1)", "Biolegend", "Cat#: 328202; RRID: AB_3"),
        ("Anti-human CD8 (clone RPA-T8) – 146Nd", "Biolegend", "Cat#:301002; RRID: AB_4"),
    )
    assert rows(out, "Antigen", "Oligo_ID", "TotalSeq_Cat", "Cat_Number", "Clone", "Reactivity") == sorted([
        ("CD10", "0062", "A", "312231", None, "human"),
        ("CD326", None, None, "324202", "9C4", "human"),
        ("CD39", None, None, "328202", "A1", "human"),
        ("CD8", None, None, "301002", "RPA-T8", "human"),
    ], key=repr)


def test_three_part_identifier(spark):
    header = ("Reagent type (species) or resource", "Designation", "Source or reference", "Identifiers", "Additional information")
    out = raw(
        spark, "Shangguan_2021", header,
        ("Antibody", "Anti-Human CD1c(Mouse monoclonal)", "BioLegend", "Cat# 331547, Clone L161,RRID:AB_1", "pool:\n0.25 ug"),
        ("Antibody", "Anti-Human CD2 (Mouse monoclonal)", "BioLegend", "Cat# 2", None),
    )
    assert rows(out, "Antigen", "Cat_Number", "Clone", "RRID", "Origin_Species", "Dilution") == sorted([
        ("CD1c", "331547", "L161", "AB_1", "Mouse", "0.25 ug"), ("CD2", "2", None, None, "Mouse", None)], key=repr)


def test_codes_species_and_controls(spark):
    liu = raw(
        spark, "Liu_2021", ("DNA_ID", "Clone", "Description", "Barcode", "RRID (Biolegend Catalogue Number)"),
        ("C0005", "2D10", "0005 anti-human CD80", "ACG", "AB_1 (BioLegend Cat. No. 305243)"),
        ("C0090", "M", "0090 Mouse IgG1, kappa isotype Ctrl", "ACG", "n/a"),
    )
    assert rows(liu, "Antigen", "Reactivity", "RRID", "Cat_Number", "TotalSeq_Cat", "Oligo_ID") == sorted([
        ("CD80", "human", "AB_1", "305243", "C", "0005"), ("Mouse IgG1, kappa isotype Ctrl", "", "n/a", "n/a", "C", "0090")], key=repr)
    su = raw(
        spark, "Su_2020", ("DNA_ID", "Clone", "Description", "Barcode"),
        ("C1", "a", "0014 anti-mouse/human CD11b", "A"), ("C2", "b", "0856 anti-Tau Phospho", "A"), ("C3", "c", "0090 Mouse IgG1 isotype", "A"),
    )
    assert rows(su, "Antigen", "Reactivity") == sorted([("CD11b", "mouse/human"), ("Tau Phospho", None), ("Mouse IgG1 isotype", None)], key=repr)
    mair = raw(spark, "Mair_2020", ("Antigen", "Clone", "Cat_Number", "RRID"),
               ("CD3-Ab-O", "(clone", "SK7)", "BD Biosciences AHS0033; no RRID"), ("HLA-DR-Ab-O", "(cloneG46-6)", "BD", "Biosciences AHS0035; no RRID"))
    assert rows(mair, "Antigen", "Clone", "Oligo_ID") == [("CD3", "SK7", "AHS0033"), ("HLA-DR", "G46-6", "AHS0035")]
    wit = raw(spark, "Witkowski_2020", ("REAGENT or RESOURCE", "SOURCE", "IDENTIFIER"),
              ("CITE-Seq: CD1a-GATC", "v", "Cat#300133; Lot#B2; Clone:HI149"), ("Hashtag 1-ACGT", "v", "Cat#1; Lot#2; Clone:3"))
    assert rows(wit, "Antigen", "Barcode_Sequence", "Cat_Number", "Lot", "Clone") == [("CD1a", "GATC", "300133", "B2", "HI149")]


def test_panel_lookup_by_any_key(spark):
    panel = spark.createDataFrame(
        [("C0006", "anti-human CD86", "IT2.2", "AAA", "E1", "CD86"), ("C0007", "anti-human CD274 (PD-L1)", "29E", "CCC", "E2", "CD274")],
        "DNA_ID string, Antibody string, Clone string, Barcode string, `Ensemble ID` string, `Gene name` string")
    df = spark.createDataFrame([("anti-human CD86", "x", "y"), ("anti-human PDL1", "z", "CCC"), ("anti-rat IgG", None, None), ("anti-Tau", "M7004D06", "q")],
                               "Antibody string, Clone string, Barcode string")
    out = harmonise(df, specs.SOURCES["Stephenson_2021"], {"panel": panel})
    assert rows(out, "Antigen", "Oligo_ID", "Ensembl_ID", "Reactivity") == sorted([
        ("CD86", "0006", "E1", "human"), ("PDL1", "0007", "E2", "human"), ("IgG", None, None, "rat"),
        ("Tau Phospho (Thr181)", None, None, "human")], key=repr)


def test_folder_of_sources(spark, tmp_path):
    (tmp_path / "Bai_2022.csv").write_text("Antigen,Clone,Vendor\nCD4,SK3,BioLegend\n")
    (tmp_path / "Qi_2020.csv").write_text("Antigen,Clone,Vendor,Cat_Number,Oligo_ID,Study\nCD39,TU66,BD,940073,AHS0006,other\n")
    (tmp_path / f"{specs.PANEL_FILE}.csv").write_text("DNA_ID,Description,Clone,Barcode,Ensemble ID,Gene name\nC0006,anti-human CD86,IT2.2,GTC,E,CD86\n")
    wanted = [specs.SOURCES[n] for n in ("Bai_2022", "Qi_2020", "LeCoz_2021", "Chung_2021", "PomboAntunes_2021")]
    tables = specs.harmonise_folder(spark, str(tmp_path), wanted, absent=["PomboAntunes_2021"])
    merged = cat.unify(list(tables.values()))
    assert rows(merged, "Study", "Antigen", "Cat_Number") == sorted([
        ("Bai_2022", "CD4", None), ("Qi_2020", "CD39", "940073"), ("LeCoz_2021", "CD86", None), ("Chung_2021", "p65", "622601")], key=repr)
    with pytest.raises(ValueError, match="not optional"):
        specs.harmonise_folder(spark, str(tmp_path), wanted, absent=["Qi_2020"])


def test_feature_files_are_labelled_by_the_index(spark, tmp_path):
    head = "id,name,read,pattern,sequence,feature_type\n"
    (tmp_path / "a_feature_ref.csv").write_text(head + "CD3,CD3_UCHT1_TotalSeqC,R2,p,ACGT,x\n")
    (tmp_path / "b_feature_ref.csv").write_text(head + "IgG1,IgG1_control_TotalB,R2,p,TTTT,x\n")
    index = spark.createDataFrame([("10xA", "a_feature_ref.csv", "blood", None), ("10xB", "b_feature_ref.csv", "blood", "n")], "ID string, filename string, Source string, Notes string")
    out = specs.harmonise_feature_files(spark, str(tmp_path), index)
    assert rows(out, "Study", "Antigen", "Clone", "TotalSeq_Cat", "Barcode_Sequence", "Source") == sorted([
        ("10xA", "CD3", "UCHT1", "C", "ACGT", "blood"), ("10xB", "IgG1", None, "B", "TTTT", "blood")], key=repr)


def test_clean_and_controls(spark):
    columns = "Study string, Antigen string, Cat_Number string, Vendor string, Clone string, Reactivity string, Isotype string"
    df = spark.createDataFrame([
        ("s", " CD4  α", "AHS0012", "Biolegend", "5E+10", "Human, Mouse", "Mouse IgG1"),
        ("s", "Mouse IgG1", "*94700 (x)", "v", "500000000", None, "IgG2"),
        ("s", "mIgG Ctrl", "N/A", "v", "9E+02", "n/a", None),
        ("s", "arm Ham", "odd", "Fluidigm", "1000", "", None),
        ("s", "CD1", "odd", "v", "ok", "rat", None),
        ("s", "CD2", "N/A (Custom Order)", "v", None, "human", None),
    ], columns)
    out = cat.unify([df])
    assert rows(out, "Antigen", "Cat_Number", "Vendor", "Clone", "Reactivity", "Isotype", "Origin_Species", "Isotype_Control") == sorted([
        ("CD4 a", "AHS0012", "BioLegend", "5E10", "human/mouse", "IgG1", "Mouse", False),
        ("Mouse IgG1", "custom made (similar to 94700)", "v", "5E8", "mouse", "IgG2", None, True),
        ("mIgG Ctrl", None, "v", "9E2", "mouse", None, None, True),
        ("arm Ham", "odd", "Fluidigm", "10E2", "armenian hamster", None, None, True),
        ("CD1", "ERROR", "v", "ok", "rat", None, None, False),
        ("CD2", "custom made", "v", None, "human", None, None, False),
    ], key=repr)
    assert rows(audits.sentinels(out)) == [("s", 1)]
    assert rows(cat.keep_species(out), "Antigen") == [("CD2",), ("CD4 a",), ("Mouse IgG1",), ("arm Ham",), ("mIgG Ctrl",)]


def test_corrections_meet_null_keys(spark):
    df = spark.createDataFrame([("Hao_2021", "CCR7", None, "x", "y", "C"), ("Hao_2021", "CCR7", "1", "x", "y", "C")],
                               "Study string, Antigen string, Cat_Number string, Clone string, Oligo_ID string, TotalSeq_Cat string").withColumn("RRID", F.lit(None).cast("string"))
    out = cat.correct(df, specs.catalogue_corrections(spark), small=True)
    assert rows(out, "Cat_Number", "Clone", "Oligo_ID") == sorted([(None, "G043H7", None), ("1", "x", "y")], key=repr)


def aliases(spark, *entries):
    df = spark.createDataFrame(list(entries), "value string, ALT_ID string, HGNC_SYMBOL string")
    return df.withColumns({i: F.lit(None).cast("string") for i in cat.ID_COLUMNS if i not in df.columns})


def test_annotate_collapses_and_can_be_repeated(spark):
    known = aliases(spark, ("CD8", "h1", "CD8A"), ("CD8", "h2", "CD8B"), ("PD-L1", "h3", "CD274"), ("TCR a", "h4", None))
    df = spark.createDataFrame([("CD8 (T8)", False), ("CD274 (PD-L1)", False), ("TCR α", False), ("CD8", True), ("none", False), (None, False)], "Antigen string, Isotype_Control boolean")
    out = cat.annotate(df, known)
    want = sorted([
        ("CD8 (T8)", "h1, h2", "CD8A, CD8B"), ("CD274 (PD-L1)", "h3", "CD274"), ("TCR α", "h4", None),
        ("CD8", None, None), ("none", None, None), (None, None, None)], key=repr)
    assert rows(out, "Antigen", "ALT_ID", "HGNC_SYMBOL") == want
    assert rows(cat.annotate(out, known), "Antigen", "ALT_ID", "HGNC_SYMBOL") == want
    assert rows(audits.unannotated(out), "Antigen") == [("none",), (None,)]


def test_enrich_prefers_the_first_key_and_skips_ambiguous_ones(spark):
    voc = spark.createDataFrame([("1", "c1", "0001"), ("2", "c2", "0002"), ("3", "c2", "0003")], "Cat_Number string, Clone string, Oligo_ID string")
    df = spark.createDataFrame([("1", "c2", None), (None, "c1", None), (None, "c2", None), ("2", None, "own"), (None, None, None)], "Cat_Number string, Clone string, Oligo_ID string")
    assert rows(cat.enrich(df, voc, ["Cat_Number", "Clone"], ["Oligo_ID"])) == sorted([
        ("1", "c2", "0001"), (None, "c1", "0001"), (None, "c2", None), ("2", None, "own"), (None, None, None)], key=repr)


def test_custom_rows_are_split_by_one_predicate(spark):
    df = spark.createDataFrame([("1", "a", True), ("custom made", "a", None), ("1", None, None), ("1", "b", False)], "Cat_Number string, Clone string, Custom_Antibody boolean")
    out = cat.fill_from_peers(df, [(["Cat_Number"], ["Clone"])], held_out=cat.is_custom(df))
    assert rows(out) == sorted([("1", "a", True), ("custom made", "a", None), ("1", "b", None), ("1", "b", False)], key=repr)


def test_standard_names(spark):
    df = spark.createDataFrame([
        ("PD-1", "s1", "h1"), ("PD-1", "s2", "h1"), ("CD279", "s3", "h1"), ("CD279", "s3", None), ("x", "s1", None), ("b", "s4", "h2"), ("a", "s5", "h2"),
    ], "Antigen string, Study string, ALT_ID string")
    out = cat.standardise_names(df, ["ALT_ID"])
    assert rows(out) == sorted([
        ("PD-1", "s1", "h1", "PD-1"), ("PD-1", "s2", "h1", "PD-1"), ("CD279", "s3", "h1", "PD-1"), ("CD279", "s3", None, "PD-1"),
        ("x", "s1", None, None), ("b", "s4", "h2", "a"), ("a", "s5", "h2", "a")], key=repr)


def test_registry(spark):
    df = spark.createDataFrame([
        ("R1", "Mouse Anti-Human CD3 Monoclonal antibody, Clone Clone UCHT1", "1", "v", "p", "d"),
        ("R2", " Anti-Human CD4 Monoclonal Antibody, Clone RPA T4", "2", "v", "p", "d"),
        ("R3", "Anti-Human CD5 Polyclonal, clone x", "3", "v", "p", "d"),
        ("R4", "Anti-Human CD6 Monoclonal PE Conjugated, clone x", "4", "v", "p", "d"),
        ("R5", None, "5", "v", "p", "d"),
    ], "id string, ab_name string, catalog_num string, vendor string, proper_citation string, defining_citation string")
    assert rows(cat.registry_extract(df), "RRID", "Species", "Antigen", "Clone", "Cat_Number", "Vendor", "Citation") == [
        ("R1", "Mouse", "CD3", "UCHT1", "1", "v", "p"), ("R2", "", "CD4", "RPA T4", "2", "v", "p")]


BASE = "Study string, Antigen string, Clone string, Cat_Number string, Oligo_ID string, TotalSeq_Cat string, Barcode_Sequence string, Reactivity string, Assay string, HGNC_SYMBOL string"


def catalogue(spark, *entries):
    names = [part.split()[0] for part in BASE.split(", ")]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], BASE)


def observed(spark, *entries):
    names = ["Study", "Data_Name", "file", "Cat_Number", "Clone", "Barcode_Sequence"]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], ", ".join(f"{n} string" for n in names))


RULED = [
    ("Arunachalam_2020", dict(Antigen="CD57", Clone="HNK"), ["CD57--Ber-TSA"], "CD57--Ber-TSA"),
    ("Arunachalam_2020", dict(Antigen="PDL1", Clone="29E.2A3"), ["CD274_PD-L1--x-TSA"], "CD274_PD-L1--x-TSA"),
    ("Buus_2021", dict(Antigen="IsoIgG1"), [], "IgG1"),
    ("Cadot_2020", dict(Antigen="CD8a(x)"), ["CD8"], "CD8"),
    ("Cadot_2020", dict(Antigen="IgG"), ["CD8"], None),
    ("Colpitts_2023", dict(Antigen="TCR g/d"), [], "TCRgd"),
    ("Frangieh_2021", dict(Antigen="CD140A"), [], "CD140a"),
    ("Frangieh_2021", dict(Antigen="Rat IgG_Isotype control"), [], "Rat_IgG"),
    ("Hao_2021", dict(Antigen="CD3", Cat_Number="1", Clone="c", Assay="CITE-seq"), [dict(Data_Name="CD3-1", Cat_Number="1", Clone="c")], "CD3-1"),
    ("Hao_2021", dict(Antigen="CD3", Cat_Number="1", Clone="c", Assay="ECCITE-seq"), [dict(Data_Name="CD3-1", Cat_Number="1", Clone="c")], None),
    ("Holmes_2020", dict(Antigen="CXCR4"), ["ADT_x_CXCR4_Human.1"], "ADT_x_CXCR4_Human.1"),
    ("Kaufmann_2021", dict(Antigen="CD197 (CCR7)"), ["ADT-CCR7-CD197"], "ADT-CCR7-CD197"),
    ("Kotliarov_2020", dict(Antigen="TCR gamma/delta (x)"), ["TCR gd_PROT"], "TCR gd_PROT"),
    ("Lawlor_2021", dict(Antigen="CD3"), ["CD3-ACGT"], "CD3-ACGT"),
    ("Leader_2021", dict(Antigen="CD3", Barcode_Sequence="AAAAAAAA"), [dict(Data_Name="CD3x", Barcode_Sequence="AAAAAAAA")], "CD3x"),
    ("Leader_2021", dict(Antigen="CD4"), [dict(Data_Name="CD4", Barcode_Sequence="ACGTAC")], "CD4"),
    ("LeCoz_2021", dict(Antigen="CD274 (B7-H1, PD-L1)"), ["anti-human_CD274_(PD-L1)"], "anti-human_CD274_(PD-L1)"),
    ("Lee_2021", dict(Antigen="CD45 RA"), ["CD45--x"], "CD45--x"),
    ("Liu_2021", dict(Antigen="TCR Valpha24-Jalpha18 (iNKT cell)"), ["TCRVa24-Jz18.1", "HTO1"], "TCRVa24-Jz18.1"),
    ("Mair_2020", dict(Antigen="Lag3"), ["CD223|LAG3|AHS0018|pAbO", "CD223|mRNA"], "CD223|LAG3|AHS0018|pAbO"),
    ("Mimitou_2019", dict(Antigen="CD29 (human)"), ["CD29.AATAGCGGAGCC"], "CD29.AATAGCGGAGCC"),
    ("Mimitou_2019", dict(Antigen="CD3E"), ["CD3"], "CD3"),
    ("Mimitou_2021", dict(Antigen="Notch 1 (x)"), ["Notch1"], "Notch1"),
    ("Nathan_2021", dict(Antigen="CD3 (CD3E)"), ["CD3_protein"], "CD3_protein"),
    ("Nettersheim_2022", dict(Antigen="Tau Phospho (Thr181)"), ["anti-Thr181.1"], "anti-Thr181.1"),
    ("Papalexi_2021", dict(Antigen="PD-L1"), ["PDL1"], "PDL1"),
    ("Pei_2020", dict(Antigen="CD7"), ["CD71_ADT"], "CD71_ADT"),
    ("Poch_2021", dict(Antigen="CD25", HGNC_SYMBOL="IL2RA"), ["IL2RA"], "IL2RA"),
    ("Poch_2021", dict(Antigen="HLA-DR", HGNC_SYMBOL="HLA-DRA"), ["HLA"], "HLA"),
    ("PomboAntunes_2021", dict(Antigen="CD1-a", Oligo_ID="0402"), [dict(Data_Name="CD1.a.A0402", file="Human_1")], "CD1.a.A0402"),
    ("PomboAntunes_2021", dict(Antigen="CD207", Reactivity="human"), [dict(Data_Name="CD207_h", file="Human_1"), dict(Data_Name="CD207_h", file="Mouse")], "CD207_h"),
    ("Pont_2020", dict(Antigen="Mouse IgG1, kappa isotype Ctrl"), ["Isoytpe mIgG1_Ab"], "Isoytpe mIgG1_Ab"),
    ("Qi_2020", dict(Antigen="CD11b"), ["CD11b/Mac-1.1"], "CD11b/Mac-1.1"),
    ("RinconArevalo_2021", dict(Antigen="CD4"), [], "CD4.1"),
    ("Shangguan_2021", dict(Antigen="HLA A/B"), ["HLA-AB-PROT"], "HLA-AB-PROT"),
    ("Stephenson_2021", dict(Antigen="CD357 (GITR)"), ["AB_GITR"], "AB_GITR"),
    ("Stoeckius_2017", dict(Antigen="CD29"), [], None),
    ("Stoeckius_2018", dict(Antigen="HLA-DR"), ["HLA.DR.ACGT"], "HLA.DR.ACGT"),
    ("Stuart_2019", dict(Antigen="ICOS"), ["CD278.A1"], "CD278.A1"),
    ("Su_2020", dict(Antigen="CD158b (KIR2DL2/L3, NKAT2)"), ["CD158B_KIR2DL2-L3_NKAT3"], "CD158B_KIR2DL2-L3_NKAT3"),
    ("Trzupek_2020", dict(Antigen="CD3 x", HGNC_SYMBOL="CD3D, CD3E"), ["zz|CD3D_CD3E|AHS0033|pAbO"], "zz|CD3D_CD3E|AHS0033|pAbO"),
    ("Trzupek_2021", dict(Antigen="CD366 (TIM3)"), ["Tim3:F38|HAVCR2|AHS0016|pAbO"], "Tim3:F38|HAVCR2|AHS0016|pAbO"),
    ("Ty_2023", dict(Antigen="HLADR"), ["HLA-DR--L243-TSB"], "HLA-DR--L243-TSB"),
    ("Vanuytsel_2020", dict(Antigen="CD202b"), ["TEK-protein-CGATCCCTTACCT", "unmapped"], "TEK-protein-CGATCCCTTACCT"),
    ("Wang_2020_PBMC", dict(Antigen="CD3"), ["CD3-ACGT"], "CD3-ACGT"),
    ("Witkowski_2020", dict(Antigen="CD274"), ["ADT-PD1L1-CD274"], "ADT-PD1L1-CD274"),
    ("Wu_2021", dict(Antigen="HLA.DR"), ["MHCII-AATAGCGAGCAAGTA"], "MHCII-AATAGCGAGCAAGTA"),
    ("Wu_2021", dict(Antigen="CD99"), ["MHCI-TATGCGAGGCTTATC", "unmapped"], None),
    ("10x29May2019", dict(Antigen="CD3", Clone="UCHT1"), ["CD3-UCHT1-TotalSeqC"], "CD3-UCHT1-TotalSeqC"),
    ("10x7July2020", dict(Antigen="IgG1"), ["IgG1-control-TotalC"], "IgG1-control-TotalC"),
    ("no rule", dict(Antigen="CD3"), ["CD3"], None),
]


def test_every_name_rule(spark):
    """All rules at once, in one pass over a catalogue of one row per case."""
    entries, seen, want = [], [], []
    for label, item, names, expected in RULED:
        entries.append({"Study": label, **item})
        seen += [{"Study": label, **(n if isinstance(n, dict) else {"Data_Name": n})} for n in names]
        want.append((label, item["Antigen"], item.get("Assay"), expected))
    result = reconcile(catalogue(spark, *entries), observed(spark, *seen), NAME_RULES, store_keys=True)
    got = {(r["Study"], r["Antigen"], r["Assay"]): r["Data_Name"] for r in result.collect()}
    wrong = [(w, got.get(w[:3])) for w in want if got.get(w[:3]) != w[3]]
    assert wrong == []


def test_reconcile_appends_patches_and_audits(spark):
    rules = {label: NAME_RULES[label] for label in ("Wu_2021", "Bai_2022", "Granja_2019", "Krebs_2020")}
    base = catalogue(spark, dict(Study="Wu_2021", Antigen="CD3"), dict(Study="Bai_2022", Antigen="CD4"), dict(Study="Granja_2019", Antigen="CD3 x", TotalSeq_Cat="B"), dict(Study="other", Antigen="q"))
    names = observed(
        spark, dict(Study="Wu_2021", Data_Name="CD3-ACGT"), dict(Study="Bai_2022", Data_Name="ADT-CD8"), dict(Study="Bai_2022", Data_Name="ADT-"),
        dict(Study="Granja_2019", Data_Name="CD3", file="PBMC"), dict(Study="Granja_2019", Data_Name="CD3", file="CD34"),
        dict(Study="Krebs_2020", Data_Name="ADT-CD9"), dict(Study="Krebs_2020", Data_Name="ADT-CD9"))
    base = base.withColumns({"Vendor": F.lit(None).cast("string"), "Isotype_Control": F.lit(True)})
    out = reconcile(base, names, rules)
    assert rows(out, "Study", "Antigen", "Data_Name", "Barcode_Sequence", "TotalSeq_Cat", "Vendor", "Isotype_Control") == sorted([
        ("Wu_2021", "CD3", "CD3-ACGT", "ACGT", None, None, True),
        ("Bai_2022", "CD4", None, None, None, None, True),
        ("Bai_2022", "CD8", "ADT-CD8", None, None, "BioLegend", False),
        ("Granja_2019", "CD3 x", "CD3", None, "B", None, True),
        ("Granja_2019", "CD3", "CD3", None, "A", None, None),
        ("Krebs_2020", "CD9", "ADT-CD9", None, None, "BioLegend", None),
        ("other", "q", None, None, None, None, True),
    ], key=repr)
    assert rows(unmatched_keys(base, names, rules)) == sorted([
        ("Bai_2022", "CD4", "left"), ("Bai_2022", "CD8", "right"), ("Granja_2019", "CD3|A", "right"), ("Krebs_2020", "CD9", "right")], key=repr)
    assert rows(null_key_matches(base, names, rules)) == [("other", 1, 0)]
    assert rows(audits.unused_names(out, names.select("Study", "Data_Name"))) == [("Bai_2022", "ADT-")]


def test_reconcile_keeps_every_observed_row(spark):
    """A name matched in one source, or in one category, is still new elsewhere."""
    rule = NameRule(append="key")
    base = catalogue(spark, dict(Study="A", Antigen="CD3"), dict(Study="B", Antigen="CD9"))
    names = observed(spark, dict(Study="A", Data_Name="CD3"), dict(Study="B", Data_Name="CD3"), dict(Study="B", Data_Name="CD9"))
    out = reconcile(base, names, {"A": rule, "B": rule})
    assert rows(out, "Study", "Antigen", "Data_Name") == [("A", "CD3", "CD3"), ("B", "CD3", "CD3"), ("B", "CD9", "CD9")]


def test_a_control_gets_no_identifier(spark):
    base = spark.createDataFrame([("CD8", "s1", True), ("CD8", "s2", False), ("CD8", "s3", None)], "Antigen string, Study string, Isotype_Control boolean")
    aliases = spark.createDataFrame([("CD8", "h1")], "value string, ALT_ID string")
    assert rows(cat.annotate(base, aliases, id_columns=["ALT_ID"]), "Study", "ALT_ID") == [("s1", None), ("s2", "h1"), ("s3", "h1")]


def test_observed_names_by_accession(spark):
    paths = ["x/features_GSE1-a.rds", "p_E-MTAB-123-b", "d/features_10x_10x24July2019-2_x", "none"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(accession_of_file(F.col("p"))).collect()] == ["GSE1", "E-MTAB-123", "10x24July2019-2", None]
    papers = spark.createDataFrame([("Mair_2020", "GSE1"), ("Triana_2021", "Triana2021"), ("Holmes_2020", None)], "Name string, Accession string")
    listed = accession_list(papers)
    assert rows(listed) == [("Holmes_2020", "Holmes2020"), ("Mair_2020", "GSE1"), ("Triana_2021", "Triana2022")]
    names = spark.createDataFrame([("GSE1", "f", "CD3"), ("other", "f", "CD4")], "accession string, file string, data_name string")
    assert rows(observed_names(names, listed), "Study", "Data_Name", "file") == [("Mair_2020", "CD3", "f")]


def test_name_lists_of_two_sources(spark):
    portal = spark.createDataFrame([("B7_H4", "358114", "MIH43"), ("CD193", "310729", "5E+08")], "`#protein` string, Catalog string, Clone string")
    assert rows(portal_names(portal), "Study", "Data_Name", "Cat_Number", "Clone") == [("Hao_2021", "B7-H4", "358114", "MIH43"), ("Hao_2021", "CD193", "310729", "5E8")]
    names = spark.createDataFrame([("Leader_2021", "CD3", "a_patient_7_batch_ID_1"), ("Leader_2021", "CD4", "a")], "Study string, Data_Name string, file string")
    panels = spark.createDataFrame([("CD3", "ACGT", "patient_7"), ("CD3", "TTTT", "patient_8")], "name string, sequence string, patient string")
    assert rows(panel_names(names, panels), "Data_Name", "Barcode_Sequence") == sorted([("CD3", "ACGT"), ("CD4", None)], key=repr)


def test_indistinct_items_become_one(spark):
    base = catalogue(spark, dict(Study="m", Antigen="CD3", Clone="a"), dict(Study="m", Antigen="CD3", Clone="b"), dict(Study="m", Antigen="CD4", Clone="c"), dict(Study="n", Antigen="CD3", Clone="d"))
    assert rows(merge_indistinct(base, "m"), "Study", "Antigen", "Clone") == sorted([("m", "CD3", None), ("m", "CD4", "c"), ("n", "CD3", "d")], key=repr)


def test_stages_end_to_end(spark, tmp_path):
    tables = [
        one(spark, Study="Bai_2022", Antigen="CD4", Clone="SK3", Cat_Number=None, Oligo_ID="0045", TotalSeq_Cat="A", Vendor="Biolegend", Reactivity="Human"),
        one(spark, Study="Qi_2020", Antigen="CD4 (T4)", Clone="SK3", Cat_Number="344649", Oligo_ID=None, TotalSeq_Cat="A", Vendor="x", Reactivity="mouse, human"),
        one(spark, Study="Qi_2020", Antigen="CD9", Clone="z", Cat_Number="1", Oligo_ID="9", TotalSeq_Cat="A", Vendor="x", Reactivity="rat"),
    ]
    vocabulary = spark.createDataFrame([("SK3", "0045", "A", "344649", "ACGT")], "Clone string, Oligo_ID string, TotalSeq_Cat string, Cat_Number string, Barcode_Sequence string")
    seen = observed(spark, dict(Study="Bai_2022", Data_Name="ADT-CD4"), dict(Study="Qi_2020", Data_Name="CD5.1"))
    known = aliases(spark, ("CD4", "HGNC:1678", "CD4"))
    out = stages.run_all(tables, known, seen, str(tmp_path / "out"), specs.catalogue_corrections(spark), vocabulary)
    assert rows(out["catalogue"], "Study", "Cat_Number") == [("Bai_2022", "344649"), ("Qi_2020", "344649")]
    assert rows(out["annotated"], "ID", "ALT_ID", "Oligo_ID") == [("CD4 (T4)__Qi_2020", "HGNC:1678", "0045"), ("CD4__Bai_2022", "HGNC:1678", "0045")]
    assert rows(out["named"], "ID", "Data_Name") == sorted([("CD4__Bai_2022", "ADT-CD4"), ("CD4 (T4)__Qi_2020", None), ("CD5__Qi_2020", "CD5.1")], key=repr)
    assert rows(out["standard"], "Antigen", "Antigen_std") == sorted([("CD4", "CD4"), ("CD4 (T4)", "CD4"), ("CD5", None)], key=repr)
    assert out["standard"].where("Study = 'Qi_2020'").count() == 2


def test_union_of_harmonised_sources_conserves_rows(spark):
    parts = [one(spark, Study="a", Antigen="x"), one(spark, Study="b", Antigen="y", Notes="n")]
    assert rows(audits.row_conservation(parts, union_sources(parts))) == [(2, 2, True)]
    assert rows(audits.missing_labels(union_sources(parts), audits.labels_of(["a", "c"], spark), "Study")) == [("b", "left"), ("c", "right")]
    assert rows(audits.unlike(parts[0], "Antigen", "^CD"), "Antigen") == [("x",)]


def test_only_changed_sources_are_reconciled_again(spark, tmp_path):
    rule = NameRule(keys=[(lambda: F.lower("Antigen"), lambda: F.lower("Data_Name"))], append="key")
    rules = {"a": rule, "b": rule}
    catalogue = spark.createDataFrame([("a", "CD3"), ("a", "CD4"), ("b", "CD3"), ("b", "CD3")], "Study string, Antigen string")
    observed = spark.createDataFrame([("a", "cd3"), ("b", "CD3"), ("b", "new")], "Study string, Data_Name string")
    path, seen = str(tmp_path / "r"), []

    def run(cat_, obs, version="1"):
        def compute(cut):
            seen.append(sorted({r["Study"] for df in cut.values() for r in df.collect()}))
            return reconcile(cut["catalogue"], cut["observed"], rules)

        changed = incremental.incremental({"catalogue": cat_, "observed": obs}, compute, path, version=version)
        full = reconcile(cat_, obs, rules)
        assert rows(incremental.read_sources(spark, path), *full.columns) == rows(full)
        return changed

    with pytest.raises(ValueError, match="no results"):
        incremental.read_sources(spark, path)
    assert run(catalogue, observed) == ["a", "b"]
    # Another order of the same rows is no change; a row more or less is, also a repeated one.
    assert run(catalogue.orderBy(F.desc("Antigen")).repartition(3), observed) == []
    assert run(catalogue, observed.union(spark.createDataFrame([("a", "CD4")], "Study string, Data_Name string"))) == ["a"]
    assert run(catalogue.union(spark.createDataFrame([("b", "CD3")], "Study string, Antigen string")), observed) == ["a", "b"]
    assert run(catalogue.dropDuplicates(), observed) == ["b"]
    assert run(catalogue.where("Study = 'b'").dropDuplicates(), observed.where("Study = 'b'")) == []
    assert run(catalogue, observed, "2") == ["a", "b"]
    assert seen == [["a", "b"], ["a"], ["a", "b"], ["b"], ["a", "b"]]
