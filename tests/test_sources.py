from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablemend.operators.fill import fill_down
from tablemend.sources import delimited as d
from tablemend.sources import multiline
from tablemend.sources import tables as t


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode())
    return str(path)


def test_text_is_never_guessed(spark, tmp_path):
    path = write(tmp_path, "s.csv", 'Clone,Dilution,Note\n5E10,1:10,NA\n0034,,""\nN/A,1:5,x\n')
    assert rows(d.read_delimited(spark, path)) == sorted([("5E10", "1:10", None), ("0034", None, ""), ("N/A", "1:5", "x")], key=repr)


def test_header_is_repaired(spark, tmp_path):
    path = write(tmp_path, "s.csv", '﻿Target ,"Cat\n#", ,Barcode\r\nCD3,"1\n2",,ACGT\r\n')
    df = d.read_delimited(spark, path, d.ReadOptions(multiline=True))
    assert df.columns == ["Target", "Cat#", "Barcode"]
    assert rows(df) == [("CD3", "1\n2", "ACGT")]


def test_headers_equal_but_for_case_are_refused(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string").toDF("Clone ", "clone")
    with pytest.raises(ValueError, match="same name"):
        d.repair_header(df)


def test_quoted_blanks_and_tabs(spark, tmp_path):
    blank = write(tmp_path, "b.txt", 'Name "Catalogue #" Clone\n"CD3 (a)" 300475 UCHT1\n')
    assert rows(d.read_delimited(spark, blank, d.ReadOptions(sep=" "))) == [("CD3 (a)", "300475", "UCHT1")]
    tab = write(tmp_path, "t.tsv", "A\tB\t\r\n1\t2\t\r\n")
    assert rows(d.read_delimited(spark, tab, d.ReadOptions(sep="\t"))) == [("1", "2")]


def test_unquoted_text_belongs_to_the_last_column(spark, tmp_path):
    path = write(tmp_path, "m.txt", "Cat Kind Antigen\n1 C45 CD45 (clone: 2D1)\n2 C34 CD3\n3 C1\n")
    options = d.ReadOptions(sep=" ", rest_in_last=True, columns=("Cat", "Kind", "Antigen"))
    assert rows(d.read_delimited(spark, path, options)) == [("1", "C45", "CD45 (clone: 2D1)"), ("2", "C34", "CD3"), ("3", "C1", None)]


def test_malformed_rows_are_set_aside(spark, tmp_path):
    path = write(tmp_path, "m.csv", "a,b\n1,2\n1,2,3\n4\n5,6\n")
    good, bad = d.read_checked(spark, path, ["a", "b"])
    assert rows(good) == [("1", "2"), ("5", "6")]
    assert rows(bad, "raw") == [("1,2,3",), ("4",)]


def test_folder_with_patterns_provenance_and_order(spark, tmp_path):
    write(tmp_path, "one.feature.csv", "id,name\na,1\nb,NA\n")
    write(tmp_path, "two.feature.csv", "id,name\nc,3\nd,\n")
    write(tmp_path, "merged.feature.csv", "id,name\nz,9\n")
    df = d.read_folder(spark, str(tmp_path), include="feature", exclude="^merged")
    assert rows(df, "_src", "id", "name") == sorted([("one", "a", "1"), ("one", "b", None), ("two", "c", "3"), ("two", "d", None)], key=repr)
    filled = fill_down(df, ["name"], ["_src"], ["_ord"])
    assert rows(filled, "id", "name") == [("a", "1"), ("b", "1"), ("c", "3"), ("d", "3")]


def test_folder_maps_columns_by_name(spark, tmp_path):
    write(tmp_path, "a_feature.csv", "id,name\n1,x\n")
    write(tmp_path, "b_feature.csv", "name,id\ny,2\nname,id\n")
    write(tmp_path, "index.csv", "ID2,filename\n" + "q,r\n" * 50)
    df = d.read_folder(spark, str(tmp_path), include="feature")
    assert rows(df, "id", "name", "_src") == sorted([("1", "x", "a_feature"), ("2", "y", "b_feature"), ("id", "name", "b_feature")], key=repr)
    with pytest.raises(ValueError, match="columns"):
        d.read_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no file"):
        d.read_folder(spark, str(tmp_path), include="nothing")


def test_header_goes_by_position(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a,b\n1,2\na,b\n5,6,7\n")
    good, bad = d.read_checked(spark, path, ["a", "b"])
    assert rows(good) == [("1", "2"), ("a", "b")] and rows(bad, "raw") == [("5,6,7",)]
    rest = d.read_delimited(spark, path, d.ReadOptions(rest_in_last=True, columns=("a", "b")))
    assert rows(rest) == [("1", "2"), ("5", "6,7"), ("a", "b")]
    other = write(tmp_path, "u.csv", "a, b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        d.read_checked(spark, other, ["a", "b"])[0].collect()


def test_sheets_become_a_column(spark, tmp_path):
    write(tmp_path, "patient_1.csv", "name,sequence\nCD3,ACGT\n")
    write(tmp_path, "patient_2.csv", "name,sequence\nCD3,TTTT\n")
    df = d.read_sheets(spark, str(tmp_path), "patient", prefix="patient_")
    assert rows(df, "name", "sequence", "patient") == [("CD3", "ACGT", "1"), ("CD3", "TTTT", "2")]


def test_nested_names(spark):
    df = spark.createDataFrame([("p", ["a", "b", "a"]), ("q", [])], "study string, names array<string>")
    assert rows(t.names_to_rows(df, ["study"], "names", "name")) == [("p", "a"), ("p", "b")]


def test_sink_refuses_to_overwrite_its_input(spark, tmp_path):
    path = str(tmp_path / "out")
    t.write_table(spark.createDataFrame([("s", "x")], "Study string, v string"), path, ["Study"])
    stored = t.read_table(spark, path)
    assert rows(stored, "Study", "v") == [("s", "x")]
    with pytest.raises(ValueError, match="another path"):
        t.write_table(stored, path, mode="overwrite")
    csv = str(tmp_path / "csv")
    t.write_table(stored, csv, fmt="csv")
    assert rows(d.read_delimited(spark, csv), "Study", "v") == [("s", "x")]


def test_lineage_is_cut_in_the_named_folder(spark):
    df = spark.range(5).withColumn("k", F.col("id") % 2)
    cut = t.cut_lineage(df, "unit")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert rows(cut) == rows(df)
    assert all(folder in f for f in cut.inputFiles())


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        t.work_folder(Session())


FIELDS = ["a", "", "x y", '"q"', '"a\nb"', '"a\n\nb,c"', '"say ""hi""\n"', '""', '"\n"', 'in"ch', '"end"x', '"a\r\nb"', "NA", '","', '"""\n"""', "long " * 9]


@pytest.mark.parametrize("size", [16, 40, 100_000])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_multi_line_files_split_anywhere(spark, tmp_path, size, ending):
    """Equal to Spark's own reader of whole files, whatever the byte ranges."""
    rng, paths = random.Random(size), []
    for n in range(25):
        table = [["k", "l", "m"], *([rng.choice(FIELDS) for _ in range(3)] for _ in range(rng.randrange(12)))]
        paths.append(write(tmp_path, f"{n}.csv", ending.join(",".join(row) for row in table) + rng.choice(["", ending])))
    whole = rows(d.read_delimited(spark, paths, d.ReadOptions(multiline=True)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        found = d.read_delimited(spark, paths, d.ReadOptions(multiline=True, split=True))
        assert found.columns == ["k", "l", "m"] and rows(found) == whole
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_quote_that_is_never_closed_stops_the_job(spark, tmp_path):
    path = write(tmp_path, "open.csv", "k\n" + '"x\n' * 1 + "y\n" * 30)
    with pytest.raises(Exception, match="not closed"):
        multiline.records(spark, [path], most_lines=20).collect()
    with pytest.raises(ValueError, match="position"):
        d.read_delimited(spark, path, d.ReadOptions(multiline=True, split=True), provenance=True)
