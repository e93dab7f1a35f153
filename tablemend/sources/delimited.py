"""Delimited text: all columns are read as text, with provenance on request.

Type guessing damages codes ("5E10" becomes a number, "1:10" a time), so nothing
is inferred. ``NA`` and empty fields are NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablemend.functions.split import split_parts
from tablemend.sources.multiline import records

MALFORMED = "_malformed"


@dataclass(frozen=True)
class ReadOptions:
    """How one delimited source is written."""

    sep: str = ","
    quote: str = '"'
    multiline: bool = False
    header: bool = True
    encoding: str = "UTF-8"
    trim: bool = False
    columns: tuple[str, ...] | None = None
    rest_in_last: bool = False
    #: Read a multi-line file in byte ranges at the same time, instead of whole in one task.
    split: bool = False


def _reader(spark: SparkSession, options: ReadOptions):
    return (
        spark.read.option("sep", options.sep)
        .option("quote", options.quote)
        .option("escape", options.quote)
        .option("header", options.header)
        .option("multiLine", options.multiline)
        .option("encoding", options.encoding)
        .option("ignoreLeadingWhiteSpace", options.trim)
        .option("ignoreTrailingWhiteSpace", options.trim)
        .option("nullValue", "NA")
        .option("inferSchema", False)
    )


def clean_name(name: str) -> str:
    """A header cell without line breaks, byte-order mark or outer blanks."""
    return re.sub(r"[\r\n﻿]", "", name).strip()


def repair_header(df: DataFrame, drop_blank: bool = True) -> DataFrame:
    """Clean all header cells; nameless columns go, names equal but for case are an error."""
    cleaned = {c: clean_name(c) for c in df.columns}
    blank = [c for c, n in cleaned.items() if not n or re.fullmatch(r"_c\d+", n)]
    kept = [c for c in df.columns if not (drop_blank and c in blank)]
    seen: dict[str, str] = {}
    for c in kept:
        name = cleaned[c]
        if name.lower() in seen:
            raise ValueError(f"header cells {seen[name.lower()]!r} and {name!r} are the same name")
        seen[name.lower()] = name
    return df.select(*[F.col(f"`{c}`").alias(cleaned[c]) for c in kept])


def read_delimited(spark: SparkSession, path: str | Sequence[str], options: ReadOptions = ReadOptions(), provenance: bool = False) -> DataFrame:
    """One delimited table, or several with the same header, as text columns.

    ``provenance`` adds ``_src`` (file name without folder and ending) and ``_ord``,
    which sorts rows as they stand in the files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if options.multiline and options.split:
        if provenance:
            raise ValueError("records put together from several byte ranges have no position; read them without split")
        return repair_header(_read_records(spark, paths, options))
    if options.rest_in_last:
        df = _read_lines(spark, paths, options)
    else:
        reader = _reader(spark, options)
        if options.columns is not None:
            reader = reader.schema(StructType([StructField(c, StringType()) for c in options.columns]))
        df = reader.csv(paths)
    names = df.columns
    values = [F.regexp_replace(F.col(f"`{c}`"), r"\r+$", "").alias(c) if options.multiline else F.col(f"`{c}`") for c in names]
    return repair_header(df.select(*values, *(provenance_columns() if provenance else [])))


def _read_lines(spark: SparkSession, paths: Sequence[str], options: ReadOptions) -> DataFrame:
    """Lines of unquoted text: separators beyond the last column belong to its value."""
    if options.columns is None:
        raise ValueError("text lines need declared columns")
    lines = _text_lines(spark, paths, options.sep.join(options.columns) if options.header else None)
    pieces = split_parts(F.col("value"), len(options.columns), re.escape(options.sep), extra="merge")
    return lines.where(F.col("value") != "").select(
        *[F.nullif(p, F.lit("NA")).alias(c) for c, p in zip(options.columns, pieces)]
    )


def _read_records(spark: SparkSession, paths: Sequence[str], options: ReadOptions) -> DataFrame:
    """Records with line breaks inside quotes, found by all byte ranges at the same time (see ``multiline``)."""
    if options.encoding.upper() not in ("UTF-8", "US-ASCII"):
        raise ValueError(f"byte ranges are cut in UTF-8, not in {options.encoding}")
    names = list(options.columns) if options.columns is not None else _reader(spark, options).csv(paths[0]).columns
    found = records(spark, paths, options.sep, options.quote, options.trim, options.header)
    parse = {
        "sep": options.sep, "quote": options.quote, "escape": options.quote, "nullValue": "NA", "multiLine": "true",
        "ignoreLeadingWhiteSpace": str(options.trim).lower(), "ignoreTrailingWhiteSpace": str(options.trim).lower(),
    }
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    row = found.select(F.from_csv("value", schema, parse).alias("row"))
    return row.select(*[F.regexp_replace(F.col(f"row.c{i}"), r"\r+$", "").alias(n) for i, n in enumerate(names)])


#: A character that no text line holds: lines are read as tables of one column.
NO_SEPARATOR = "\x01"


def _text_lines(spark: SparkSession, paths: Sequence[str], header: str | None) -> DataFrame:
    """Lines of files as column ``value``, without a trailing carriage return, with ``path``.

    With a header the first line of each file is left out, by its position, and
    must be that text; equal lines below it are data. Empty lines are left out.
    """
    if header is None:
        lines = spark.read.text(list(paths)).withColumnRenamed("value", "__line")
    else:
        schema = StructType([StructField(header, StringType())])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("sep", NO_SEPARATOR).option("quote", "")
        lines = reader.csv(list(paths)).withColumnRenamed(header, "__line")
    return lines.select(F.regexp_replace("__line", r"\r+$", "").alias("value"), F.col("_metadata.file_path").alias("path"))


def provenance_columns() -> list[Column]:
    """File name and position of a scanned row; use directly on a scan."""
    return [
        source_name(F.col("_metadata.file_name")).alias("_src"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_ord"),
    ]


def source_name(file_name: Column) -> Column:
    """File name up to its first dot."""
    return F.regexp_replace(file_name, r"(?s)\..*", "")


def headers(spark: SparkSession, folder: str, include: str | None = None, exclude: str | None = None) -> dict[str, list[str]]:
    """First line → files that begin with it, for the files of a folder that the patterns on the file name choose."""
    lines = spark.read.text(folder).select("value", *[F.col(f"_metadata.{n}").alias(n) for n in ("file_path", "file_name", "file_block_start")])
    if include is not None:
        lines = lines.where(F.col("file_name").rlike(include))
    if exclude is not None:
        lines = lines.where(~F.col("file_name").rlike(exclude))
    numbered = lines.where("file_block_start = 0").withColumn("line", F.monotonically_increasing_id())
    first = numbered.groupBy("file_path").agg(F.min_by("value", "line").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file_path").collect():
        found.setdefault(row["header"], []).append(row["file_path"])
    return found


def read_folder(
    spark: SparkSession,
    folder: str,
    options: ReadOptions = ReadOptions(),
    include: str | None = None,
    exclude: str | None = None,
    provenance: bool = True,
) -> DataFrame:
    """The files of a folder chosen by patterns on the file name, as one table.

    Only chosen files decide the columns. Files may have them in another order:
    each distinct header is read on its own and mapped by name; a file with other
    columns than the first one is an error. Without a header, or with declared
    columns, all files are read alike.
    """
    if not options.header or options.columns is not None:
        reader = _reader(spark, options)
        if options.columns is not None:
            reader = reader.schema(StructType([StructField(c, StringType()) for c in options.columns])).option("enforceSchema", False)
        df = reader.csv(folder)
        names, file_name = df.columns, F.col("_metadata.file_name")
        if include is not None:
            df = df.where(file_name.rlike(include))
        if exclude is not None:
            df = df.where(~file_name.rlike(exclude))
        return repair_header(df.select(*[F.col(f"`{c}`") for c in names], *(provenance_columns() if provenance else [])))
    found = headers(spark, folder, include, exclude)
    if not found:
        raise ValueError(f"no file of {folder} is chosen")
    out = None
    for paths in found.values():
        df = read_delimited(spark, paths, options, provenance)
        if out is not None and set(df.columns) != set(out.columns):
            raise ValueError(f"{paths[0]} has the columns {df.columns}, not {out.columns}")
        out = df if out is None else out.unionByName(df)
    return out


def read_checked(spark: SparkSession, path: str, columns: Sequence[str], options: ReadOptions = ReadOptions()) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the declared columns, and the raw text of those that do not.

    For files with one row per line; the header must have the declared names.
    """
    schema = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
    parse = {
        "sep": options.sep, "quote": options.quote, "escape": options.quote, "nullValue": "NA",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
    }
    lines = _text_lines(spark, [path], options.sep.join(columns) if options.header else None).withColumnRenamed("value", "raw")
    parsed = lines.withColumn("row", F.from_csv("raw", schema, parse))
    bad = F.col(f"row.{MALFORMED}").isNotNull()
    good_rows = parsed.where(~bad).select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
    return good_rows, parsed.where(bad).select("raw", "path")


def read_sheets(spark: SparkSession, folder: str, name_column: str, options: ReadOptions = ReadOptions(), prefix: str = "") -> DataFrame:
    """Workbook sheets exported to one file each; the sheet name becomes a column."""
    df = read_folder(spark, folder, options)
    return df.withColumn(name_column, F.regexp_replace("_src", f"^{prefix}", "")).drop("_src", "_ord")
