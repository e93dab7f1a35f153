"""Quoted text with line breaks inside fields, split over tasks by byte ranges.

A line alone does not tell whether it begins inside a quoted field. Each line is read under both assumptions, which makes it one of four
functions of the state before it: it ends inside, it ends outside, it keeps the state, or it turns it round. The state after
any line is then that of the last line that settles it, turned round once for each turning line since: a running sum and
a last value within a byte range, and the same over the ranges of a file. So ranges are read at the same time, and only
the lines of records with line breaks are brought together.

Records, fields and quotes mean what they mean to Spark's own reader: a quote opens a field at its very start only, two
quotes inside are one, and what follows a closing quote is plain text up to the separator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemend.operators.guards import fail_if

#: Most lines that one record may have; a quote that is never closed would make one record of all that follows.
LINES = 100_000


def _ends_inside(line: Column, inside: bool, sep: str, quote: str, trim: bool) -> Column:
    """Is the end of a line inside a quoted field, if its start is or is not?"""
    parts = F.split(line, f"\\Q{quote}\\E", -1)
    # Between every two parts stands a quote; `text` is what precedes it.
    before = F.slice(parts, F.lit(1), F.size(parts) - 1)
    start = F.struct(F.lit(inside).alias("inside"), F.lit(False).alias("closed"), F.lit(True).alias("first"))

    def step(state: Column, text: Column) -> Column:
        bare = F.rtrim(text) if trim else text
        doubled = state["closed"] & (text == "")
        opens = F.endswith(bare, F.lit(sep)) | (state["first"] & (bare == ""))
        inside_now = F.when(state["inside"], F.lit(False)).otherwise(doubled | opens)
        return F.struct(inside_now.alias("inside"), state["inside"].alias("closed"), F.lit(False).alias("first"))

    return F.aggregate(before, start, step)["inside"]


def _lines(spark: SparkSession, paths: Sequence[str], sep: str, quote: str, trim: bool) -> DataFrame:
    """path, range, line (their order), value, and how each line treats the state: settles, ends_inside, turns."""
    read = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("line"), "value"
    )
    quoted = F.contains("value", F.lit(quote))
    told = read.withColumns({
        "outside_in": F.when(quoted, _ends_inside(F.col("value"), False, sep, quote, trim)).otherwise(F.lit(False)),
        "inside_in": F.when(quoted, _ends_inside(F.col("value"), True, sep, quote, trim)).otherwise(F.lit(True)),
    })
    same = F.col("outside_in") == F.col("inside_in")
    return told.select("path", "range", "line", "value", F.when(same, F.col("outside_in")).alias("settled"), (~same & F.col("outside_in")).cast("int").alias("turns"))


def _running(df: DataFrame, window: Window, settled: str, turns: str) -> tuple[Column, Column]:
    """State after each row as (known, value): known if a row up to it settles it; else value says whether the state is turned round."""
    odd = (F.sum(turns).over(window) % 2) == 1
    # A settled state, turned back by all turns before it, so that all turns up to now can be applied.
    at = F.when(F.col(settled).isNotNull(), F.col(settled) != odd)
    last = F.last(at, ignorenulls=True).over(window)
    return last.isNotNull(), F.coalesce(last, F.lit(False)) != odd


def records(spark: SparkSession, paths: Sequence[str], sep: str = ",", quote: str = '"', trim: bool = False, header: bool = False, most_lines: int = LINES) -> DataFrame:
    """path and value of every record that is not empty, without the line break behind it and, with ``header``, without the first of each file."""
    if not quote:
        raise ValueError("without quotes no record has line breaks; read plain lines")
    in_range = Window.partitionBy("path", "range").orderBy("line")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, 0)
    lines = _lines(spark, paths, sep, quote, trim)
    known, value = _running(lines, so_far, "settled", "turns")
    lines = lines.withColumns({"known": known, "state": value, "place": F.row_number().over(in_range)})

    # One row per byte range: what it makes of the state, and its end.
    ranges = lines.groupBy("path", "range").agg(
        F.max_by("known", "line").alias("known"), F.max_by("state", "line").alias("state"), F.max(F.when(F.col("place") == 1, F.endswith("value", F.lit("\r")))).alias("crlf")
    )
    ranges = ranges.select("path", "range", "crlf", F.when(F.col("known"), F.col("state")).alias("settled"), (~F.col("known") & F.col("state")).cast("int").alias("turns"))
    of_file = Window.partitionBy("path").orderBy("range")
    known, value = _running(ranges, of_file.rowsBetween(Window.unboundedPreceding, 0), "settled", "turns")
    # A file begins outside, so an unknown state is that, turned round or not.
    # The first line break of a file tells what its line breaks are.
    entry = ranges.withColumn("after", value).select(
        "path", "range", F.coalesce(F.lag("after").over(of_file), F.lit(False)).alias("entry"), F.first("crlf").over(of_file).alias("crlf")
    )

    stated = lines.join(entry, ["path", "range"]).withColumn("after", F.when(F.col("known"), F.col("state")).otherwise(F.col("state") != F.col("entry")))
    stated = stated.withColumn("starts", ~F.coalesce(F.lag("after").over(in_range), F.col("entry")))
    stated = stated.withColumn("start", F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True).over(so_far))
    first = (F.col("range") == 0) & (F.col("place") == 1)
    kept = ["path", "range", "line", "start", F.col("starts"), F.col("after"), "value", "crlf", (first & F.col("starts")).alias("is_first")]
    stated = stated.select(*kept)

    # Most records are one line; only the others are brought together.
    whole = stated.where("starts AND NOT after").select("path", "value", "is_first")
    parts = stated.where("NOT starts OR after")
    opened = parts.where("start IS NOT NULL").groupBy("path", "range").agg(F.max("start").alias("opened"))
    earlier = parts.select("path", "range").distinct().join(opened, ["path", "range"], "left").withColumn(
        "from", F.last(F.when(F.col("opened").isNotNull(), F.struct("range", "opened")), ignorenulls=True).over(of_file.rowsBetween(Window.unboundedPreceding, -1))
    )
    placed = parts.join(earlier.select("path", "range", "from"), ["path", "range"]).withColumn(
        "record", F.when(F.col("start").isNotNull(), F.struct(F.col("range"), F.col("start").alias("opened"))).otherwise(F.col("from"))
    )
    joined = placed.groupBy("path", "record").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("range", "line", "value"))).alias("parts"), F.max("is_first").alias("is_first"), F.max("crlf").alias("crlf")
    )
    joined = joined.where(fail_if(F.col("n") > most_lines, f"a record has more than {most_lines} lines; is a quote not closed?"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    # As Spark's reader does, the file's own line breaks inside fields become plain ones.
    long = joined.select("path", F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text).alias("value"), "is_first")
    found = whole.unionByName(long).withColumn("value", F.regexp_replace("value", "\r+$", "")).where("value <> ''")
    return (found.where("NOT is_first") if header else found).select("path", "value")
