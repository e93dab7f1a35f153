"""Small tables for the tests."""

from __future__ import annotations


def documents(spark, rows, extra=False):
    """rows: (doc_id, text)."""
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.selectExpr("*", "1 AS slot", "'x' AS law", "2 AS a", "3 AS b", "4 AS n", "5 AS node", "'y' AS sha", "6 AS score", "7 AS start")
    return df


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
