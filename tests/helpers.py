"""Small builders shared by the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisieve.schemas import CHANGE_LOG, CORPUS, REQUESTS


def corpus(spark, rows):
    """rows: (path, text) in add order."""
    return spark.createDataFrame([(p, i, t) for i, (p, t) in enumerate(rows, start=1)], CORPUS)


def log(spark, rows):
    """rows: (op, path, text) in call order; seq = 10, 20, ..."""
    return spark.createDataFrame([(10 * i, op, p, t) for i, (op, p, t) in enumerate(rows, start=1)], CHANGE_LOG)


def requests(spark, lines):
    return spark.createDataFrame([(i, ln) for i, ln in enumerate(lines, start=1)], REQUESTS)


def paths(df):
    return [r["path"] for r in df.collect()]


def pairs(df):
    return sorted((r["path"], r["word"]) for r in df.select("path", "word").collect())


def responses(lines_df):
    """Response text per request id, assembled on the driver (tests only)."""
    out: dict[int, list[str]] = {}
    for r in lines_df.orderBy("req_id", "part", "line").collect():
        out.setdefault(r["req_id"], []).append(r["line"])
    return {k: "\n".join(v) + "\n" for k, v in out.items()}


def col_list(df, name):
    return [r[0] for r in df.select(F.col(name)).collect()]
