"""Joins and set operations on contig tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def annotate(*tables: DataFrame, how: str = "inner") -> DataFrame:
    """All tables joined by contig, inner or outer."""
    if how not in ("inner", "outer"):
        raise ValueError("how is inner or outer")
    return reduce(lambda a, b: a.join(b, "contig", how), tables)


def stack(*tables: DataFrame) -> DataFrame:
    """All rows, columns by name, missing ones null, in the order of names."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return out.select(*sorted(out.columns))


def within(rows: DataFrame, others: DataFrame) -> DataFrame:
    return rows.join(others.select("contig").distinct(), "contig", "left_semi")


def without(rows: DataFrame, others: DataFrame) -> DataFrame:
    return rows.join(others.select("contig").distinct(), "contig", "left_anti")


def either(a: DataFrame, b: DataFrame, column: str = "contig") -> DataFrame:
    return a.select(column).union(b.select(column)).distinct()
