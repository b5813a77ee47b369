"""DataFrame -> DataFrame operators, made for ``df.transform``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def add(df: DataFrame, **expressions: str) -> DataFrame:
    """New columns from SQL expressions over the columns of ``df``."""
    return df.selectExpr("*", *[f"{text} AS {name}" for name, text in expressions.items()])


def replace(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """The same columns in the same order, some of them replaced."""
    return df.selectExpr(*[f"{expressions[c]} AS {c}" if c in expressions else c for c in df.columns])
