"""Checks of tables and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from seawarden.functions.text import quote


def tables(
    spark: SparkSession, frames: Mapping[str, DataFrame | None], expected: Mapping[str, int | None] | None = None
) -> DataFrame:
    """One line per table: rows, expected rows, difference, status. A missing table is an ERROR line."""
    lines = []
    for name, frame in frames.items():
        target = (expected or {}).get(name)
        target = "cast(NULL AS bigint)" if target is None else f"{target}L"
        if frame is None:
            counts = spark.range(1).selectExpr("cast(NULL AS bigint) AS row_count")
        else:
            counts = frame.agg(F.expr("count(1) AS row_count"))
        lines.append(
            counts.selectExpr(
                f"{quote(name)} AS table_name",
                "row_count",
                f"{target} AS expected",
                f"row_count - {target} AS delta",
                "CASE WHEN row_count IS NULL THEN 'ERROR' WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status",
            )
        )
    return reduce(DataFrame.unionByName, lines)


def content(columns: Sequence[str]) -> str:
    """A sum over all rows that changes with any of the columns' values and not with the order of rows."""
    row = f"concat_ws('|', {', '.join(f'cast({name} AS string)' for name in columns)})"
    return f"coalesce(sum(cast(conv(substr(md5({row}), 1, 8), 16, 10) AS bigint)), 0L)"


def saved_tables(
    spark: SparkSession, expected: Mapping[str, int | None], database: str | None = None
) -> DataFrame:
    """``tables`` for saved tables, by name."""
    frames = {}
    for name in expected:
        full = f"{database}.{name}" if database else name
        frames[name] = spark.table(full) if spark.catalog.tableExists(full) else None
    return tables(spark, frames, expected)


def columns(
    df: DataFrame,
    key: Sequence[str],
    required: Sequence[str] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One line per check: nulls in required columns, values out of range, repeated keys.

    A single pass groups by the key, counts the rows and the broken checks of each, and adds up. The
    grouping combines on the map side, so a key that repeats often does not gather its rows.
    """
    checks = {f"{name} is null": f"{name} IS NULL" for name in required}
    for name, (low, high) in (ranges or {}).items():
        checks[f"{name} out of range"] = f"{name} NOT BETWEEN {low} AND {high}"
    broken = [F.expr(f"count_if({test}) AS _c{i}") for i, test in enumerate(checks.values())]
    per_key = df.groupBy(*key).agg(F.expr("count(1) AS _n"), *broken)
    totals = per_key.agg(
        F.expr("coalesce(sum(_n), 0L) AS rows_checked"),
        F.expr("coalesce(sum(_n - 1), 0L) AS _repeated"),
        *[F.expr(f"coalesce(sum(_c{i}), 0L) AS _c{i}") for i in range(len(checks))],
    )
    named = {f"{', '.join(key)} repeated": "_repeated", **{name: f"_c{i}" for i, name in enumerate(checks)}}
    lines = ", ".join(f"struct({quote(name)} AS check_name, {column} AS breaks)" for name, column in named.items())
    return totals.selectExpr("rows_checked", f"inline(array({lines}))").selectExpr(
        "check_name",
        "rows_checked",
        "breaks",
        "round(breaks / nullif(rows_checked, 0L), 4) AS break_rate",
        "if(breaks = 0, 'OK', 'BROKEN') AS status",
    )
