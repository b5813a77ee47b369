"""Databases and managed tables. Every write replaces the table, so a rerun gives the same rows.

A table is replaced only when its new rows are stored in whole: a job that dies while it writes leaves the old rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from seawarden.session import remove_folder
from seawarden.sources import schemas


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create a database if it is not there. The current database stays as it is."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    return name


def create_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """An empty typed table with column comments; an existing table is left as it is."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, schema=schema, source=fmt)
    return spark.table(name)


def register(spark: SparkSession, name: str, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table over files that are already stored, without a copy; an older entry is replaced."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path=path, source=fmt, schema=schema)


def load_rows(df: DataFrame, name: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Fill a typed table, replacing what it held; ``fmt`` is the format of a table that is created here."""
    spark = df.sparkSession
    create_table(spark, name, schema, fmt)
    out = schemas.conform(df, schema)
    held = _shape(spark, name)
    if held["partitions"]:
        out.write.insertInto(name, overwrite=True)
    else:
        _switch(out, name, held)
    return read(spark, name, schema)


def _shape(spark: SparkSession, name: str) -> dict:
    """Format, location, kind and partition columns of a table, as its catalog entry tells them."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    told = dict(rows[next(k for k, r in enumerate(rows) if r[0] == "# Detailed Table Information") :])
    partitions = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    return {"format": told["Provider"].lower(), "location": told["Location"], "managed": told["Type"] == "MANAGED", "partitions": partitions}


def _switch(df: DataFrame, name: str, held: dict) -> None:
    """Store the rows beside a table's files, then let the table point there, and remove its older files.

    The table never lacks rows: one catalog change separates the old ones from the new ones.
    """
    spark, old = df.sparkSession, held["location"]
    new = f"{re.sub('__v[0-9a-f]{32}$', '', old.rstrip('/'))}__v{uuid.uuid4().hex}"
    try:
        df.write.format(held["format"]).save(new)
    except Exception:
        remove_folder(spark, new)
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    if held["managed"]:
        remove_folder(spark, old)


def save(
    df: DataFrame,
    name: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write a managed table, replacing an older one, and return it as read back.

    Reading it back cuts the lineage at a stored table. With ``partition_by``, a rebalance step
    gathers each partition's rows into few files, and splits a partition that is too large for one.

    A table of the same columns, format and partitions gets its new rows by one change of the catalog; one that is
    partitioned or of another shape is written under a name of its own first, which then takes the old one's place.
    """
    spark = df.sparkSession
    out = schemas.conform(df, schema) if schema is not None else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    there = spark.catalog.tableExists(name)
    held = _shape(spark, name) if there else None
    if there and not partition_by and not held["partitions"] and held["format"] == fmt and _same(out, spark.table(name)):
        _switch(out, name, held)
        return read(spark, name, schema)
    staged = f"{name}__{uuid.uuid4().hex}" if there else name
    writer = out.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if there:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        if partition_by:  # a catalog may still have the partitions where they were written
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return read(spark, name, schema)


def _same(df: DataFrame, table: DataFrame) -> bool:
    """Whether rows have the columns of a table, with types and comments, in its order."""
    columns = [[(f.name, f.dataType, f.metadata.get("comment")) for f in frame.schema.fields] for frame in (df, table)]
    return columns[0] == columns[1]


def read(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A table, checked against its schema if one is given."""
    df = spark.table(name)
    return schemas.check(df, schema) if schema is not None else df
