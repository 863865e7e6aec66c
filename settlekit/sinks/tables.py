"""Batch sinks: Parquet folders (default) or JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.sources.tables import jdbc_options, table_path


def stamp(df: DataFrame, column: str = "computed_at") -> DataFrame:
    """Audit time added by the sink, never by a transform."""
    return df.withColumn(column, F.current_timestamp())


def write_table(df: DataFrame, name: str, *, mode: str = "append", fmt: str = "parquet",
                root: str | None = None, partition_by: list[str] | None = None,
                jdbc: dict | None = None, truncate: bool = True) -> None:
    """Write a whole table.

    ``mode="overwrite"`` replaces the content; over JDBC with ``truncate`` the
    table definition (keys, defaults, grants) is kept and only rows go.
    Parquet output can be partitioned, e.g. raw events by event day, so later
    reads prune by date.
    """
    if fmt == "parquet":
        if root is None:
            raise ValueError("parquet tables need a root folder")
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(table_path(root, name))
        return
    if fmt == "jdbc":
        w = df.write.format("jdbc").options(**(jdbc or jdbc_options())).option("dbtable", name).mode(mode)
        if mode == "overwrite" and truncate:
            w = w.option("truncate", "true")
        w.save()
        return
    raise ValueError(f"unknown table format {fmt!r}")
