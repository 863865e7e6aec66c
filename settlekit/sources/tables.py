"""Batch table sources: Parquet (default) and JDBC.

A table is addressed by a logical name such as ``raw.payment_events``. With
``fmt="parquet"`` it lives at ``<root>/<name>``; with ``fmt="jdbc"`` it is read
through Spark's JDBC source, in parallel when partition options are given.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from settlekit.sinks.snapshots import open_table

# Environment variables naming the JDBC connection; there is no default
# password: it must come from the environment or the caller.
JDBC_ENV = {
    "host": ("PAYMENTS_DB_HOST", "localhost"),
    "port": ("PAYMENTS_DB_PORT", "5432"),
    "database": ("PAYMENTS_DB_NAME", "payments"),
    "user": ("PAYMENTS_DB_USER", None),
    "password": ("PAYMENTS_DB_PASSWORD", None),
    "driver": ("PAYMENTS_DB_DRIVER", "org.postgresql.Driver"),
}


def jdbc_options(env: dict | None = None, url: str | None = None) -> dict:
    """Reader/writer options for the payments database from the environment."""
    env = os.environ if env is None else env
    vals = {k: env.get(var, default) for k, (var, default) in JDBC_ENV.items()}
    opts = {
        "url": url or f"jdbc:postgresql://{vals['host']}:{vals['port']}/{vals['database']}",
        "driver": vals["driver"],
    }
    if vals["user"] is not None:
        opts["user"] = vals["user"]
    if vals["password"] is not None:
        opts["password"] = vals["password"]
    return opts


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, name: str, *, fmt: str = "parquet", root: str | None = None,
               jdbc: dict | None = None, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """Load a whole table.

    Parquet gives column pruning, predicate and partition pushdown for free.
    For JDBC, ``partition_column``/bounds/``num_partitions`` split the read
    into parallel range queries instead of one task; filters written with
    ``.filter`` are pushed into the generated SQL by Spark.
    """
    if fmt == "parquet":
        if root is None:
            raise ValueError("parquet tables need a root folder")
        snapshot = open_table(spark, root, name)   # a table with a snapshot log
        return spark.read.parquet(table_path(root, name)) if snapshot is None else snapshot
    if fmt == "jdbc":
        reader = spark.read.format("jdbc").options(**(jdbc or jdbc_options())).option("dbtable", name)
        if partition_column is not None:
            if lower_bound is None or upper_bound is None or not num_partitions:
                raise ValueError("partitioned JDBC reads need bounds and num_partitions")
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound))
                      .option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions)))
        return reader.load()
    raise ValueError(f"unknown table format {fmt!r}")


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
