"""Binary files through Spark's own file layer.

Records of bytes are written by the text sink (a binary cast to string keeps
its bytes) and read by the binaryFile source, so any store that Spark reaches
works, and a task's output is committed as a whole or not at all: a lost
executor's half-written file never shows. Every record is followed by a
separator that the file format defines (ASCII).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.session import scratch_path


def write(records: DataFrame, column: str, separator: str, name: str, per_file: int = 64) -> str:
    """Files of at most ``per_file`` records, in each partition's order; returns the folder.

    Records are of bounded size, so files are too, whatever a partition holds.
    """
    path = scratch_path(records.sparkSession, name)
    (records.select(F.col(column).cast("string").alias("value")).write.option("lineSep", separator)
     .option("compression", "none").option("maxRecordsPerFile", per_file).text(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every file of the folder."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("path", "content"))
