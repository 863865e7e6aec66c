"""Labels, folds and bounded training samples shared by the learned operators.

Fold of a document: crc32 of its id as text, modulo 5; remainder 0 is held
out and never used for learning. A null id counts as the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def training_labels(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, y) of the learning fold, one row per id, at most ``bound`` rows
    taken in the order of a hash of the id. Null ids and null labels are left
    out; of several labels of one id the largest holds.
    """
    y = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
         .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
         .groupBy("doc_id").agg(F.max("y").alias("y")))
    return y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that no column of ``df`` has (case doesn't count)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
