"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Rows and bytes up to which a dimension side is shipped to every task.
DEFAULT_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: 8 for fixed widths, the length of texts, JSON text for nested values."""
    out = F.lit(0).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (StringType, BinaryType)):
            n = F.octet_length(F.col(f"`{f.name}`"))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            n = F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
        else:
            n = F.lit(8)
        out = out + F.coalesce(n, F.lit(8))
    return out


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; reads no more than a row past the bound."""
    n, size = (df.limit(max_rows + 1).select(row_bytes(df).alias("b"))
               .agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first())
    return n <= max_rows and size <= max_bytes


def join_small_side(large: DataFrame, small: DataFrame, on, how: str = "inner",
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join ``large`` with a side that is usually small.

    The small side is counted and measured first, up to ``max_rows + 1`` rows
    (one cheap job over a pruned, filtered scan that stops once the bound is
    passed). Only when that proves it under both bounds is it broadcast,
    which also keeps a low-cardinality join key from funnelling a large share
    of ``large`` into a few shuffle tasks. Beyond the bound the join is left to
    the planner (sort-merge; AQE splits skewed partitions).
    """
    if fits(small, max_rows):
        return large.join(F.broadcast(small), on, how)
    return large.join(small, on, how)
