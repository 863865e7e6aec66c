"""Write contracts: the constraints a target table enforces, checked in Spark,
one aggregate per table (plus one grouped count for the key). ``enforced`` is the
form jobs write through: it raises before anything is written.

With ``single_pass`` the counters ride along in the grouped count of the key
and are summed after it: one pass over ``df`` instead of two. That is the form
for a derived table (a mart), whose second pass would recompute it from the
raw events; a stored table keeps the two passes, as its key count reads the
key column alone and shuffles no counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.schemas import CONTRACTS
from settlekit.session import stage_table

VIOLATION_COLUMNS = ["table_name", "constraint_name", "column_name", "violations"]


def _row(table: str, constraint: str, column: str, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                    F.lit(column).alias("column_name"), n.cast("long").alias("violations"))


def check_contract(df: DataFrame, table: str, spec: dict | None = None, *,
                   single_pass: bool = False) -> DataFrame:
    """One row per constraint with its number of violating rows.

    * ``not_null``: NULLs in a NOT NULL column;
    * ``max_length``: text longer than the column allows;
    * ``decimal``: values that do not fit DECIMAL(p, s) (overflow);
    * ``primary_key``: rows beyond the first of each key (NULL keys included).
    """
    spec = spec or CONTRACTS[table]
    rows, aggs = [], []
    for c in spec.get("not_null", []):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nn_{c}"))
        rows.append(_row(table, "not_null", c, F.col(f"nn_{c}")))
    for c, n in spec.get("max_length", {}).items():
        if c in df.columns:
            aggs.append(F.count_if(F.length(F.col(c)) > n).alias(f"len_{c}"))
            rows.append(_row(table, f"max_length_{n}", c, F.col(f"len_{c}")))
    for c, (p, s) in spec.get("decimal", {}).items():
        if c in df.columns:
            bad = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
            aggs.append(F.count_if(bad).alias(f"dec_{c}"))
            rows.append(_row(table, f"decimal_{p}_{s}", c, F.col(f"dec_{c}")))
    key = spec.get("key") or []
    if key and single_pass:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *aggs)
        names = [a for a in per_key.columns if a != "n" and a not in key]
        # sums over no rows are NULL where count_if gives 0
        total = per_key.agg(*[F.coalesce(F.sum(a), F.lit(0)).alias(a) for a in names],
                            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"))
        rows.append(_row(table, "primary_key", ",".join(key), F.col("d")))
        return total.select(F.inline(F.array(*rows)))
    parts = []
    if aggs:
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    if key:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        dups = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"))
        parts.append(dups.select(F.inline(F.array(_row(table, "primary_key", ",".join(key), F.col("d"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_types(df: DataFrame, table: str) -> DataFrame:
    """The columns cast to the stored decimals (values that don't fit were refused by ``enforced``)."""
    casts = {c: F.col(c).cast(f"decimal({p},{s})") for c, (p, s) in CONTRACTS[table]["decimal"].items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def enforced(df: DataFrame, table: str) -> DataFrame:
    """``df`` staged once, checked against the table's contract, and cast to its stored types.

    Raises ``ValueError`` when any row violates the contract.
    """
    staged = stage_table(df, "contract")
    assert_contract(staged, table)
    return stored_types(staged, table)


def assert_contract(df: DataFrame, table: str, spec: dict | None = None) -> None:
    """Raise before writing when any constraint would reject rows."""
    bad = check_contract(df, table, spec).filter(F.col("violations") > 0).collect()
    if bad:
        raise ValueError(f"{table}: contract violations {[r.asDict() for r in bad]}")
