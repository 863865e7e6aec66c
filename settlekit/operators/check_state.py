"""Quality checks from stored monthly states: a run reads the months that changed.

The fused checks of a table (not_null, accepted_values, range, freshness,
row_count) are aggregates that can be merged: counts add up, extremes of extremes
are extremes. So each month's aggregates are stored once, as one row, and a run
merges the rows of all months; only months that are new or named as changed are
read from the table. The moments of an outlier check (n, sum, sum of squares, least
and greatest value) are kept the same way; its bounds come from all months, and
then only months whose extremes lie outside the bounds are read to count.

Uniqueness and referential integrity compare keys across months and are run as
always (over an index of the keys where there is one).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.operators import quality
from settlekit.operators.quality import _all_rows, _need, _one_row, _Plan, _planned
from settlekit.sinks.snapshots import open_table, replace_table

MONTH = "event_month"
STATE_MONTH, NO_MONTH = "state_month", "none"


def _in_months(month: str, wanted) -> Column:
    """Rows of these months; a filter on the partition column, so other months' files aren't read."""
    some = F.col(month).isin(sorted(w for w in wanted if w != NO_MONTH))
    return some | F.col(month).isNull() if NO_MONTH in wanted else some


def state_table(table: str) -> str:
    return f"state.{table}"


def _moments(plan: _Plan, df: DataFrame, cfg: dict) -> dict:
    """Adds the moments of the column to the plan; their names."""
    c = cfg["column"]
    _need(df, c, quality.NumericType)
    x = F.col(c).cast("double")
    names = {k: f"_{k}_{c}" for k in ("count", "total", "squares", "least", "greatest")}
    plan.agg(names["count"], F.count(F.col(c)))
    plan.agg(names["total"], F.coalesce(F.sum(x), F.lit(0.0)))
    plan.agg(names["squares"], F.coalesce(F.sum(x * x), F.lit(0.0)))
    plan.agg(names["least"], F.min(x), "min")
    plan.agg(names["greatest"], F.max(x), "max")
    return names


def _outliers(df: DataFrame, table: str, cfg: dict, names: dict, state: DataFrame, month: str) -> DataFrame:
    """The outlier check over the months whose extremes pass the bounds of all months."""
    c, n = cfg["column"], float(cfg.get("n_stddev", 3))
    sev = cfg.get("severity", quality.DEFAULT_SEVERITY["statistical_outlier"])
    count, total, squares = state.agg(*[F.coalesce(F.sum(F.col(f"`{names[k]}`")), F.lit(0))
                                        for k in ("count", "total", "squares")]).first()
    mean = total / count if count else 0.0
    sd = (max(0.0, squares - count * mean * mean) / (count - 1)) ** 0.5 if count > 1 else 0.0
    lower, upper = mean - n * sd, mean + n * sd
    name = f"outlier_{c}"
    months = []
    if sd:
        least, greatest = F.col(f"`{names['least']}`"), F.col(f"`{names['greatest']}`")
        months = [r[0] for r in state.filter((least < lower) | (greatest > upper)).select(STATE_MONTH).collect()]
    x = F.col(c).cast("double")
    found = df.filter(_in_months(month, months)).agg(
        F.count_if((x < lower) | (x > upper)).alias("outliers"))
    details = (F.lit(f"Column '{c}': no data to check") if not count
               else F.lit(f"Column '{c}': stddev is 0, no outliers possible") if not sd
               else F.format_string("Column '%s': %d outliers outside [%.2f, %.2f] (mean=%.2f, sd=%.2f)", F.lit(c),
                                    F.col("outliers"), F.lit(lower), F.lit(upper), F.lit(mean), F.lit(sd)))
    return _one_row(found, table, name, "statistical_outlier", quality._fail_if(F.col("outliers") > 0, "WARN"),
                    F.lit(count), F.col("outliers"), details, sev)


def incremental_checks(df: DataFrame, table: str, checks: list[dict], root: str, *, changed: list[str] | None = None,
                       month: str = MONTH, refs: dict[str, DataFrame] | None = None, as_of: _dt.datetime | None = None,
                       indexes: dict | None = None) -> DataFrame:
    """The results of ``run_table_checks``, reading only months that are new or ``changed``.

    ``df`` has a month column that its files are partitioned by (rows without one
    are a month of their own). States are stored below ``root``; where the checks ask
    for other aggregates than are stored, all months are read again. ``changed``
    None reads new months only.
    """
    outliers: list[tuple[dict, dict]] = []
    own = _Plan()
    plan, separate = _planned(df, table, checks, refs or {}, as_of, indexes or {},
                              outlier=lambda cfg: outliers.append((cfg, _moments(own, df, cfg))))
    plan.take(own)
    spark, name = df.sparkSession, state_table(table)
    if not plan.aggs:
        return _all_rows(spark, separate)
    stored = open_table(spark, root, name)
    if stored is not None and set(stored.columns) != {*plan.aggs, STATE_MONTH}:
        stored = None
    label = F.coalesce(F.col(month).cast("string"), F.lit(NO_MONTH))
    known = set() if stored is None else {r[0] for r in stored.select(STATE_MONTH).collect()}   # a row a month
    there = {r[0] for r in df.select(label).distinct().collect()}                              # partition values
    wanted = (there - known) | (set(changed or ()) & there)
    gone = known - there
    if wanted or gone or stored is None:
        fresh = df.filter(_in_months(month, wanted)).groupBy(label.alias(STATE_MONTH)).agg(*plan.aggs.values())
        replace_table(fresh.select(*plan.aggs, STATE_MONTH).coalesce(1), root, name, partition_by=[STATE_MONTH],
                      values=None if stored is None else sorted(wanted | gone))
    state = open_table(spark, root, name)
    parts = []
    if plan.results:
        parts.append(state.agg(*plan.merged()).select(F.inline(F.array(*plan.results))))
    parts += [_outliers(df, table, cfg, names, state, month) for cfg, names in outliers]
    return _all_rows(spark, parts + separate)
