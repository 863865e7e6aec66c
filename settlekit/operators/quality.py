"""Declarative data-quality checks, fused into few Spark passes.

A check is a config dict (``{"check": "range_check", "column": "amount",
"min": 0.01, ...}``). For one table, all checks that need only whole-table
aggregates (not_null, accepted_values, range_check, freshness, row_count) are
planned as **one** ``agg``; the results are then unpivoted in Spark into one row
per check. uniqueness, referential_integrity, the outlier moments and the
outlier count need their own pass each. Nothing
is collected to the driver: the suite result is a DataFrame.
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from settlekit.operators.joins import DEFAULT_BROADCAST_ROWS, fits
from settlekit.schemas import CHECK_RESULT_COLUMNS
from settlekit.session import stage_table

log = logging.getLogger("settlekit.quality")

DEFAULT_SEVERITY = {
    "not_null": "critical",
    "accepted_values": "warning",
    "uniqueness": "critical",
    "range_check": "warning",
    "freshness": "warning",
    "referential_integrity": "warning",
    "statistical_outlier": "warning",
    "row_count": "critical",
}
CHECK_TYPES = list(DEFAULT_SEVERITY)
SAMPLE_SIZE = 5


class QualityGateError(RuntimeError):
    """Raised when a check with severity ``critical`` has status FAIL."""


def failure_percentage(failed: Column, total: Column) -> Column:
    """failed / total * 100 rounded to 2 digits (half even); 0 for no rows."""
    return F.when(total > 0, F.bround(failed * 100.0 / total, 2)).otherwise(F.lit(0.0))


def _result(table: str, name: str, ctype: str, status: Column, checked: Column, failed: Column,
            details: Column, severity: str, pct: Column | None = None) -> Column:
    checked, failed = checked.cast("long"), failed.cast("long")
    pct = failure_percentage(failed, checked) if pct is None else pct
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        F.lit(ctype).alias("check_type"),
        status.alias("status"),
        checked.alias("records_checked"),
        failed.alias("records_failed"),
        pct.cast("double").alias("failure_percentage"),
        details.cast("string").alias("details"),
        F.lit(severity).alias("severity"),
    )


def _fail_if(cond: Column, bad: str = "FAIL") -> Column:
    return F.when(cond, F.lit(bad)).otherwise(F.lit("PASS"))


def _all_or_nothing(ok: Column) -> Column:
    """Percentage of checks that fail the whole table: 0 or 100."""
    return F.when(ok, F.lit(0.0)).otherwise(F.lit(100.0))


def _ts_lit(t: _dt.datetime) -> Column:
    """A wall-clock time in the session zone (UTC), independent of the Python zone."""
    return F.lit(t.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")


def _need(df: DataFrame, column: str, *kinds) -> None:
    """The column's type must be one of ``kinds``: a check that can't compare its values is an error, not a pass."""
    kind = df.select(F.col(column)).schema[0].dataType
    if not isinstance(kind, kinds):
        raise TypeError(f"column {column} has type {kind.simpleString()}")


def _typed(df: DataFrame, column: str, values: list) -> list[Column]:
    """Literals that compare with the column in its own type; a value of another kind is an error of the check.

    Without this a text where a number is due passes analysis and fails the whole run
    when it is cast. The casts are folded on the driver, no job runs.
    """
    kind = df.select(F.col(column)).schema[0].dataType
    out = []
    for v in values:
        if v is None or (isinstance(kind, NumericType) and isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)):
            out.append(F.lit(v))
            continue
        as_kind = "double" if isinstance(kind, NumericType) else kind.simpleString()
        cast = F.lit(v).cast("string").try_cast(as_kind)
        if df.sparkSession.sql("SELECT 1").select(cast.isNull()).first()[0]:
            raise TypeError(f"value {v!r} can't be compared with column {column} of type {kind.simpleString()}")
        out.append(cast)
    return out


@dataclass
class _Plan:
    """Aggregates of the fused pass and result structs that read them."""

    aggs: dict[str, Column] = field(default_factory=dict)
    results: list = field(default_factory=list)  # functions: agg row columns -> struct
    merges: dict[str, str] = field(default_factory=dict)  # how parts of an aggregate are merged, where not by sum

    def agg(self, name: str, expr: Column, merge: str = "sum") -> Column:
        self.aggs.setdefault(name, expr.alias(name))
        if merge != "sum":
            self.merges[name] = merge
        return F.col(name)

    def take(self, other: _Plan) -> None:
        for name, expr in other.aggs.items():
            self.aggs.setdefault(name, expr)
        self.results += other.results
        self.merges |= other.merges

    def merged(self) -> list[Column]:
        """The aggregates of a table from those of its parts."""
        how = {"sum": lambda c: F.coalesce(F.sum(c), F.lit(0)), "min": F.min, "max": F.max}
        return [how[self.merges.get(n, "sum")](F.col(f"`{n}`")).alias(n) for n in self.aggs]


# ---------------------------------------------------------------------------
# fused checks: add aggregates to the plan, return result builders
# ---------------------------------------------------------------------------


def _plan_not_null(p: _Plan, df: DataFrame, cfg: dict, table: str, sev: str) -> None:
    total = p.agg("_rows", F.count(F.lit(1)))
    for c in cfg["columns"]:
        nulls = p.agg(f"_null_{c}", F.count_if(F.col(c).isNull()))
        p.results.append(_result(
            table, f"not_null_{c}", "not_null", _fail_if(nulls > 0), total, nulls,
            F.format_string("Column '%s': %d NULL values out of %d rows", F.lit(c), nulls, total), sev))


def _plan_accepted_values(p: _Plan, df: DataFrame, cfg: dict, table: str, sev: str) -> None:
    c, values = cfg["column"], list(cfg["values"])
    bad = F.col(c).isNotNull() & ~F.col(c).isin(*_typed(df, c, values))
    total = p.agg("_rows", F.count(F.lit(1)))
    label = "_".join([c, *map(str, values)])
    invalid = p.agg(f"_invalid_{label}", F.count_if(bad))
    # samples ride along in the same pass, in bounded state: the least bad value of each class (first hex digit
    # of its MD5), of which the first few are shown; values of different classes are distinct
    text = F.col(c).cast("string")
    first = F.substring(F.md5(text.cast("binary")), 1, 1)
    classes = [p.agg(f"_sample{h}_{label}", F.min(F.when(bad & (first == h), text)), "min")
               for h in "0123456789abcdef"]
    sample_list = F.array_join(F.slice(F.array_sort(F.array_compact(F.array(*classes))), 1, SAMPLE_SIZE), ", ")
    p.results.append(_result(
        table, f"accepted_values_{c}", "accepted_values", _fail_if(invalid > 0), total, invalid,
        F.format_string("Column '%s': %d invalid values. Samples: [%s]", F.lit(c), invalid,
                        F.when(invalid > 0, sample_list).otherwise(F.lit(""))), sev))


def _plan_range(p: _Plan, df: DataFrame, cfg: dict, table: str, sev: str) -> None:
    c, lo, hi = cfg["column"], cfg.get("min"), cfg.get("max")
    _need(df, c, NumericType, DateType, TimestampType, TimestampNTZType)
    conds = []
    if lo is not None:
        conds.append(F.col(c) < _typed(df, c, [lo])[0])
    if hi is not None:
        conds.append(F.col(c) > _typed(df, c, [hi])[0])
    if not conds:
        return
    out = conds[0] if len(conds) == 1 else conds[0] | conds[1]
    checked = p.agg(f"_nonnull_{c}", F.count(F.col(c)))
    key = f"_out_{c}_{lo}_{hi}".replace(".", "_").replace("-", "m")
    failed = p.agg(key, F.count_if(F.col(c).isNotNull() & out))
    p.results.append(_result(
        table, f"range_{c}", "range_check", _fail_if(failed > 0), checked, failed,
        F.format_string("Column '%s': %d values outside [%s, %s]", F.lit(c), failed,
                        F.lit(str(lo)), F.lit(str(hi))), sev))


def _plan_freshness(p: _Plan, df: DataFrame, cfg: dict, table: str, sev: str,
                    as_of: _dt.datetime | None) -> None:
    c, max_age = cfg["column"], cfg["max_age_hours"]
    _need(df, c, DateType, TimestampType, TimestampNTZType)
    total = p.agg("_rows", F.count(F.lit(1)))
    latest = p.agg(f"_max_{c}", F.max(F.col(c)), "max")
    # a date counts from midnight UTC
    latest_ts = latest.cast("timestamp") if isinstance(df.schema[c].dataType, DateType) else latest
    float(max_age)   # a limit that is no number is an error of this check
    now = _ts_lit(as_of) if as_of is not None else F.current_timestamp()
    age_h = (F.unix_micros(now) - F.unix_micros(latest_ts.cast("timestamp"))) / 3.6e9
    fresh = latest.isNotNull() & (age_h <= F.lit(float(max_age)))
    p.results.append(_result(
        table, f"freshness_{c}", "freshness", _fail_if(~fresh), total,
        F.when(fresh, F.lit(0)).otherwise(total),
        F.when(latest.isNull(), F.format_string("Column '%s': no data found (table empty)", F.lit(c)))
        .otherwise(F.format_string("Column '%s': latest record is %.1fh old (SLA: %sh)",
                                   F.lit(c), age_h, F.lit(str(max_age)))), sev, _all_or_nothing(fresh)))


def _plan_row_count(p: _Plan, df: DataFrame, cfg: dict, table: str, sev: str) -> None:
    min_rows = int(cfg.get("min_rows", 1))
    total = p.agg("_rows", F.count(F.lit(1)))
    ok = total >= F.lit(min_rows)
    p.results.append(_result(
        table, "row_count", "row_count", _fail_if(~ok), total,
        F.when(ok, F.lit(0)).otherwise(total),
        F.format_string("Row count: %d (minimum required: %d)", total, F.lit(min_rows)), sev,
        _all_or_nothing(ok)))


# ---------------------------------------------------------------------------
# checks with their own pass
# ---------------------------------------------------------------------------


def _one_row(df: DataFrame, table: str, name: str, ctype: str, status, checked, failed,
             details, sev: str) -> DataFrame:
    return df.select(F.inline(F.array(_result(table, name, ctype, status, checked, failed, details, sev))))


def check_uniqueness(df: DataFrame, cfg: dict, table: str, index: DataFrame | None = None) -> DataFrame:
    """rows - distinct values (NULL counts as one value).

    Duplicates are counted per value with a partial (map-side) count, so a
    value repeated across a third of the table ships one row per map task. With an
    ``index`` (each stored value once) both numbers are plain counts: no shuffle.
    """
    c, sev = cfg["column"], cfg.get("severity", DEFAULT_SEVERITY["uniqueness"])
    if index is not None:
        s = df.agg(F.count(F.lit(1)).alias("total")).select(
            "total", index.agg(F.count(F.lit(1))).scalar().alias("distinct"))
    else:
        counts = df.groupBy(F.col(c)).agg(F.count(F.lit(1)).alias("n"))
        s = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct"))
    dup = F.col("total") - F.col("distinct")
    return _one_row(
        s, table, f"uniqueness_{c}", "uniqueness", _fail_if(dup > 0), F.col("total"), dup,
        F.format_string("Column '%s': %d distinct / %d total (%d duplicates)",
                        F.lit(c), F.col("distinct"), F.col("total"), dup), sev)


def check_referential_integrity(df: DataFrame, cfg: dict, table: str, ref: DataFrame,
                                index: DataFrame | None = None) -> DataFrame:
    """Distinct foreign-key values missing from the referenced column.

    A NULL key never matches and counts as an orphan. Both sides are reduced
    to their distinct values before the anti-join shuffles them; an ``index`` of the
    referenced column is distinct as it is.
    """
    c, rc = cfg["column"], cfg["reference_column"]
    rt, sev = cfg["reference_table"], cfg.get("severity", DEFAULT_SEVERITY["referential_integrity"])
    keys = df.select(F.col(c).alias("_k")).distinct()
    refs = ref.select(F.col(rc).alias("_k")).distinct() if index is None else index.toDF("_k")
    orphans = keys.join(refs, "_k", "left_anti")
    s = keys.agg(F.count(F.lit(1)).alias("total")).select(
        "total", orphans.agg(F.count(F.lit(1))).scalar().alias("orphans"))
    return _one_row(
        s, table, f"ref_integrity_{c}_to_{rt}.{rc}", "referential_integrity",
        _fail_if(F.col("orphans") > 0), F.col("total"), F.col("orphans"),
        F.format_string("Column '%s': %d values not found in %s.%s", F.lit(c), F.col("orphans"),
                        F.lit(rt), F.lit(rc)), sev)


SALTS = 64


def _with_group_moments(vals: DataFrame, stats: DataFrame, groups: list[str]) -> DataFrame:
    """Values with their group's moments: no group's rows ever meet in one task."""
    small = stats.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], "_mean", "_sd")
    same = [F.col(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(groups)]
    if fits(small, DEFAULT_BROADCAST_ROWS):
        return vals.join(F.broadcast(small), reduce(and_, same), "inner")
    salted = vals.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, reduce(and_, same, F.col("_salt") == F.col("_copy")), "inner")


def check_statistical_outlier(df: DataFrame, cfg: dict, table: str) -> DataFrame:
    """Non-NULL values outside mean +- n * sample stddev; WARN, never FAIL.

    The moments are one aggregate, used by the counting pass as a scalar
    sub-query (evaluated once, no join, nothing on the driver). With
    ``group_by`` the moments are per group (a NULL group is one too), joined
    back by broadcast while they are proven small, else on a salted group key.
    """
    c, n = cfg["column"], float(cfg.get("n_stddev", 3))
    sev = cfg.get("severity", DEFAULT_SEVERITY["statistical_outlier"])
    groups = cfg.get("group_by")
    _need(df, c, NumericType)
    x = F.col(c).cast("double")
    vals = df.filter(F.col(c).isNotNull())
    if groups:
        groups = [groups] if isinstance(groups, str) else list(groups)
        stats = vals.groupBy(*groups).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd"))
        j = _with_group_moments(vals.select(*groups, x.alias("_x")), stats, groups)
        x, sd = F.col("_x"), F.col("_sd")
        outside = sd.isNotNull() & (sd != 0) & (
            (x < F.col("_mean") - F.lit(n) * sd) | (x > F.col("_mean") + F.lit(n) * sd))
        s = j.agg(F.count(F.lit(1)).alias("total"), F.count_if(outside).alias("outliers"))
        details = F.format_string("Column '%s' per %s: %d outliers", F.lit(c), F.lit(",".join(groups)),
                                  F.col("outliers"))
        name = f"outlier_{c}_by_{'_'.join(groups)}"
    else:
        moments = vals.agg(F.struct(F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")))
        m = moments.scalar()
        mean, sd = m.getField("mean"), F.coalesce(m.getField("sd"), F.lit(0.0))
        lower, upper = mean - F.lit(n) * sd, mean + F.lit(n) * sd
        outside = (sd != 0) & ((x < lower) | (x > upper))
        s = vals.agg(F.count(F.lit(1)).alias("total"), F.count_if(outside).alias("outliers"))
        details = F.when(F.col("total") == 0, F.format_string("Column '%s': no data to check", F.lit(c))) \
            .when(sd == 0, F.format_string("Column '%s': stddev is 0, no outliers possible", F.lit(c))) \
            .otherwise(F.format_string("Column '%s': %d outliers outside [%.2f, %.2f] (mean=%.2f, sd=%.2f)",
                                       F.lit(c), F.col("outliers"), lower, upper, mean, sd))
        name = f"outlier_{c}"
    return _one_row(s, table, name, "statistical_outlier", _fail_if(F.col("outliers") > 0, "WARN"),
                    F.col("total"), F.col("outliers"), details, sev)


# ---------------------------------------------------------------------------
# table runner and suite
# ---------------------------------------------------------------------------


def _error_row(df: DataFrame, table: str, cfg: dict, err: Exception) -> DataFrame:
    ctype = cfg.get("check", "unknown")
    sev = cfg.get("severity", "critical")
    spark = df.sparkSession
    row = spark.range(1).select(F.inline(F.array(_result(
        table, f"{ctype}_error", ctype, F.lit("FAIL"), F.lit(0), F.lit(0),
        F.lit(f"Check failed with error: {type(err).__name__}: {err}"[:2000]), sev))))
    return row


FUSED = ("not_null", "accepted_values", "range_check", "freshness", "row_count")


def _planned(df: DataFrame, table: str, checks: list[dict], refs: dict[str, DataFrame], as_of: _dt.datetime | None,
             indexes: dict[tuple[str, str], DataFrame], outlier=None) -> tuple[_Plan, list[DataFrame]]:
    """The fused plan of the checks that have one, and the results of the others."""
    plan = _Plan()
    separate: list[DataFrame] = []
    for cfg in checks:
        ctype = cfg.get("check")
        sev = cfg.get("severity", DEFAULT_SEVERITY.get(ctype, "critical"))
        try:
            # analyse what the check refers to first, so a bad name or type fails this check only
            cols = [cfg[k] for k in ("column",) if k in cfg] + list(cfg.get("columns", []))
            if cols:
                df.select(*[F.col(x) for x in cols]).schema
            own = _Plan()
            if ctype == "not_null":
                _plan_not_null(own, df, cfg, table, sev)
            elif ctype == "accepted_values":
                _plan_accepted_values(own, df, cfg, table, sev)
            elif ctype == "range_check":
                _plan_range(own, df, cfg, table, sev)
            elif ctype == "freshness":
                _plan_freshness(own, df, cfg, table, sev, as_of)
            elif ctype == "row_count":
                _plan_row_count(own, df, cfg, table, sev)
            if own.results:
                df.agg(*own.aggs.values()).select(F.inline(F.array(*own.results))).schema
                plan.take(own)
            elif ctype in FUSED:
                continue
            elif ctype == "uniqueness":
                separate.append(check_uniqueness(df, cfg, table, indexes.get((table, cfg["column"]))))
            elif ctype == "referential_integrity":
                ref = refs.get(cfg["reference_table"])
                if ref is None:
                    raise KeyError(f"reference table {cfg['reference_table']} not given")
                separate.append(check_referential_integrity(
                    df, cfg, table, ref, indexes.get((cfg["reference_table"], cfg["reference_column"]))))
            elif ctype == "statistical_outlier" and outlier is not None and not cfg.get("group_by"):
                outlier(cfg)
            elif ctype == "statistical_outlier":
                separate.append(check_statistical_outlier(df, cfg, table))
            else:
                log.warning("unknown check type %r on %s: skipped", ctype, table)
        except Exception as err:  # noqa: BLE001 - isolation per check, as configured
            separate.append(_error_row(df, table, cfg, err))
    return plan, separate


def _all_rows(spark, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], _empty_schema())
    return reduce(DataFrame.unionByName, parts).select(*CHECK_RESULT_COLUMNS)


def run_table_checks(df: DataFrame, table: str, checks: list[dict], *,
                     refs: dict[str, DataFrame] | None = None,
                     as_of: _dt.datetime | None = None,
                     indexes: dict[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """All checks of one table as one DataFrame of results (schema CHECK_RESULT_COLUMNS).

    A check whose plan cannot be built (unknown column, missing reference
    table, ...) yields a FAIL row ``<check>_error`` with its severity; an
    unknown check type is logged and skipped. ``indexes`` gives, for a (table,
    column), a table that holds each of its values once (a key index): uniqueness
    then compares two counts, and a referenced column isn't reduced again.
    """
    plan, separate = _planned(df, table, checks, refs or {}, as_of, indexes or {})
    fused = [df.agg(*plan.aggs.values()).select(F.inline(F.array(*plan.results)))] if plan.results else []
    return _all_rows(df.sparkSession, fused + separate)


def _empty_schema():
    from settlekit.schemas import CHECK_RESULT_SCHEMA

    return CHECK_RESULT_SCHEMA


def run_suite(tables: dict[str, DataFrame], catalogue: dict[str, list[dict]], *,
              only: str | None = None, as_of: _dt.datetime | None = None) -> DataFrame:
    """Checks of every catalogued table (or only one), appended.

    ``tables`` maps names to DataFrames and also serves as the reference
    tables of referential checks.
    """
    out = None
    for name, checks in catalogue.items():
        if only is not None and name != only:
            continue
        if name not in tables:
            raise KeyError(f"table {name} not given")
        part = run_table_checks(tables[name], name, checks, refs=tables, as_of=as_of)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise KeyError(f"no checks configured for {only}")
    return out


def unreadable_rows(spark, table: str, checks: list[dict], err: Exception) -> DataFrame:
    """One FAIL row per check of a table that can't be read, with the check's severity."""
    one = spark.range(1)
    out = None
    for cfg in checks:
        ctype = cfg.get("check", "unknown")
        part = _error_row(one, table, {"check": ctype, "severity": cfg.get("severity", DEFAULT_SEVERITY.get(
            ctype, "critical"))}, err)
        out = part if out is None else out.unionByName(part)
    return out.select(*CHECK_RESULT_COLUMNS)


def executed_checks(df: DataFrame, table: str, checks: list[dict], *, refs: dict[str, DataFrame] | None = None,
                    as_of: _dt.datetime | None = None, indexes: dict | None = None) -> DataFrame:
    """The results of ``run_table_checks``, computed; a check that fails while it runs costs only its own row.

    All checks run fused first. Only where that fails is each check run alone, and
    those that fail again become error rows.
    """
    def run(some):
        return stage_table(run_table_checks(df, table, some, refs=refs, as_of=as_of, indexes=indexes).coalesce(1),
                           "checks")

    try:
        return run(checks)
    except Exception as err:  # noqa: BLE001 - isolation per check
        log.warning("checks of %s fail together (%s): run one by one", table, type(err).__name__)
    parts = []
    for cfg in checks:
        try:
            parts.append(run([cfg]))
        except Exception as err:  # noqa: BLE001
            parts.append(_error_row(df, table, cfg, err).select(*CHECK_RESULT_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def run_stored_suite(spark, read, catalogue: dict[str, list[dict]], *, as_of: _dt.datetime | None = None,
                     execute: bool = False, indexes: dict | None = None) -> DataFrame:
    """The suite over stored tables; ``read(name)`` loads one.

    A table that can't be read doesn't leave the suite: each of its checks fails.
    With ``execute`` the checks are run here, isolated from each other at run time too.
    """
    tables, parts = {}, []
    needed = list(catalogue) + [c["reference_table"] for cs in catalogue.values() for c in cs if "reference_table" in c]
    for name in dict.fromkeys(needed):
        try:
            tables[name] = read(name)
        except Exception as err:  # noqa: BLE001 - reported as failing checks
            if name in catalogue:
                parts.append(unreadable_rows(spark, name, catalogue[name], err))
    found = {t: cs for t, cs in catalogue.items() if t in tables}
    if found and execute:
        parts += [executed_checks(tables[t], t, cs, refs=tables, as_of=as_of, indexes=indexes) for t, cs in found.items()]
    elif found:
        parts.append(run_suite(tables, found, as_of=as_of))
    return reduce(DataFrame.unionByName, parts)


def with_check_timestamp(results: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Quality-log rows: one timestamp shared by the whole run."""
    ts = _ts_lit(run_ts) if run_ts is not None else F.current_timestamp()
    return results.select(ts.alias("check_timestamp"), *CHECK_RESULT_COLUMNS)


def gate(results: DataFrame) -> dict:
    """Counts per status; raises ``QualityGateError`` on a critical failure.

    One small aggregate over the (few) result rows.
    """
    row = results.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if((F.col("status") == "FAIL") & (F.col("severity") == "critical")).alias("critical"),
    ).first()
    summary = row.asDict()
    if summary["critical"]:
        raise QualityGateError(f"{summary['critical']} critical quality check(s) failed: {summary}")
    return summary


def stale_data_guard(events: DataFrame, column: str = "event_timestamp", max_age_hours: float = 6,
                     as_of: _dt.datetime | None = None) -> None:
    """Stop the pipeline when the newest event is missing or too old."""
    res = run_table_checks(events, "raw.payment_events",
                           [{"check": "freshness", "column": column, "max_age_hours": max_age_hours,
                             "severity": "critical"}], as_of=as_of).first()
    if res["status"] != "PASS":
        raise ValueError(f"stale input: {res['details']}")
