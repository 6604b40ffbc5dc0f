"""Data-quality operators Q1-Q14, run as Spark jobs.

Checks are plain Python data (``Check``); ``quality_report`` evaluates all
checks of one table with

* one global aggregate for every row-level metric (row count, missing
  counts, invalid range/value counts, minimum) and for every relationship whose
  parent keys may be broadcast -- a single scan, partial aggregation per task,
  one tiny exchange;
* one aggregate over grouping sets for all uniqueness keys and all other
  relationships: one scan, expanded to a row per key set, counted per key with
  map-side combine (a hot key costs one partial row per task).

So a table is scanned twice at most, however many checks it has. The result is a DataFrame ``(layer, dataset, check, column, measured, outcome)``
with one row per check. Nothing is collected except by the gate.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.functions.sqltext import ident, in_list, literal
from atlaspanel.operators.joins import DIMENSION_BROADCAST_MAX_BYTES, estimated_bytes

REPORT_COLUMNS = ["layer", "dataset", "check", "column", "measured", "outcome"]

# Grading modes.
ZERO = "zero"  # pass iff measured == 0 (model tests, "= 0" scan checks)
POSITIVE = "positive"  # pass iff measured > 0 (row_count > 0)
THRESHOLD = "threshold"  # warn when > warn_above, fail when >= fail_at
AT_LEAST = "at_least"  # pass iff measured >= bound (min(year) >= 2000)


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique, accepted_values, relationships, unique_combination,
    #            row_count, missing_count, duplicate_count, invalid_range,
    #            invalid_values, min, required_columns
    columns: tuple = ()
    values: tuple = ()  # accepted / valid values
    lo: float | None = None  # valid min
    hi: float | None = None  # valid max
    bound: float | None = None  # for AT_LEAST
    parent: str | None = None  # relationships: parent dataset name
    parent_column: str | None = None
    grade: str = ZERO
    warn_above: float = D.WARN_ABOVE
    fail_at: float = D.FAIL_AT

    @property
    def name(self) -> str:
        return self.kind

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)


# --- single-check metric expressions (usable on their own) --------------------
# Metrics and grades are SQL expression text (``functions.sqltext``): a suite
# has a hundred checks, and text costs one JVM parse per expression instead of
# one round trip per function call; the plan is the same.


def null_count_sql(col: str) -> str:
    """Q1/Q7: rows where ``col`` IS NULL."""
    return f"CAST(sum(CASE WHEN {ident(col)} IS NULL THEN 1 ELSE 0 END) AS DOUBLE)"


def invalid_range_count_sql(col: str, lo=None, hi=None) -> str:
    """Q9: non-NULL values outside [lo, hi] (either side optional); NULL is missing, not invalid."""
    c = ident(col)
    bad = []
    if lo is not None:
        bad.append(f"{c} < {literal(lo)}")
    if hi is not None:
        bad.append(f"{c} > {literal(hi)}")
    cond = " OR ".join(bad) or "FALSE"
    return f"CAST(sum(CASE WHEN {c} IS NOT NULL AND ({cond}) THEN 1 ELSE 0 END) AS DOUBLE)"


def invalid_values_count_sql(col: str, values) -> str:
    """Q3/Q10: non-NULL values outside the list."""
    c = ident(col)
    return f"CAST(sum(CASE WHEN {c} IS NOT NULL AND NOT {c} IN {in_list(values)} THEN 1 ELSE 0 END) AS DOUBLE)"


def grade_sql(measured: str, check: Check) -> str:
    """Q13: outcome of a measured value; fail wins over warn."""
    if check.grade == THRESHOLD:
        return (
            f"CASE WHEN {measured} >= {literal(check.fail_at)} THEN 'fail' "
            f"WHEN {measured} > {literal(check.warn_above)} THEN 'warn' ELSE 'pass' END"
        )
    if check.grade == POSITIVE:
        return f"CASE WHEN {measured} > 0 THEN 'pass' ELSE 'fail' END"
    if check.grade == AT_LEAST:
        return f"CASE WHEN {measured} >= {literal(check.bound)} THEN 'pass' ELSE 'fail' END"
    return f"CASE WHEN {measured} = 0 THEN 'pass' ELSE 'fail' END"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2/Q5/Q8 rows: key values (all parts non-NULL) that occur more than once."""
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(cond).groupBy(*keys).count().filter(F.col("count") > 1)


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str, alias: str) -> DataFrame:
    """Q4 metric: number of non-NULL child rows with no parent, as one row.

    A parent key set under the broadcast bound is joined map-side (no shuffle
    of the child). Beyond it the child is first counted per key -- partial
    aggregation, so a key holding a third of all rows ships one partial row
    per task -- and only the distinct keys meet the parent in the shuffle.
    """
    keys = parent.select(F.col(parent_column).alias("__parent_key")).distinct()
    present = child.filter(F.col(column).isNotNull())
    if estimated_bytes(keys) <= DIMENSION_BROADCAST_MAX_BYTES:
        lonely = present.join(F.broadcast(keys), F.col(column) == F.col("__parent_key"), "left_anti")
        return lonely.agg(F.count(F.lit(1)).cast("double").alias(alias))
    per_key = present.groupBy(F.col(column).alias("__child_key")).agg(F.count(F.lit(1)).alias("__rows"))
    lonely = per_key.join(keys, F.col("__child_key") == F.col("__parent_key"), "left_anti")
    return lonely.agg(F.coalesce(F.sum("__rows"), F.lit(0)).cast("double").alias(alias))


# --- report ------------------------------------------------------------------

_AGG_KINDS = {"required_columns", "not_null", "missing_count", "row_count", "invalid_range", "invalid_values", "accepted_values", "min"}


def _metric(check: Check, df: DataFrame) -> str:
    k = check.kind
    if k == "required_columns":  # Q12: read from the table it reports on, next to its other aggregates
        missing = sum(c not in df.columns for c in check.columns)
        return f"CAST(CASE WHEN count(1) >= 0 THEN {missing} END AS DOUBLE)"
    if k in ("not_null", "missing_count"):
        return null_count_sql(check.columns[0])
    if k == "row_count":
        return "CAST(count(1) AS DOUBLE)"
    if k == "invalid_range":
        return invalid_range_count_sql(check.columns[0], check.lo, check.hi)
    if k in ("invalid_values", "accepted_values"):
        return invalid_values_count_sql(check.columns[0], check.values)
    if k == "min":
        return f"CAST(min({ident(check.columns[0])}) AS DOUBLE)"
    raise ValueError(k)


def _rows(df_one_row: DataFrame, checks: list[tuple[Check, str]], layer: str, dataset: str) -> DataFrame:
    """Unpivot a one-row metrics frame into report rows (no driver round trip)."""
    structs = []
    for chk, alias in checks:
        m = f"CAST({ident(alias)} AS DOUBLE)"
        structs.append(
            f"named_struct('layer', {literal(layer)}, 'dataset', {literal(dataset)}, "
            f"'check', {literal(chk.name)}, 'column', {literal(chk.column_label)}, "
            f"'measured', {m}, 'outcome', {grade_sql(m, chk)})"
        )
    return df_one_row.selectExpr(f"inline(array({', '.join(structs)}))")


_KEYED_KINDS = {"unique", "unique_combination", "duplicate_count"}


def _parent_keys(check: Check, parents: dict[str, DataFrame], alias: str) -> DataFrame:
    keys = parents[check.parent].select(F.col(check.parent_column).alias(alias))
    return keys.filter(F.col(alias).isNotNull()).distinct()


def _counts_by_key(df: DataFrame, sets: list[tuple]) -> tuple[DataFrame, dict[tuple, int]]:
    """Rows per key of every key set, from one scan: (key columns, ``__set``, ``__n``) and the number of each set."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    if len(sets) == 1:
        return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"), F.lit(0).cast("long").alias("__set")), {sets[0]: 0}
    # Spark numbers a set by the columns it leaves out, the first column highest
    number = {s: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets}
    grouped = df.select(*columns).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    return grouped.agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().cast("long").alias("__set")), number


def quality_report(
    df: DataFrame,
    checks: list[Check],
    dataset: str,
    layer: str = "raw",
    parents: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Q14: every check of one table -> report rows (one row per check)."""
    parents = parents or {}
    parts: list[DataFrame] = []
    named = [(c, f"m{i}") for i, c in enumerate(checks)]
    related = {a: _parent_keys(c, parents, f"__p_{a}") for c, a in named if c.kind == "relationships"}
    small = {a for a, keys in related.items() if estimated_bytes(keys) <= DIMENSION_BROADCAST_MAX_BYTES}

    in_scan = [(c, a) for c, a in named if c.kind in _AGG_KINDS or a in small]
    if in_scan:
        rows, metrics = df, []
        for c, a in in_scan:
            if a in small:  # a parent key occurs once, so the join keeps the rows as they are
                rows = rows.join(F.broadcast(related[a]), F.col(c.columns[0]) == F.col(f"__p_{a}"), "left")
                lonely = f"{ident(c.columns[0])} IS NOT NULL AND {ident(f'__p_{a}')} IS NULL"
                metrics.append(f"CAST(coalesce(sum(CASE WHEN {lonely} THEN 1 ELSE 0 END), 0) AS DOUBLE) AS {a}")
            else:
                metrics.append(f"{_metric(c, df)} AS {a}")
        parts.append(_rows(rows.selectExpr(*metrics), in_scan, layer, dataset))

    by_key = [(c, a) for c, a in named if c.kind in _KEYED_KINDS or a in related and a not in small]
    if by_key:
        counts, number = _counts_by_key(df, list(dict.fromkeys(tuple(sorted(set(c.columns))) for c, _ in by_key)))
        metrics = []
        for c, a in by_key:
            mine = f"`__set` = {number[tuple(sorted(set(c.columns)))]}"
            present = " AND ".join(f"{ident(k)} IS NOT NULL" for k in c.columns)
            if c.kind in _KEYED_KINDS:
                metrics.append(f"CAST(coalesce(sum(CASE WHEN {mine} AND {present} AND `__n` > 1 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS {a}")
            else:  # the distinct keys meet the parent's, a key's rows count if it has none
                counts = counts.join(related[a], (F.col("__set") == number[tuple(c.columns)]) & (F.col(c.columns[0]) == F.col(f"__p_{a}")), "left")
                metrics.append(f"CAST(coalesce(sum(CASE WHEN {mine} AND {present} AND {ident(f'__p_{a}')} IS NULL THEN `__n` ELSE 0 END), 0) AS DOUBLE) AS {a}")
        parts.append(_rows(counts.selectExpr(*metrics), by_key, layer, dataset))

    if not parts:
        raise ValueError("no checks given")
    return reduce(lambda a, b: a.unionByName(b), parts)


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Raise when any check failed (the report itself is tiny: one row per check)."""
    failed = report.filter(F.col("outcome") == "fail").select("dataset", "check", "column", "measured")
    bad = failed.collect()
    if bad:
        lines = ", ".join(f"{r.dataset}.{r.check}({r.column})={r.measured}" for r in bad)
        raise QualityGateError(f"quality checks failed: {lines}")
    return report
