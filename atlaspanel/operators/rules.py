"""Validation operators V1-V12: row rules -> valid rows and explained rejects.

Each rule is a column expression that yields an error code (string) or NULL.
``split_valid_rejects`` gathers the non-NULL codes of all rules into an
``errors`` array, so every row is checked by every rule in one projection
(no Python UDF, no lambda, no per-row objects) and a reject explains *all*
its faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaspanel import dictionary as D


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- rules (error code or NULL) -------------------------------------------


def check_code_length(col, lo: int = D.CODE_MIN_LENGTH, hi: int = D.CODE_MAX_LENGTH) -> Column:
    """V1: code length within [lo, hi] (a NULL code is V4's business)."""
    c = _c(col)
    return F.when(c.isNotNull() & ~F.length(c).between(lo, hi), F.lit("code_length"))


def check_year_range(col, lo: int | None, hi: int | None) -> Column:
    """V2: inclusive bounds; ``hi`` is a parameter (no wall clock inside operators)."""
    y = _c(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (y < F.lit(lo))
    if hi is not None:
        bad = bad | (y > F.lit(hi))
    return F.when(y.isNotNull() & bad, F.lit("year_range"))


def coerce_year_text(col) -> Column:
    """V3 value: int-or-text year -> int; unparsable text -> NULL."""
    return _c(col).try_cast("int")


def check_year_text(col) -> Column:
    """V3 rule: present year text that does not parse as an integer."""
    c = _c(col)
    return F.when(c.isNotNull() & c.try_cast("int").isNull(), F.lit("year_text"))


def check_required(*cols) -> Column:
    """V4: required non-NULL fields -> ``missing_<col>`` for the first missing one."""
    out = None
    for col in cols:
        name = col if isinstance(col, str) else str(col)
        e = F.when(_c(col).isNull(), F.lit(f"missing_{name}"))
        out = e if out is None else F.coalesce(out, e)
    return out if out is not None else F.lit(None).cast("string")


def coerce_value(col) -> Column:
    """V5 value: optional float; missing -> NULL, NaN -> NULL, text parsed if numeric."""
    c = _c(col)
    v = c.try_cast("double")
    return F.when(~F.isnan(v), v)


def check_value_text(col) -> Column:
    """V5 rule: a present value that is not a number."""
    c = _c(col)
    return F.when(c.isNotNull() & c.try_cast("double").isNull(), F.lit("value_text"))


def reject_aggregates(col, prefix: str = D.AGGREGATE_CODE_PREFIX, marker: str = D.AGGREGATE_CODE_MARKER) -> Column:
    """V6: aggregate codes (prefix ``1C_`` or containing ``ALLC``)."""
    c = _c(col)
    return F.when(c.startswith(prefix) | c.contains(marker), F.lit("aggregate"))


# --- frame operators -------------------------------------------------------


def filter_year_window(df: DataFrame, start: int, end: int, year_col: str = "year") -> DataFrame:
    """V7: half-open window ``start <= year < end`` (T2); pushes down to the scan."""
    y = F.col(year_col)
    return df.filter((y >= F.lit(start)) & (y < F.lit(end)))


def drop_null_values(df: DataFrame, value_col: str = "value") -> DataFrame:
    """V8: skip points without a value."""
    return df.filter(F.col(value_col).isNotNull())


def first_error(rules: list[Column]) -> Column:
    """The first failing rule's code, NULL when the row passes every rule."""
    return F.coalesce(*[r.cast("string") for r in rules]) if rules else F.lit(None).cast("string")


def error_list(rules: list[Column]) -> Column:
    """All failing rules' codes as an array (empty when the row is valid).

    Built from ``concat_ws`` (skips NULLs) and ``split`` rather than a lambda
    ``filter``: higher-order functions are evaluated without codegen and would
    pull the whole scan stage out of whole-stage code generation.
    """
    if not rules:
        return F.array().cast("array<string>")
    joined = F.concat_ws(",", *[r.cast("string") for r in rules])
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))


def checked(df: DataFrame, rules: list[Column], errors_col: str = "errors") -> DataFrame:
    """V9 in one pass: every row with its ``status`` (valid or rejected) and its failing rules' codes."""
    status = F.when(first_error(rules).isNull(), F.lit("valid")).otherwise(F.lit("rejected"))
    return df.withColumns({"status": status, errors_col: error_list(rules)})


def split_valid_rejects(df: DataFrame, rules: list[Column], errors_col: str = "errors"):
    """V9: (valid, rejects). ``valid`` has the input columns; ``rejects`` adds
    ``errors`` (every failing rule's code, in rule order).

    Both halves are lazy filters over the same input; the valid side tests
    ``coalesce(rules) IS NULL``, a plain predicate that stays in codegen. A
    pipeline that writes both reads the input twice (rejects are few, so that
    is cheaper than materialising the checked points).
    """
    bad = first_error(rules)
    valid = df.filter(bad.isNull())
    rejects = df.filter(bad.isNotNull()).withColumn(errors_col, error_list(rules))
    return valid, rejects


#: Rows that one step of the expansion makes of one row at most.
EXPAND_STEP = 1 << 16


def count_rejects(rejects: DataFrame, count_col: str = "occurrences") -> DataFrame:
    """Equal rejects as one row with their number (partial counts before the shuffle)."""
    return rejects.groupBy(*rejects.columns).agg(F.count(F.lit(1)).alias(count_col))


def expand_rejects(counted: DataFrame, count_col: str = "occurrences", step: int = EXPAND_STEP) -> DataFrame:
    """Counted rejects, each as often as it occurred.

    Two bounded steps: a reject becomes one row per ``step`` occurrences, those
    rows are dealt over the tasks, and each becomes at most ``step`` rows. A
    reject that occurs 3 billion times never stands in one array or one task.
    """
    n = F.col(count_col).cast("long")
    blocks = counted.filter(n > 0).withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(CAST(`{count_col}` AS BIGINT) - 1) DIV {step}"))))
    parts = max(int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = blocks.repartition(parts, F.xxhash64("__block", *[F.col(c) for c in counted.columns]))
    rest = F.least(F.lit(step).cast("long"), n - F.col("__block") * F.lit(step))
    return dealt.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), rest))).drop("__block", "__k", count_col)


def expand_rejects_sql(table: str, columns: list[str], count_col: str = "occurrences", step: int = EXPAND_STEP) -> str:
    """``expand_rejects`` as the text of a stored view over a counted table."""
    listed = ", ".join(f"`{c}`" for c in columns)
    blocks = f"SELECT *, explode(sequence(0L, (CAST(`{count_col}` AS BIGINT) - 1) DIV {step})) AS `__block` FROM {table} WHERE `{count_col}` > 0"
    rest = f"least({step}L, CAST(`{count_col}` AS BIGINT) - `__block` * {step})"
    return f"SELECT {listed} FROM (SELECT *, explode(sequence(1L, {rest})) AS `__k` FROM ({blocks}))"


def reject_summary(rejects: DataFrame, source: str | None = None, errors_col: str = "errors", count_col: str | None = None) -> DataFrame:
    """Reject count per (source, error code); ``count_col``: how often a row occurred, if they are counted."""
    src = F.lit(source) if source is not None else F.col("source")
    number = F.col(count_col).cast("long") if count_col else F.lit(1)
    return (
        rejects.select(src.alias("source"), F.explode(errors_col).alias("error"), number.alias("__n"))
        .groupBy("source", "error")
        .agg(F.sum("__n").alias("rejects"))
    )


def reject_sample(rejects: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rejects in a deterministic key order (a log sample)."""
    return rejects.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)


def load_profile(df: DataFrame, code_col: str = "country_code", indicator_col: str = "indicator") -> DataFrame:
    """Distinct indicators, distinct countries and rows of a load (exact)."""
    return df.agg(
        F.count_distinct(F.col(indicator_col)).alias("indicators"),
        F.count_distinct(F.col(code_col)).alias("countries"),
        F.count(F.lit(1)).alias("points"),
    )


class EmptySourceError(RuntimeError):
    pass


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Fail on an empty source (T11) instead of silently continuing."""
    if df.isEmpty():
        raise EmptySourceError(f"source {name!r} has no rows")
    return df

