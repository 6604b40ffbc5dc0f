"""Analyst operators: filters/expressions P5-P8, star join J6, aggregates
G3-G8, ordering O1-O2 and the end-to-end questions A1-A5.

Conventions that keep results engine-independent: NULLs sort last in both
directions (T10), every ``limit`` has a unique tie-break, membership flags are
0/1 integers compared with ``= 1`` (T9). Averages and correlations are
returned as computed; a comparison that needs fixed places rounds them itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlaspanel.functions.exprs import case_non_null, null_safe_order, scale_value
from atlaspanel.operators.joins import bounded_broadcast


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- P5-P8 ------------------------------------------------------------------


def not_null_filter(df: DataFrame, *cols) -> DataFrame:
    """P5: rows where every listed column IS NOT NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull()
    return df.filter(cond)


def compare_filter(df: DataFrame, col, op: str, value) -> DataFrame:
    """``col <op> literal`` with op in =, <>, <, <=, >, >=."""
    c, v = _c(col), F.lit(value)
    ops = {"=": c == v, "<>": c != v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}
    return df.filter(ops[op])


def scale_column(df: DataFrame, col: str, divisor: float, alias: str) -> DataFrame:
    """Add ``col / divisor`` as ``alias``."""
    return df.withColumn(alias, scale_value(col, divisor))


def case_non_null_column(df: DataFrame, test: str, value: str, alias: str) -> DataFrame:
    """Add ``CASE WHEN test IS NOT NULL THEN value END`` as ``alias``."""
    return df.withColumn(alias, case_non_null(test, value))


# --- J6 ---------------------------------------------------------------------


def fact_inner_dim(fact: DataFrame, dim: DataFrame, dim_columns: list[str]) -> DataFrame:
    """Fact JOIN dimension on country_code (dimension broadcast when checked small)."""
    d = dim.select(F.col("country_code").alias("__d_code"), *dim_columns)
    return fact.join(bounded_broadcast(d, bounded_by=dim), F.col("country_code") == F.col("__d_code"), "inner").drop(
        "__d_code"
    )


# --- G3-G8 ------------------------------------------------------------------


def sum_flags(dim: DataFrame, flags: list[str], suffix: str = "_members") -> DataFrame:
    """``SUM(flag)`` per membership flag (as bigint)."""
    return dim.agg(*[F.sum(F.col(f).cast("bigint")).alias(f"{f}{suffix}") for f in flags])


def group_avg(df: DataFrame, group: list[str], cols: dict[str, str]) -> DataFrame:
    """``AVG`` per group (NULLs ignored); ``cols`` maps alias -> column."""
    return df.groupBy(*group).agg(*[F.avg(c).alias(a) for a, c in cols.items()])


#: Entries of a dictionary whose codes are counted as bits (64 to a long); a longer one is an error.
MAX_CODES = 1024
_CODE, _VALUE = "__code", "__value"


def code_dictionary(dim: DataFrame, col: str) -> DataFrame:
    """(``__value``, ``__code`` from 0) of a dimension's distinct values; the dimension is small by the broadcast check."""
    values = dim.select(F.col(col).alias(_VALUE)).filter(F.col(_VALUE).isNotNull()).distinct()
    return values.withColumn(_CODE, F.row_number().over(Window.orderBy(_VALUE)) - 1)


def distinct_bits(code, codes: int = MAX_CODES):
    """Exact number of distinct codes as an aggregate: one OR-ed long per 64 codes.

    The longs merge like sums, so the count takes one hash aggregate and one
    exchange, where ``COUNT(DISTINCT)`` deals the rows by value first.
    """
    bit = F.lit(1).cast("long")
    checked = F.when(code >= codes, F.raise_error(F.lit(f"a dictionary of more than {codes} entries"))).otherwise(code)
    total = F.lit(0).cast("long")
    for i in range(-(-codes // 64)):
        word = F.when(F.floor(checked / 64) == i, F.call_function("shiftleft", bit, F.pmod(code, F.lit(64)).cast("int")))
        total = total + F.coalesce(F.bit_count(F.bit_or(word)), F.lit(0))
    return total


def count_distinct(df: DataFrame, group: list[str], col: str, alias: str, dictionary: DataFrame | None = None, codes: int = MAX_CODES) -> DataFrame:
    """Exact ``COUNT(DISTINCT col)`` per group.

    ``dictionary`` (``code_dictionary``): the values' codes, counted as bits in
    one exchange; a value that it lacks is an error.
    """
    if dictionary is None:
        return df.groupBy(*group).agg(F.count_distinct(F.col(col)).alias(alias))
    coded = df.join(F.broadcast(dictionary), F.col(col) == F.col(_VALUE), "left")
    lacking = F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col(col).cast("string")))
    code = F.when(F.col(col).isNotNull(), F.coalesce(F.col(_CODE), lacking.cast("int")))
    return coded.groupBy(*group).agg(distinct_bits(code, codes).alias(alias))


def scalar_max_filter(df: DataFrame, col: str) -> DataFrame:
    """``WHERE col = (SELECT MAX(col) FROM df)`` -- an uncorrelated scalar
    subquery, evaluated once by Spark (no driver round trip, no join)."""
    return df.filter(F.col(col) == df.select(F.max(col)).scalar())


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """``COUNT(*)``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def min_measure(df: DataFrame, col: str, alias: str) -> DataFrame:
    """``MIN(col)``."""
    return df.agg(F.min(col).alias(alias))


# --- O1-O2 ------------------------------------------------------------------


def order_by(df: DataFrame, cols: list[tuple[str, bool]]) -> DataFrame:
    """O1: sort by (column, descending) pairs, NULLs last both ways."""
    return df.orderBy(*[null_safe_order(c, d) for c, d in cols])


def top_n(df: DataFrame, col: str, n: int, tiebreak: list[str], descending: bool = True) -> DataFrame:
    """O2: ``ORDER BY col DESC LIMIT n`` with a unique tie-break (TakeOrderedAndProject:
    each task keeps its own top n, the driver merges n x tasks rows)."""
    return df.orderBy(null_safe_order(col, descending), *[F.col(t).asc_nulls_last() for t in tiebreak]).limit(n)


# --- A1-A5 ------------------------------------------------------------------
# The output column names of A1-A4, which published queries use.


def top_economies(
    fact: DataFrame,
    year: int,
    gdp: str,
    gdp_per_capita: str,
    hdi: str,
    n: int = 10,
    divisor: float = 1e12,
) -> DataFrame:
    """A1: top ``n`` countries by GDP in one year, GDP scaled to trillions."""
    rows = not_null_filter(compare_filter(fact, "year", "=", year), gdp)
    top = top_n(rows, gdp, n, ["country_code"])
    return top.select(
        "country_name",
        "year",
        scale_value(gdp, divisor).alias("gdp_trillions_usd"),
        F.col(gdp_per_capita).alias("gdp_per_capita_ppp"),
        F.col(hdi).alias("hdi"),
    )


def member_trend(
    fact: DataFrame, dim: DataFrame, flag: str, since: int, hdi: str, gdp_per_capita: str
) -> DataFrame:
    """A2: HDI trend of the members of one group since a year."""
    j = fact_inner_dim(fact.select("country_code", "country_name", "year", hdi, gdp_per_capita), dim, [flag])
    j = not_null_filter(j.filter((F.col(flag) == 1) & (F.col("year") >= since)), hdi)
    return order_by(
        j.select(
            "country_name", "year", F.col(hdi).alias("hdi"), F.col(gdp_per_capita).alias("gdp_per_capita")
        ),
        [("country_name", False), ("year", False)],
    )


def inequality_by_continent(fact: DataFrame, dim: DataFrame, gini: str, inequality: str) -> DataFrame:
    """A3: averages and distinct-country count per continent in the latest fact year.

    May be empty when the latest year has no value of ``gini``. One pass over
    the fact: it is aggregated per (continent, year), and the latest year is
    picked from that small result (continents x years rows).
    """
    rows = fact.select("country_code", "year", gini, inequality)
    d = dim.select(F.col("country_code").alias("__d_code"), "continent", (F.dense_rank().over(Window.orderBy("country_code")) - 1).alias(_CODE))
    j = rows.join(bounded_broadcast(d, bounded_by=dim), F.col("country_code") == F.col("__d_code"), "left")
    rated = F.col(gini).isNotNull() & F.col("__d_code").isNotNull()
    per_year = j.groupBy("continent", "year").agg(
        F.avg(F.when(rated, F.col(gini))).alias("avg_gini"),
        F.avg(F.when(rated, F.col(inequality))).alias("avg_inequality_coef"),
        distinct_bits(F.when(rated, F.col(_CODE))).alias("country_count"),
    )
    latest = F.max("year").over(Window.partitionBy())  # over continents x years rows
    out = per_year.withColumn("latest", latest).filter((F.col("year") == F.col("latest")) & (F.col("country_count") > 0))
    return order_by(out.select("continent", "avg_gini", "avg_inequality_coef", "country_count"), [("avg_gini", True)])


def schooling_gdp_listing(
    fact: DataFrame, year: int, schooling: str, gdp_per_capita: str, hdi: str, n: int = 20
) -> DataFrame:
    """A4: top ``n`` by schooling among rows that have both measures."""
    rows = not_null_filter(compare_filter(fact, "year", "=", year), schooling, gdp_per_capita)
    top = top_n(rows, schooling, n, ["country_code"])
    return top.select(
        "country_name",
        "year",
        F.col(schooling).alias("education_years"),
        F.col(gdp_per_capita).alias("gdp_per_capita"),
        F.col(hdi).alias("hdi"),
    )


def measure_correlation(fact: DataFrame, a: str, b: str) -> DataFrame:
    """A5 (ours, what A4's title promises): Pearson correlation over rows with both values."""
    rows = not_null_filter(fact, a, b)
    return rows.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.corr(a, b).alias("correlation"),
    )
