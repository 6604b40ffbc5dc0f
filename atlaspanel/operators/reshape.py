"""Reshape operators R1-R6: long <-> wide, chunk concat, label mapping, fixed schema."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaspanel.functions.exprs import valid_number
from atlaspanel.functions.sqltext import ident


def year_columns(df: DataFrame) -> list[str]:
    """Columns whose name is a year (all digits), in frame order."""
    return [c for c in df.columns if c.isdigit()]


def unpivot_years(
    df: DataFrame,
    id_columns: list[str],
    years: list[str] | None = None,
    year_col: str = "year",
    value_col: str = "value",
) -> DataFrame:
    """One column per year -> one row per (ids, year); NULL values are kept.

    A narrow transformation (Expand), no shuffle.
    """
    years = years if years is not None else year_columns(df)
    if not years:
        raise ValueError("no year-named columns to unpivot")
    # numeric year columns unpivot as double; text payloads stay text so that
    # validation (V5) can reject non-numbers instead of a cast failing
    numeric = all(t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal")
                  for c, t in df.dtypes if c in years)
    vtype = "double" if numeric else "string"
    typed = df.select(*id_columns, *[F.col(f"`{y}`").cast(vtype).alias(y) for y in years])
    long = typed.unpivot(id_columns, years, year_col, value_col)
    return long.withColumn(year_col, F.col(year_col).cast("int"))


def pivot_indicators(
    points: DataFrame,
    keys: list[str],
    codes: list[str],
    indicator_col: str = "indicator",
    value_col: str = "value",
    order_col: str = "ingest_seq",
    order_unique: bool = True,
) -> DataFrame:
    """R2: long points -> one row per key, one column per code (pandas ``first``).

    Semantics (T5): NULL and NaN values are dropped first, so a key with no
    value at all disappears; each cell is the value with the smallest
    ``order_col`` (deterministic, unlike ``first`` after a shuffle). Rows whose
    indicator is not in ``codes`` still make their key exist (with NULL cells),
    as an unknown label does before the fixed schema is applied.

    Plan (Spark's pivot with an explicit value list, no extra distinct job):
    phase 1 aggregates every point once into its (keys, indicator) cell with
    ``min_by`` -- partial aggregation before the shuffle, so a hot key ships
    one partial row per map task; phase 2 pivots the (much smaller) cell set
    on ``keys``. Work is O(points), not O(points x indicators) as a
    conditional aggregate per indicator would be.

    ``order_unique=False`` makes ties on the order key deterministic: equal
    order keys of one cell first collapse to their smallest value (one more
    hash aggregate, with map-side combine). The order key stays a primitive
    type so both aggregates remain hash aggregates (a struct key would force
    sort-based aggregation).
    """
    pts = points.filter(valid_number(value_col))
    if not order_unique:
        pts = pts.groupBy(*keys, indicator_col, order_col).agg(F.min(value_col).alias(value_col))
    return (
        pts.groupBy(*keys)
        .pivot(indicator_col, list(codes))
        .agg(F.min_by(F.col(value_col), F.col(order_col)))
    )


def concat_chunks(frames: list[DataFrame]) -> DataFrame:
    """Row-concatenate frames whose columns differ (missing -> NULL)."""
    if not frames:
        raise ValueError("concat_chunks needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def label_to_code(col, mapping: dict[str, str], known_codes: list[str]) -> Column:
    """R4 as an expression: label -> code via a literal map; a known code maps to itself."""
    c = F.col(col) if isinstance(col, str) else col
    if mapping:
        lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
        by_label = F.try_element_at(lookup, c)
    else:
        by_label = F.lit(None).cast("string")
    by_code = F.when(c.isin(list(known_codes)), c) if known_codes else F.lit(None).cast("string")
    return F.coalesce(by_label, by_code)


def map_labels_to_codes(
    df: DataFrame,
    mapping: dict[str, str],
    known_codes: list[str],
    label_col: str = "indicator",
    out_col: str = "indicator",
    keep_label_as: str | None = None,
) -> DataFrame:
    """Replace descriptive labels by indicator codes (NULL when unknown).

    The dictionary is configuration (tens of entries), so it travels inside
    the plan as a literal map: no join, no shuffle.
    """
    out = df
    if keep_label_as:
        out = out.withColumn(keep_label_as, F.col(label_col))
    return out.withColumn(out_col, label_to_code(label_col, mapping, known_codes))


def unmapped_indicators(
    df: DataFrame, mapping: dict[str, str], known_codes: list[str], label_col: str = "indicator"
) -> DataFrame:
    """Labels with no dictionary entry and how many points carry each."""
    code = label_to_code(label_col, mapping, known_codes)
    return (
        df.filter(code.isNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).alias("label"))
        .agg(F.count(F.lit(1)).alias("points"))
    )


def conform_columns(df: DataFrame, keys: list[str], columns: list[str], dtype: str = "double") -> DataFrame:
    """Fixed output schema -- keys then ``columns`` in order; absent -> typed NULL, extras dropped.

    One ``selectExpr`` (the list is as wide as the dictionary)."""
    present = set(df.columns)
    out = [ident(k) for k in keys]
    for c in columns:
        src = ident(c) if c in present else "NULL"
        out.append(f"CAST({src} AS {dtype}) AS {ident(c)}")
    return df.selectExpr(*out)
