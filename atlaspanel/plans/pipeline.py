"""Pipeline composition L1-L3: source -> raw -> staging -> fact -> marts.

Plain function composition over lazy DataFrames; Catalyst sees each query
whole. Only ``refresh_all`` performs actions (table writes and check gates).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.operators import conform, reshape, rules, spine

CANONICAL_KEYS = ("country_code", "country_name", "year")


@dataclass(frozen=True)
class SourceConfig:
    """How one source is validated and pivoted."""

    name: str
    dictionary: tuple
    keys: tuple = CANONICAL_KEYS  # pivot index
    year_lo: int | None = None  # inclusive bounds of a valid point
    year_hi: int | None = None
    window: tuple | None = None  # half-open [start, end) extraction window
    year_is_text: bool = False  # year arrives as text (validated with try_cast)
    raw_year_text: bool = True  # for text years: keep normalised text in raw (else int)
    check_aggregates: bool = False  # reject aggregate codes (1C_..., ..ALLC..)
    required: tuple = ("indicator",)
    map_labels: bool = False  # pivot keys arrive as descriptive labels
    order_col: str = "ingest_seq"
    order_unique: bool = True  # False: ties in the order key resolve to the smallest value
    extra_rules: tuple = field(default=())
    raw_names: tuple = ()  # (canonical key, column name in the raw table) where they differ

    @property
    def codes(self) -> list[str]:
        return D.codes(self.dictionary)

    @property
    def marts(self) -> list[str]:
        return D.marts(self.dictionary)


def point_rules(cfg: SourceConfig) -> list:
    """The row rules of a source (V1-V6), as error-code expressions."""
    out = [rules.check_code_length("country_code"), rules.check_required("country_code", *cfg.required)]
    year_int = F.col("year").try_cast("int") if cfg.year_is_text else F.col("year")
    if cfg.year_is_text:
        out.append(rules.check_year_text("year"))
    else:
        out.append(rules.check_required("year"))
    out.append(rules.check_year_range(year_int, cfg.year_lo, cfg.year_hi))
    out.append(rules.check_value_text("value"))
    if cfg.check_aggregates:
        out.append(rules.reject_aggregates("country_code"))
    out.extend(cfg.extra_rules)
    return out


def outside_window(cfg: SourceConfig):
    """V7: a year that parses and lies outside the extraction window. Such points
    are skipped before validation; they are history or forecast, not faults."""
    if not cfg.window:
        return F.lit(False)
    y = F.col("year").try_cast("int") if cfg.year_is_text else F.col("year")
    return F.coalesce((y < F.lit(cfg.window[0])) | (y >= F.lit(cfg.window[1])), F.lit(False))


def validate_points(points: DataFrame, cfg: SourceConfig):
    """V7 and V9 over a source: (valid points, rejects with their error codes).

    Points outside the window are neither. Valid points get a double ``value``
    (NaN -> NULL) and, for text years, the normalised text of the parsed year.
    """
    valid, rejects = rules.split_valid_rejects(points.filter(~outside_window(cfg)), point_rules(cfg))
    valid = valid.withColumn("value", rules.coerce_value("value"))
    if cfg.year_is_text:
        as_int = F.col("year").try_cast("int")
        valid = valid.withColumn("year", as_int.cast("string") if cfg.raw_year_text else as_int)
    return valid, rejects.withColumn("source", F.lit(cfg.name))


def raw_table(valid: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Valid long points -> the raw wide table (R4 if labels, R2, R6)."""
    pts = valid
    if cfg.map_labels:
        pts = reshape.map_labels_to_codes(pts, D.label_map(cfg.dictionary), cfg.codes)
    wide = reshape.pivot_indicators(
        pts, list(cfg.keys), cfg.codes, order_col=cfg.order_col, order_unique=cfg.order_unique
    )
    return reshape.conform_columns(wide, list(cfg.keys), cfg.codes)


# --- single pass over a source for both raw outputs (used by refresh_all) ------

CELL, REJECT, EMPTY = "cell", "reject", "empty"


def checked_points(points: DataFrame, cfg: SourceConfig) -> DataFrame:
    """One scan of a source's points for the raw table *and* its rejects.

    Each point is classified once by the same rules as ``validate_points``:
    ``reject`` (with its error codes), ``cell`` (valid, inside the window,
    with a value) or ``empty`` (valid, inside the window, no value). One hash
    aggregate then reduces cells to their first value per (keys, indicator)
    -- phase 1 of the pivot, partial before the shuffle, so a hot country
    ships one partial row per task -- and rejects to one row per distinct
    reject with their number (``__n``; repeated on read), while all empties
    collapse to one marker row. Points outside the window are skipped first.

    The result is small (cells + rejects) and is meant to be written once:
    ``raw_from_checked``, ``rejects_from_checked``, ``load_report`` and
    ``has_valid_points`` read it, so the points -- the largest input -- are
    scanned once rather than once per output plus an emptiness probe.
    """
    rule_cols = point_rules(cfg)
    bad = rules.first_error(rule_cols)
    value = rules.coerce_value("value")
    if cfg.year_is_text:
        year_int = F.col("year").try_cast("int")
        year_out = year_int.cast("string") if cfg.raw_year_text else year_int
    else:
        year_out = F.col("year")
    indicator = F.col("indicator")
    if cfg.map_labels:
        indicator = reshape.label_to_code("indicator", D.label_map(cfg.dictionary), cfg.codes)
    kind = F.when(bad.isNotNull(), F.lit(REJECT)).when(value.isNotNull(), F.lit(CELL)).otherwise(F.lit(EMPTY))
    unknown = F.coalesce(~indicator.isin(cfg.codes), F.lit(True))
    cell_keys = [f"__c_{k}" for k in cfg.keys]
    reject_cols = [f"__r_{c}" for c in points.columns]
    classified = points.filter(~outside_window(cfg)).select(
        kind.alias("__kind"),
        *[F.col(k).alias(f"__k_{k}") for k in points.columns],
        year_out.alias("__year_out"),
        indicator.alias("__indicator"),
        F.when(unknown, F.col("indicator")).alias("__label"),
        value.alias("__value"),
        F.when(bad.isNotNull(), rules.error_list(rule_cols)).alias("__errors"),
    )
    is_cell = F.col("__kind") == CELL
    is_reject = F.col("__kind") == REJECT
    tagged = classified.select(
        "__kind",
        *[
            F.when(is_cell, F.col("__year_out") if k == "year" else F.col(f"__k_{k}")).alias(f"__c_{k}")
            for k in cfg.keys
        ],
        F.when(is_cell, F.col("__indicator")).alias("__c_indicator"),
        F.when(is_cell, F.col("__label")).alias("__c_label"),
        F.when(is_cell, F.col("__value")).alias("__c_value"),
        F.when(is_cell, F.col(f"__k_{cfg.order_col}")).alias("__c_order"),
        *[F.when(is_reject, F.col(f"__k_{c}")).alias(f"__r_{c}") for c in points.columns],
        F.when(is_reject, F.col("__errors")).alias("__r_errors"),
    )
    # Floating grouping keys are normalised (-0.0 -> 0.0), so floating reject
    # columns are grouped by their text and ride as aggregates (equal within a
    # group, so max() is the value itself, and a double buffer keeps it hashed).
    floating = {f"__r_{c}" for c, t in points.dtypes if t in ("double", "float")}
    carried = [c for c in reject_cols if c in floating]
    texts = [f"__t{c}" for c in carried]
    tagged = tagged.withColumns({f"__t{c}": F.col(c).cast("string") for c in carried}) if carried else tagged
    group = ["__kind", *cell_keys, "__c_indicator", "__c_label", *[c for c in reject_cols if c not in floating], *texts, "__r_errors"]
    number = F.count(F.lit(1)).alias("__n")
    if not cfg.order_unique:
        # ties on the order key resolve to the smallest value (as in pivot_indicators)
        tagged = tagged.groupBy(*group, "__c_order").agg(
            F.min("__c_value").alias("__c_value"), number, *[F.max(c).alias(c) for c in carried]
        )
        number = F.sum("__n").alias("__n")
    return tagged.groupBy(*group).agg(
        F.min_by("__c_value", "__c_order").alias("__c_value"), number, *[F.max(c).alias(c) for c in carried]
    ).drop(*texts)


def raw_from_checked(checked: DataFrame, cfg: SourceConfig) -> DataFrame:
    """The raw wide table from ``checked_points``: phase 2 of the pivot (one
    value per cell already) and the fixed schema (R2, R6)."""
    cells = checked.filter(F.col("__kind") == CELL).select(
        *[F.col(f"__c_{k}").alias(k) for k in cfg.keys],
        F.col("__c_indicator").alias("indicator"),
        F.col("__c_value").alias("value"),
    )
    wide = cells.groupBy(*cfg.keys).pivot("indicator", cfg.codes).agg(F.min("value"))
    return reshape.conform_columns(wide, list(cfg.keys), cfg.codes)


def counted_rejects(checked: DataFrame, point_columns: list[str], cfg: SourceConfig) -> DataFrame:
    """The distinct rejects of ``checked_points`` with how often each occurred."""
    return checked.filter(F.col("__kind") == REJECT).select(
        *[F.col(f"__r_{c}").alias(c) for c in point_columns],
        F.col("__r_errors").alias("errors"),
        F.lit(cfg.name).alias("source"),
        F.col("__n").cast("long").alias("occurrences"),
    )


def rejects_from_checked(checked: DataFrame, point_columns: list[str], cfg: SourceConfig) -> DataFrame:
    """The rejects of ``checked_points``, shaped as ``validate_points`` returns them (each as often as it occurred)."""
    return rules.expand_rejects(counted_rejects(checked, point_columns, cfg))


REPORT_COLUMNS = ["source", "metric", "detail", "number"]


def load_report(checked: DataFrame, name: str, cfg: SourceConfig) -> DataFrame:
    """What a load took in (V10, V11, R5), from ``checked_points`` alone: numbers of
    points, indicators and countries, every unmapped label with its points, and
    every error code with its rejects."""
    is_cell, is_reject = F.col("__kind") == CELL, F.col("__kind") == REJECT
    n, row = F.col("__n"), lambda m, d, v: F.struct(F.lit(m).alias("metric"), d.cast("string").alias("detail"), v.cast("long").alias("number"))
    none = F.lit(None)
    profile = checked.agg(
        F.coalesce(F.sum(F.when(is_cell, n)), F.lit(0)).alias("valued"),
        F.coalesce(F.sum(F.when(F.col("__kind") == EMPTY, n)), F.lit(0)).alias("empty"),
        F.coalesce(F.sum(F.when(is_reject, n)), F.lit(0)).alias("rejected"),
        F.count_distinct(F.when(is_cell, F.col("__c_indicator"))).alias("indicators"),
        F.count_distinct(F.when(is_cell, F.col("__c_country_code"))).alias("countries"),
    ).select(F.inline(F.array(*[row(c, none, F.col(c)) for c in ("valued", "empty", "rejected", "indicators", "countries")])))
    unmapped = checked.filter(F.col("__c_label").isNotNull()).groupBy(F.col("__c_label").alias("detail")).agg(F.sum("__n").alias("number"))
    errors = checked.filter(is_reject).select(F.explode("__r_errors").alias("detail"), "__n").groupBy("detail").agg(F.sum("__n").alias("number"))
    parts = [profile, unmapped.select(F.lit("unmapped_label").alias("metric"), "detail", "number"), errors.select(F.lit("reject").alias("metric"), "detail", "number")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select(F.lit(name).alias("source"), "metric", "detail", F.col("number").cast("long").alias("number"))


def to_raw_names(df: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Canonical key columns under the raw table's own names."""
    return df.withColumnsRenamed(dict(cfg.raw_names)) if cfg.raw_names else df


def from_raw_names(df: DataFrame, cfg: SourceConfig) -> DataFrame:
    return df.withColumnsRenamed({raw: key for key, raw in cfg.raw_names}) if cfg.raw_names else df


def has_valid_points(checked: DataFrame) -> DataFrame:
    """Rows of ``checked_points`` standing for valid points (for V12)."""
    return checked.filter(F.col("__kind").isin(CELL, EMPTY))


def stage_named_source(raw: DataFrame, seed: DataFrame, cfg: SourceConfig) -> DataFrame:
    """L1 for sources that carry their own country name (WB, HDR; stand-ins A, B):
    J1 inner join on ISO3, P3 rename to mart names."""
    joined = conform.join_dim_iso3(raw, seed)
    renamed = conform.rename_indicators(joined, cfg.dictionary)
    return renamed.select("country_code", "country_name", F.col("year").cast("int").alias("year"), *cfg.marts)


def stage_two_part_source(
    weo_raw: DataFrame, fdi_raw: DataFrame, seed: DataFrame, weo: SourceConfig, fdi: SourceConfig, where=None
) -> DataFrame:
    """L1 for the IMF-like source: WEO part (ISO3, text year) and FDI part
    (ISO2, int year), names from the dimension, merged on their own spine
    (U3 + J3).

    Planned as one FULL OUTER join of the parts on (country_code, year)
    (``spine.outer_merge``), so each part is computed once. Both parts take
    ``country_name`` from the same dimension row of their ISO3 code, so the
    spine's (code, name, year) rows are its (code, year) rows whenever the
    dimension is unique on ISO3 (a model test of the dimension), and then the
    two forms return the same rows. ``where``: a condition on the keys, applied
    to each part, since nothing is pushed through a full outer join."""
    weo_st = conform.attach_dim_name(conform.cast_year(weo_raw), seed)
    weo_st = conform.rename_indicators(weo_st, weo.dictionary).select(
        "country_code", F.col("country_name").alias("__weo_name"), "year", *weo.marts
    )
    fdi_st = conform.join_dim_iso2(fdi_raw, seed)
    fdi_st = conform.rename_indicators(fdi_st, fdi.dictionary).select(
        "country_code", F.col("country_name").alias("__fdi_name"), F.col("year").cast("int").alias("year"), *fdi.marts
    )
    if where is not None:
        weo_st, fdi_st = weo_st.filter(where), fdi_st.filter(where)
    merged = spine.outer_merge([weo_st, fdi_st], ["country_code", "year"])
    return merged.select(
        "country_code",
        F.coalesce("__weo_name", "__fdi_name").alias("country_name"),
        "year",
        *weo.marts,
        *fdi.marts,
    )


def build_panel(staged: list[DataFrame], dim: DataFrame, columns: list[str], where=None, co_located: bool = False) -> DataFrame:
    """L2: all (country, year) keys of the staged sources -> the fact table.

    J4 on U2's key set, planned as outer joins so each staged source is read
    once (``spine.outer_merge``). ``where``: a condition on the keys, applied to
    every source before the merge; the keys are the join keys, so the rows are
    those of the filtered fact, and the condition reaches each source's scan.

    ``co_located``: the staged sources are stored bucketed and sorted on the
    keys. Then the spine itself is planned: the union of the key columns, its
    distinct and every left join keep the buckets' partitioning, so no row is
    exchanged between the scans and the fact (a full outer join's coalesced keys
    would lose it); the keys are scanned twice, the values once."""
    keys = ["country_code", "year"]
    if where is not None:
        staged = [s.filter(where) for s in staged]
    key_set = spine.spine_distinct(staged, keys) if co_located else None
    return spine.fact_panel(key_set, dim, staged, columns, keys)
