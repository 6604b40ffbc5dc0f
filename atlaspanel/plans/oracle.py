"""Oracle SQL: for every registered query, the same rows computed directly in
ANSI SQL (DuckDB dialect) over the test tables.

The SQL re-derives each stand-in from the raw tables with its own CTEs; it
shares only column names and the stand-in dictionary with the Spark side, so a
semantic slip in an operator shows up as a value mismatch.
"""

from __future__ import annotations

from atlaspanel.plans import standins as S

YEARS = [str(y) for y in range(*S.WINDOW)]
CHUNKS = (YEARS[: len(YEARS) // 2 + 1], YEARS[len(YEARS) // 2 - 1 :])


def _iso3(k: str) -> str:
    return f"('N' || lpad(CAST({k} AS VARCHAR), 2, '0'))"


def _iso2(k: str) -> str:
    return f"lpad(CAST({k} AS VARCHAR), 2, '0')"


def _pivot_cells(dictionary, value="value", order="ingest_seq", col="indicator") -> str:
    return ",\n    ".join(
        f"arg_min({value}, {order}) FILTER (WHERE {col} = '{i.code}') AS \"{i.code}\"" for i in dictionary
    )


def _renames(dictionary, alias="r") -> str:
    return ", ".join(f'{alias}."{i.code}" AS {i.mart}' for i in dictionary)


def _label_case(dictionary, col="indicator") -> str:
    whens = " ".join(f"WHEN '{i.label}' THEN '{i.code}'" for i in dictionary if i.label)
    codes = ", ".join(f"'{i.code}'" for i in dictionary)
    return f"(CASE {col} {whens} ELSE (CASE WHEN {col} IN ({codes}) THEN {col} END) END)"


MARTS_A = [i.mart for i in S.STANDIN_A]
MARTS_B = [i.mart for i in S.STANDIN_B]
MARTS_C1 = [i.mart for i in S.STANDIN_C1]
MARTS_C2 = [i.mart for i in S.STANDIN_C2]
FACT_COLUMNS = MARTS_A + MARTS_B + MARTS_C1 + MARTS_C2
LO, HI = S.YEAR_LO, S.YEAR_HI
W0, W1 = S.WINDOW

_FLAGS = ", ".join(
    f"CAST(n.n_nationkey % {m} = 0 AS INTEGER) AS {name}"
    for m, name in zip(range(2, 8), ("EU", "OECD", "ASEAN", "BRICS", "G20", "FCS"))
)

BASE = f"""
seed AS (
  SELECT n.n_name AS country_name, {_iso3('n.n_nationkey')} AS iso3, {_iso2('n.n_nationkey')} AS iso2,
         r.r_name AS continent, r.r_name AS region,
         CASE n.n_nationkey % 4 WHEN 0 THEN 'Low income' WHEN 1 THEN 'Lower middle income'
              WHEN 2 THEN 'Upper middle income' ELSE 'High income' END AS income_group,
         {_FLAGS}
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim AS (
  SELECT iso3 AS country_code, country_name, iso2, continent, region, income_group,
         EU AS is_eu, OECD AS is_oecd, ASEAN AS is_asean, BRICS AS is_brics, G20 AS is_g20, FCS AS is_fcs
  FROM seed
),
pts_a AS (
  SELECT {_iso3('c.c_nationkey')} AS country_code, n.n_name AS country_name,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_orderpriority AS indicator,
         CASE WHEN (c.c_nationkey % 7 = 3 AND year(o.o_orderdate) % 2 = 0)
                OR (o.o_orderpriority = '5-LOW' AND year(o.o_orderdate) = 2001) THEN NULL
              ELSE o.o_totalprice END AS value,
         o.o_orderkey AS ingest_seq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
valid_a AS (
  SELECT country_code, country_name, year, {_label_case(S.STANDIN_A)} AS indicator,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value, ingest_seq
  FROM pts_a
  WHERE country_code IS NOT NULL AND length(country_code) BETWEEN 2 AND 3 AND country_name IS NOT NULL
    AND indicator IS NOT NULL AND year BETWEEN {LO} AND {HI} AND year >= {W0} AND year < {W1}
),
raw_a AS (
  SELECT country_code, country_name, year,
    {_pivot_cells(S.STANDIN_A)}
  FROM valid_a WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY country_code, country_name, year
),
stg_a AS (
  SELECT r.country_code, r.country_name, r.year, {_renames(S.STANDIN_A)}
  FROM raw_a r JOIN seed s ON r.country_code = s.iso3
),
pts_b AS (
  SELECT {_iso3('s.s_nationkey')} AS country_code, n.n_name AS country_name,
         CAST(year(l.l_shipdate) AS INTEGER) AS year, concat_ws('_', l.l_returnflag, l.l_linestatus) AS indicator,
         l.l_quantity AS value,
         {{'o': l.l_orderkey, 'l': l.l_linenumber, 'q': l.l_quantity}} AS ingest_seq
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
),
valid_b AS (
  SELECT country_code, country_name, year, indicator,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value, ingest_seq
  FROM pts_b
  WHERE country_code IS NOT NULL AND length(country_code) BETWEEN 2 AND 3 AND country_name IS NOT NULL
    AND indicator IS NOT NULL AND year BETWEEN {LO} AND {HI} AND year >= {W0} AND year < {W1}
),
raw_b AS (
  SELECT country_code, country_name, year,
    {_pivot_cells(S.STANDIN_B)}
  FROM valid_b WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY country_code, country_name, year
),
stg_b AS (
  SELECT r.country_code, r.country_name, r.year, {_renames(S.STANDIN_B)}
  FROM raw_b r JOIN seed s ON r.country_code = s.iso3
),
pts_c1 AS (
  SELECT {_iso3('c.c_nationkey')} AS country_code, CAST(year(e.ts) AS VARCHAR) AS year,
         e.event_type AS indicator, e.value AS value, e.event_id AS ingest_seq
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
),
valid_c1 AS (
  SELECT country_code, CAST(TRY_CAST(year AS INTEGER) AS VARCHAR) AS year, indicator,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value, ingest_seq
  FROM pts_c1
  WHERE country_code IS NOT NULL AND length(country_code) BETWEEN 2 AND 3 AND indicator IS NOT NULL
    AND TRY_CAST(year AS INTEGER) BETWEEN {LO} AND {HI}
    AND TRY_CAST(year AS INTEGER) >= {W0} AND TRY_CAST(year AS INTEGER) < {W1}
),
raw_c1 AS (
  SELECT country_code, year,
    {_pivot_cells(S.STANDIN_C1)}
  FROM valid_c1 WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY country_code, year
),
stg_weo AS (
  SELECT r.country_code, s.country_name, CAST(r.year AS INTEGER) AS year, {_renames(S.STANDIN_C1)}
  FROM raw_c1 r JOIN seed s ON r.country_code = s.iso3
),
pts_c2 AS (
  SELECT {_iso2('c.c_nationkey')} AS country_code, CAST(year(e.ts) AS INTEGER) AS year,
         'FDX' AS indicator, e.value AS value, e.event_id AS ingest_seq
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.event_type = 'signup'
),
valid_c2 AS (
  SELECT country_code, year, indicator, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, ingest_seq
  FROM pts_c2
  WHERE country_code IS NOT NULL AND length(country_code) BETWEEN 2 AND 3 AND indicator IS NOT NULL
    AND year BETWEEN {LO} AND {HI} AND year >= {W0} AND year < {W1}
    AND NOT (starts_with(country_code, '1C_') OR contains(country_code, 'ALLC'))
),
raw_c2 AS (
  SELECT country_code, year,
    {_pivot_cells(S.STANDIN_C2)}
  FROM valid_c2 WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY country_code, year
),
stg_fdi AS (
  SELECT s.iso3 AS country_code, s.country_name, r.year, {_renames(S.STANDIN_C2)}
  FROM raw_c2 r JOIN seed s ON r.country_code = s.iso2
),
stg_c AS (
  SELECT sp.country_code, sp.country_name, sp.year,
         {", ".join("w." + m for m in MARTS_C1)}, {", ".join("f." + m for m in MARTS_C2)}
  FROM (SELECT DISTINCT country_code, country_name, year FROM stg_weo
        UNION
        SELECT DISTINCT country_code, country_name, year FROM stg_fdi) sp
  LEFT JOIN stg_weo w ON sp.country_code = w.country_code AND sp.year = w.year
  LEFT JOIN stg_fdi f ON sp.country_code = f.country_code AND sp.year = f.year
),
spine AS (
  SELECT DISTINCT country_code, year FROM (
    SELECT country_code, year FROM stg_a UNION ALL
    SELECT country_code, year FROM stg_b UNION ALL
    SELECT country_code, year FROM stg_c)
),
fact AS (
  SELECT sp.country_code, d.country_name, sp.year,
         {", ".join("a." + m for m in MARTS_A)},
         {", ".join("b." + m for m in MARTS_B)},
         {", ".join("c." + m for m in MARTS_C1 + MARTS_C2)}
  FROM spine sp
  LEFT JOIN dim d ON sp.country_code = d.country_code
  LEFT JOIN stg_a a ON sp.country_code = a.country_code AND sp.year = a.year
  LEFT JOIN stg_b b ON sp.country_code = b.country_code AND sp.year = b.year
  LEFT JOIN stg_c c ON sp.country_code = c.country_code AND sp.year = c.year
),
wide AS (
  SELECT country_code AS economy, indicator AS "Series", country_name AS "Country",
    {", ".join(f"arg_min(value, ingest_seq) FILTER (WHERE year = {y}) AS " + chr(34) + y + chr(34) for y in YEARS)}
  FROM pts_a WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY country_code, indicator, country_name
),
latest AS (
  SELECT cb.country_code, cb.country_name,
    {", ".join(f"arg_max(f.{m}, f.year) FILTER (WHERE f.{m} IS NOT NULL) AS {m}, MAX(CASE WHEN f.{m} IS NOT NULL THEN f.year END) AS {m}_year" for m in FACT_COLUMNS)}
  FROM (SELECT DISTINCT country_code, country_name FROM dim) cb
  LEFT JOIN fact f ON cb.country_code = f.country_code
  GROUP BY cb.country_code, cb.country_name
),
fa AS (
  SELECT CASE WHEN ingest_seq % 13 = 0 THEN country_code || 'X' ELSE country_code END AS country_code,
         country_name,
         CASE WHEN ingest_seq % 7 = 0 THEN '20x1' ELSE CAST(year AS VARCHAR) END AS year,
         indicator,
         CASE WHEN ingest_seq % 11 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
         ingest_seq
  FROM pts_a
),
fa_checked AS (
  SELECT ingest_seq, concat_ws(',',
      CASE WHEN country_code IS NOT NULL AND length(country_code) NOT BETWEEN 2 AND 3 THEN 'code_length' END,
      COALESCE(CASE WHEN country_code IS NULL THEN 'missing_country_code' END,
               CASE WHEN country_name IS NULL THEN 'missing_country_name' END,
               CASE WHEN indicator IS NULL THEN 'missing_indicator' END),
      CASE WHEN year IS NOT NULL AND TRY_CAST(year AS INTEGER) IS NULL THEN 'year_text' END,
      CASE WHEN TRY_CAST(year AS INTEGER) IS NOT NULL
                AND (TRY_CAST(year AS INTEGER) < {LO} OR TRY_CAST(year AS INTEGER) > {HI}) THEN 'year_range' END,
      CASE WHEN value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL THEN 'value_text' END
    ) AS errors
  FROM fa
  WHERE NOT COALESCE(TRY_CAST(year AS INTEGER) < 1996 OR TRY_CAST(year AS INTEGER) >= 2000, FALSE)
)
"""


def with_base(select: str) -> str:
    return "WITH " + BASE.strip() + "\n" + select.strip()


# --- quality report rows -------------------------------------------------------


def _grade(m: str, grade: str, bound=None) -> str:
    if grade == "threshold":
        return f"CASE WHEN {m} >= 150 THEN 'fail' WHEN {m} > 0 THEN 'warn' ELSE 'pass' END"
    if grade == "positive":
        return f"CASE WHEN {m} > 0 THEN 'pass' ELSE 'fail' END"
    if grade == "at_least":
        return f"CASE WHEN {m} >= {bound} THEN 'pass' ELSE 'fail' END"
    return f"CASE WHEN {m} = 0 THEN 'pass' ELSE 'fail' END"


def qrow(dataset, check, column, measured, source, grade="zero", bound=None, layer="test") -> str:
    m = f"CAST(({measured}) AS DOUBLE)"
    return (
        f"SELECT '{layer}' AS layer, '{dataset}' AS dataset, '{check}' AS \"check\", '{column}' AS \"column\", "
        f"{m} AS measured, {_grade(m, grade, bound)} AS outcome FROM {source}"
    )


def q_nulls(dataset, table, col, check="not_null"):
    return qrow(dataset, check, col, f"SUM(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END)", table)


def q_dups(dataset, table, cols, check):
    keys = ", ".join(cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    src = f"(SELECT {keys} FROM {table} WHERE {nn} GROUP BY {keys} HAVING count(*) > 1) d"
    return qrow(dataset, check, ",".join(cols), "count(*)", src)


def q_values(dataset, table, col, values, check):
    lst = ", ".join(f"'{v}'" for v in values)
    return qrow(dataset, check, col, f"SUM(CASE WHEN {col} IS NOT NULL AND {col} NOT IN ({lst}) THEN 1 ELSE 0 END)", table)


def q_range(dataset, table, col, lo=None, hi=None, grade="threshold"):
    bad = " OR ".join(x for x in [f"{col} < {lo}" if lo is not None else "", f"{col} > {hi}" if hi is not None else ""] if x)
    return qrow(dataset, "invalid_range", col, f"SUM(CASE WHEN {col} IS NOT NULL AND ({bad}) THEN 1 ELSE 0 END)", table, grade)


def q_orphans(dataset, table, col, parent_sql, parent_col):
    src = f"(SELECT 1 FROM {table} x WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({parent_sql}) p WHERE p.{parent_col} = x.{col})) o"
    return qrow(dataset, "relationships", col, "count(*)", src)


def q_required(dataset, table, cols):
    lst = ", ".join(f"'{c}'" for c in cols)
    measured = (
        f"{len(cols)} - (SELECT count(*) FROM information_schema.columns "
        f"WHERE table_name = '{table}' AND column_name IN ({lst}))"
    )
    return qrow(dataset, "required_columns", ",".join(cols), measured, "(SELECT 1) one")


def union(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


# --- per-query SQL ---------------------------------------------------------------

_K = "CAST(substr(iso3, 2, 2) AS INTEGER)"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
TABLES = list(S.TABLES)


def _select(name: str) -> str:
    q = {
        # sources
        "read_country_seed": f"""
            SELECT CASE WHEN {_K} = 3 THEN country_name || ', Republic of' ELSE country_name END AS country_name,
                   iso3, CASE WHEN {_K} = 7 THEN 'NA' WHEN {_K} = 11 THEN NULL ELSE iso2 END AS iso2,
                   continent, region, income_group, EU, OECD, ASEAN, BRICS, G20, FCS FROM seed""",
        "read_wide_years": " UNION ALL ".join(
            'SELECT economy AS country_code, "Series" AS indicator, "Country", '
            + ", ".join(f'"{y}"' if y in chunk else f'CAST(NULL AS DOUBLE) AS "{y}"' for y in YEARS) + " FROM wide"
            for chunk in CHUNKS
        ),
        "read_point_records": """SELECT country_code AS "countryIsoCode", country_name AS country, year,
                   indicator AS "indicatorCode", value FROM pts_b""",
        "read_nested_map": """SELECT country_code, indicator, year,
                   CASE WHEN year <> '2000' THEN arg_min(value, ingest_seq) END AS value,
                   CASE WHEN year = '2000' THEN 'value_text' END AS error
                   FROM pts_c1 WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY indicator, country_code, year""",
        "read_parallel_arrays": """SELECT country_code, year,
                   CASE WHEN year <> 2000 THEN arg_min(value, ingest_seq) END AS value,
                   CASE WHEN year = 2000 THEN 'value_text' END AS error
                   FROM pts_c2 WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY country_code, year""",
        "read_layer_table": "SELECT * FROM seed",
        "head_sample": "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 5",
        # sinks
        "replace_table": "SELECT * FROM seed",
        "export_csv_backup": "SELECT * FROM stg_a",
        "publish_view": "SELECT * FROM stg_b",
        "publish_table": "SELECT * FROM fact",
        "load_row_count": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS loaded_rows FROM {t}" for t in TABLES
        ),
        # reshape
        "unpivot_years": " UNION ALL ".join(
            f"SELECT economy AS country_code, \"Country\", \"Series\" AS indicator, CAST({y} AS INTEGER) AS year, \"{y}\" AS value FROM wide"
            for y in YEARS
        ),
        "pivot_indicators": "SELECT * FROM raw_a",
        "concat_chunks": " UNION ALL ".join(
            'SELECT economy, "Series", "Country", '
            + ", ".join(f'"{y}"' if y in chunk else f'CAST(NULL AS DOUBLE) AS "{y}"' for y in YEARS)
            + " FROM wide"
            for chunk in CHUNKS
        ),
        "map_labels_to_codes": f"""SELECT country_code, year, indicator AS label, {_label_case(S.STANDIN_A)} AS indicator,
                   value, ingest_seq FROM pts_a""",
        "unmapped_indicators": """SELECT indicator AS label, count(*) AS points FROM pts_a
                   WHERE indicator = '4-NOT SPECIFIED' GROUP BY indicator""",
        "conform_columns": 'SELECT country_code, country_name, year, "P5", "P1", "P3", CAST(NULL AS DOUBLE) AS "P9" FROM raw_a',
        # validation
        "check_code_length": """SELECT c_custkey, 'N' || CAST(c_custkey AS VARCHAR) AS code,
                   CASE WHEN length('N' || CAST(c_custkey AS VARCHAR)) NOT BETWEEN 2 AND 3 THEN 'code_length' END AS error
                   FROM customer""",
        "check_year_range": """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
                   CASE WHEN year(l_shipdate) < 1996 OR year(l_shipdate) > 2000 THEN 'year_range' END AS error
                   FROM lineitem""",
        "coerce_year_text": """SELECT o_orderkey, t AS year_text, TRY_CAST(t AS INTEGER) AS year,
                   CASE WHEN t IS NOT NULL AND TRY_CAST(t AS INTEGER) IS NULL THEN 'year_text' END AS error
                   FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '20x1'
                                                 ELSE CAST(year(o_orderdate) AS VARCHAR) END AS t FROM orders)""",
        "check_required": """SELECT c_custkey, segment,
                   COALESCE(CASE WHEN c_name IS NULL THEN 'missing_c_name' END,
                            CASE WHEN segment IS NULL THEN 'missing_segment' END) AS error
                   FROM (SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment
                         FROM customer)""",
        "coerce_value": """SELECT l_orderkey, l_linenumber,
                   CASE WHEN isnan(TRY_CAST(t AS DOUBLE)) THEN NULL ELSE TRY_CAST(t AS DOUBLE) END AS value,
                   CASE WHEN t IS NOT NULL AND TRY_CAST(t AS DOUBLE) IS NULL THEN 'value_text' END AS error
                   FROM (SELECT l_orderkey, l_linenumber,
                                CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber = 6 THEN 'NaN'
                                     ELSE CAST(l_quantity AS VARCHAR) END AS t FROM lineitem)""",
        "reject_aggregates": """SELECT p_partkey, code,
                   CASE WHEN starts_with(code, '1C_') OR contains(code, 'ALLC') THEN 'aggregate' END AS error
                   FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '1C_' || CAST(p_partkey AS VARCHAR)
                                                WHEN p_partkey % 10 = 1 THEN 'XALLC' || CAST(p_partkey AS VARCHAR)
                                                ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS code FROM part)""",
        "filter_year_window": """SELECT o_orderkey, year FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year
                   FROM orders) WHERE year >= 1996 AND year < 2000""",
        "drop_null_values": """SELECT event_id, value FROM (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value
                   FROM events) WHERE value IS NOT NULL""",
        "split_valid_rejects": """SELECT ingest_seq, CASE WHEN errors = '' THEN 'valid' ELSE 'rejected' END AS status, errors
                   FROM fa_checked""",
        "reject_summary": """SELECT 'a' AS source, error, count(*) AS rejects FROM (
                   SELECT unnest(string_split(errors, ',')) AS error FROM fa_checked WHERE errors <> '')
                   GROUP BY error""",
        "reject_sample": """SELECT ingest_seq, errors FROM fa_checked WHERE errors <> ''
                   ORDER BY ingest_seq LIMIT 5""",
        "load_profile": """SELECT count(DISTINCT indicator) AS indicators, count(DISTINCT country_code) AS countries,
                   count(*) AS points FROM pts_a""",
        # projection / filter
        "conform_dimension": "SELECT * FROM dim",
        "dim_country": "SELECT * FROM dim",
        "rename_indicators": f"SELECT r.country_code, r.country_name, r.year, {_renames(S.STANDIN_A)} FROM raw_a r",
        "cast_year": "SELECT country_code, CAST(year AS INTEGER) AS year, "
        + ", ".join(f'"{i.code}"' for i in S.STANDIN_C1) + " FROM raw_c1",
        "not_null_filter": "SELECT country_code, year, a_low FROM fact WHERE a_low IS NOT NULL",
        "compare_filter": """SELECT f.country_code, f.year, f.a_urgent FROM fact f JOIN dim d ON f.country_code = d.country_code
                   WHERE d.is_eu = 1 AND d.continent = 'ASIA' AND f.year >= 1998""",
        "scale_value": "SELECT country_code, year, a_urgent / CAST(1000000.0 AS DOUBLE) AS a_urgent_millions FROM fact",
        "case_non_null": "SELECT country_code, year, CASE WHEN a_low IS NOT NULL THEN year END AS a_low_year FROM fact",
        # joins
        "join_dim_iso3": f"SELECT r.* FROM raw_a r JOIN seed s ON r.country_code = s.iso3 WHERE {_K} < 20",
        "join_dim_iso2": f"""SELECT s.iso3 AS country_code, s.country_name, r.year, r."FDX"
                   FROM raw_c2 r JOIN seed s ON r.country_code = s.iso2 WHERE {_K} < 20""",
        "merge_sources_on_spine": f"""SELECT sp.country_code, sp.year, {", ".join("a." + m for m in MARTS_A)},
                   {", ".join("b." + m for m in MARTS_B)}
                   FROM (SELECT DISTINCT country_code, year FROM (SELECT country_code, year FROM stg_a
                         UNION ALL SELECT country_code, year FROM stg_b)) sp
                   LEFT JOIN stg_a a ON sp.country_code = a.country_code AND sp.year = a.year
                   LEFT JOIN stg_b b ON sp.country_code = b.country_code AND sp.year = b.year""",
        "fact_panel": "SELECT * FROM fact",
        "dim_left_fact": """SELECT d.country_code, d.country_name, f.year, f.a_urgent
                   FROM (SELECT DISTINCT country_code, country_name FROM dim) d
                   LEFT JOIN (SELECT * FROM fact WHERE country_code <> 'N24') f ON d.country_code = f.country_code""",
        "fact_inner_dim": """SELECT f.country_code, f.year, f.a_urgent, d.continent, d.income_group
                   FROM fact f JOIN dim d ON f.country_code = d.country_code""",
        # set ops
        "union_all": """SELECT country_code, year FROM stg_a UNION ALL SELECT country_code, year FROM stg_b
                   UNION ALL SELECT country_code, year FROM stg_c""",
        "spine_distinct": "SELECT * FROM spine",
        "union_distinct": """SELECT country_code, country_name, year FROM stg_weo
                   UNION SELECT country_code, country_name, year FROM stg_fdi""",
        "distinct_pairs": "SELECT DISTINCT country_code, country_name FROM fact",
        # aggregation
        "peak_and_last_year": "SELECT cb.country_code, cb.country_name, "
        + ", ".join(f"MAX(f.{m}) AS {m}, MAX(CASE WHEN f.{m} IS NOT NULL THEN f.year END) AS {m}_year" for m in FACT_COLUMNS)
        + """ FROM (SELECT DISTINCT country_code, country_name FROM dim) cb
              LEFT JOIN fact f ON cb.country_code = f.country_code GROUP BY cb.country_code, cb.country_name""",
        "latest_value": "SELECT * FROM latest",
        "sum_flags": "SELECT " + ", ".join(
            f"CAST(SUM({f}) AS BIGINT) AS {f}_members" for f in ("is_eu", "is_oecd", "is_asean", "is_brics", "is_g20", "is_fcs")
        ) + " FROM dim",
        "group_avg": """SELECT d.continent, ROUND(AVG(f.a_urgent), 6) AS avg_a_urgent, ROUND(AVG(f.b_a_f), 6) AS avg_b_a_f
                   FROM fact f JOIN dim d ON f.country_code = d.country_code GROUP BY d.continent""",
        "count_distinct": """SELECT d.continent, count(DISTINCT f.country_code) AS country_count
                   FROM fact f JOIN dim d ON f.country_code = d.country_code WHERE f.a_low IS NOT NULL
                   GROUP BY d.continent""",
        "scalar_max_filter": "SELECT country_code, year, c_click FROM fact WHERE year = (SELECT MAX(year) FROM fact)",
        "row_count": "SELECT count(*) AS row_count FROM fact",
        "min_measure": "SELECT MIN(year) AS min_year FROM fact",
        # order
        "order_by": """SELECT country_code, country_name, a_urgent, a_urgent_year FROM latest
                   ORDER BY country_name ASC NULLS LAST, a_urgent DESC NULLS LAST""",
        "top_n": """SELECT country_code, year, b_a_f FROM fact
                   ORDER BY b_a_f DESC NULLS LAST, country_code, year LIMIT 10""",
        # analyst
        "top_economies": """SELECT country_name, year, a_urgent / 1e12 AS gdp_trillions_usd,
                   a_high AS gdp_per_capita_ppp, b_a_f AS hdi FROM fact
                   WHERE year = 2001 AND a_urgent IS NOT NULL
                   ORDER BY a_urgent DESC NULLS LAST, country_code LIMIT 10""",
        "member_trend": """SELECT f.country_name, f.year, f.b_a_f AS hdi, f.a_high AS gdp_per_capita
                   FROM fact f JOIN dim d ON f.country_code = d.country_code
                   WHERE d.is_brics = 1 AND f.year >= 1998 AND f.b_a_f IS NOT NULL
                   ORDER BY f.country_name, f.year""",
        "inequality_by_continent": """SELECT d.continent, ROUND(AVG(f.c_click), 6) AS avg_gini,
                   ROUND(AVG(f.c_error), 6) AS avg_inequality_coef, COUNT(DISTINCT f.country_code) AS country_count
                   FROM fact f JOIN dim d ON f.country_code = d.country_code
                   WHERE f.year = (SELECT MAX(year) FROM fact) AND f.c_click IS NOT NULL
                   GROUP BY d.continent ORDER BY avg_gini DESC NULLS LAST""",
        "schooling_gdp_listing": """SELECT country_name, year, b_r_o AS education_years, a_high AS gdp_per_capita,
                   b_a_f AS hdi FROM fact
                   WHERE year = 2001 AND b_r_o IS NOT NULL AND a_high IS NOT NULL
                   ORDER BY b_r_o DESC NULLS LAST, country_code LIMIT 20""",
        "measure_correlation": """SELECT count(*) AS pairs, ROUND(corr(a_urgent, b_a_f), 6) AS correlation
                   FROM fact WHERE a_urgent IS NOT NULL AND b_a_f IS NOT NULL""",
        # quality
        "test_not_null": union(*[q_nulls("orders", "orders", c) for c in ORDERS_COLS]),
        "test_unique": q_dups("events", "events", ["user_id"], "unique"),
        "test_accepted_values": q_values("orders", "orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], "accepted_values"),
        "test_relationships": q_orphans("orders", "orders", "o_custkey", "SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0", "c_custkey"),
        "test_unique_combination": q_dups("lineitem", "lineitem", ["l_orderkey", "l_linenumber"], "unique_combination"),
        "check_row_count": union(*[qrow(t, "row_count", "", "count(*)", t, "positive") for t in TABLES]),
        "check_missing_count": union(
            *[
                q_nulls("events", "(SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events) e", c, "missing_count")
                for c in ("event_id", "ts", "user_id", "event_type", "value")
            ]
        ),
        "check_duplicate_count": union(
            q_dups("lineitem", "lineitem", ["l_orderkey"], "duplicate_count"),
            q_dups("lineitem", "lineitem", ["l_orderkey", "l_linenumber"], "duplicate_count"),
        ),
        "check_invalid_range": union(
            q_range("customer", "customer", "c_acctbal", lo=0),
            q_range("lineitem", "lineitem", "l_quantity", lo=1, hi=49),
        ),
        "check_invalid_values": q_values("orders", "orders", "o_orderstatus", ["F", "O"], "invalid_values"),
        "check_min": qrow("orders", "min", "year", "MIN(CAST(year(o_orderdate) AS INTEGER))", "orders", "at_least", 2000),
        "check_required_columns": q_required("orders", "orders", ["o_orderkey", "o_custkey", "o_comment"]),
        "grade_outcome": f"""SELECT "check", "column", measured, outcome FROM ({q_range("customer", "customer", "c_acctbal", lo=0)})""",
        "quality_report": union(
            qrow("orders", "row_count", "", "count(*)", "orders", "positive"),
            *[q_nulls("orders", "orders", c, "missing_count") for c in ("o_orderkey", "o_custkey", "o_orderdate")],
            q_dups("orders", "orders", ["o_orderkey"], "duplicate_count"),
            q_values("orders", "orders", "o_orderstatus", ["F", "O", "P"], "invalid_values"),
            q_range("orders", "orders", "o_totalprice", lo=1000, hi=500000),
            q_orphans("orders", "orders", "o_custkey", "SELECT c_custkey FROM customer", "c_custkey"),
            q_required("orders", "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]),
            qrow("customer", "row_count", "", "count(*)", "customer", "positive"),
            q_dups("customer", "customer", ["c_custkey"], "unique"),
            q_nulls("customer", "customer", "c_name", "not_null"),
            q_values("customer", "customer", "c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "accepted_values"),
            q_range("customer", "customer", "c_acctbal", lo=0),
        ),
        # pipeline
        "stage_source_a": "SELECT * FROM stg_a",
        "stage_source_b": "SELECT * FROM stg_b",
        "stage_source_c": "SELECT * FROM stg_c",
        "build_panel": "SELECT * FROM fact",
    }
    return q[name]


def oracle_queries(names) -> dict[str, str]:
    out = {}
    for n in names:
        try:
            out[n] = with_base(_select(n))
        except KeyError:
            pass
    return out
