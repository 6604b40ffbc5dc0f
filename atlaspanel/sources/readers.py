"""Sources S1-S7: landed files and layer tables -> DataFrames with fixed schemas.

The HTTP fetchers of the reference are out of scope; these readers start from
the files such fetchers land. Every reader declares its schema (no inference
pass over the data) and is splittable where the format allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaspanel.operators.reshape import concat_chunks
from atlaspanel.sources import sinks
from atlaspanel.sources.json_ranges import Ranges

# Seed CSV: six text columns and six 0/1 flag columns.
SEED_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("country_name", "iso3", "iso2", "continent", "region", "income_group")]
    + [T.StructField(c, T.IntegerType(), True) for c in ("EU", "OECD", "ASEAN", "BRICS", "G20", "FCS")]
)

# Point-record JSON (HDR-like): one object per data point.
POINT_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("countryIsoCode", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("year", T.StringType(), True),
        T.StructField("indicatorCode", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)

# Nested-map JSON (WEO-like): values[indicator][country][year] = value. Leaves
# stay text until validation (V5): one bad cell is one reject, not a lost document.
NESTED_MAP_SCHEMA = T.StructType(
    [
        T.StructField(
            "values",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
            True,
        )
    ]
)

# Parallel-array JSON (FDI-like): series.docs[] with REF_AREA, period[], value[].
PARALLEL_ARRAYS_SCHEMA = T.StructType(
    [
        T.StructField(
            "series",
            T.StructType(
                [
                    T.StructField(
                        "docs",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField(
                                        "dimensions",
                                        T.StructType([T.StructField("REF_AREA", T.StringType(), True)]),
                                        True,
                                    ),
                                    T.StructField("period", T.ArrayType(T.StringType()), True),
                                    T.StructField("value", T.ArrayType(T.StringType()), True),
                                ]
                            )
                        ),
                        True,
                    )
                ]
            ),
            True,
        )
    ]
)


# Column that receives the text of a document that is not readable JSON.
CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """JSON documents with the declared schema; an unreadable one keeps its text in ``CORRUPT``."""
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.read.schema(declared).option("multiLine", multi_line).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
    )


def _parts(field: str):
    """A document as (content, unreadable text) entries: its content, and one more entry if it is unreadable."""
    content = F.when(F.col(field).isNotNull(), F.struct(F.col(field).alias("content"), F.lit(None).cast("string").alias("bad")))
    bad = F.when(F.col(CORRUPT).isNotNull(), F.struct(F.lit(None).alias("content"), F.col(CORRUPT).alias("bad")))
    return F.explode(F.array_compact(F.array(content, bad)))


def _elements(spark: SparkSession, path: str, level: int, under: tuple) -> tuple[DataFrame, DataFrame, list[str]]:
    """A payload of large documents by byte ranges: the elements (``text``, ``keys``, place) under the given keys
    (None: any), texts of documents that end too early, and the files that hold no element at all."""
    ranges = Ranges(spark, path)
    found = ranges.elements(level)
    for i, key in enumerate(under):
        if key is not None:
            found = found.filter(F.element_at("keys", i + 1) == key)
    early = ranges.unfinished_outside(level)
    bad = spark.createDataFrame([(f, f"unfinished document {f}") for f in early], "file string, bad string")
    return found, bad, ranges.files_without(level)


def _element_order(df: DataFrame, path: str, ordered: bool) -> DataFrame:
    """``ingest_seq`` of elements: their file's rank, then their range and their place in it."""
    if not ordered:
        return df.drop("file", "start", "place")
    pos = F.coalesce("start", F.lit(0)).cast("decimal(38,0)") * _decimal_power(TASK_ROW_DIGITS) + F.coalesce("place", F.lit(0))
    out = _with_file_rank(df.withColumn("__file", F.col("file")).withColumn("__pos", pos), path, _decimal_power(OFFSET_DIGITS + TASK_ROW_DIGITS), "ingest_seq")
    return out.drop("file", "start", "place")


def read_country_seed(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV; only the empty field is NULL, so the code ``NA`` stays text."""
    return (
        spark.read.schema(SEED_SCHEMA)
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_wide_years(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    renames: dict[str, str] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Id columns + one column per year; ``economy``/``Series`` renamed.

    The files under ``path`` are chunks that may hold different years: their
    columns are matched by name, and a year that a chunk lacks is NULL (R3).
    Parquet footers carry the names; CSV files are grouped by their header line,
    since a CSV scan matches columns by position. ``ordered`` adds the payload
    order ``ingest_seq``.
    """
    renames = renames if renames is not None else {"economy": "country_code", "Series": "indicator"}
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "")
        groups: dict[tuple, list[str]] = {}
        for file in sorted(r["__file"] for r in _listing(spark, path).collect()):  # one path per landed file
            groups.setdefault(tuple(reader.load(file).columns), []).append(file)
        chunks = [reader.load(files) for files in groups.values()]
    else:
        chunks = [reader.option("mergeSchema", True).load(path)]
    if ordered:
        chunks = [payload_order(c, parquet=fmt == "parquet", path=path) for c in chunks]
    df = concat_chunks(chunks)
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def read_point_records(spark: SparkSession, path: str, multi_line: bool = False, ordered: bool = False, by_ranges: bool = False) -> DataFrame:
    """S3: JSON arrays (or lines) of point records.

    Line-delimited files -- including one array per line -- split as they are. A
    file that is one JSON array over one or many lines is read with
    ``by_ranges=True``: its records are found from byte ranges in parallel
    (``json_ranges``); ``multi_line=True`` reads it in one task. An unreadable
    record or document becomes one point without keys whose ``value`` is its
    text, which validation rejects.
    """
    if by_ranges:
        found, early, without = _elements(spark, path, 1, ())
        declared = T.StructType([*POINT_RECORD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
        raw = found.withColumn("r", F.from_json("text", declared, {"columnNameOfCorruptRecord": CORRUPT})).select("file", "start", "place", "r.*")
        raw = raw.unionByName(early.select("file", F.col("bad").alias(CORRUPT)), allowMissingColumns=True)
        raw = _element_order(raw, path, ordered)
        if without:
            raw = raw.unionByName(_whole(spark, path, without, POINT_RECORD_SCHEMA, ordered))
    else:
        raw = _json(spark, path, POINT_RECORD_SCHEMA, multi_line)
        if ordered:
            raw = payload_order(raw, parquet=False, path=path)
    return raw.withColumn("value", F.coalesce(CORRUPT, "value")).drop(CORRUPT)


def read_nested_map(spark: SparkSession, path: str, multi_line: bool = False, ordered: bool = False, by_ranges: bool = False) -> DataFrame:
    """``values[indicator][country][year] = value`` -> (country_code, indicator, year, value).

    Generator steps only; each output row is independent, so this stays a
    narrow, per-partition transformation. Values are text (V5 parses them).
    ``by_ranges``: a document's (indicator, country) maps are found from byte
    ranges in parallel. An unreadable document or map becomes one point without
    keys whose ``value`` is its text, which validation rejects.
    """
    seq = ["ingest_seq"] if ordered else []
    if by_ranges:
        found, early, without = _elements(spark, path, 3, ("values",))
        years = F.from_json("text", "map<string,string>")
        maps = found.select(
            "file", "start", "place", F.element_at("keys", 3).alias("country_code"), F.element_at("keys", 2).alias("indicator"),
            years.alias("years"), F.when(years.isNull(), F.col("text")).alias("bad"),
        ).unionByName(early.select("file", "bad"), allowMissingColumns=True)
        by_country = _element_order(maps, path, ordered)
        if without:
            by_country = by_country.unionByName(_countries(_whole(spark, path, without, NESTED_MAP_SCHEMA, ordered), seq))
    else:
        raw = _json(spark, path, NESTED_MAP_SCHEMA, multi_line)
        if ordered:  # document order; entries of one document share it (map keys are unique)
            raw = payload_order(raw, parquet=False, path=path)
        by_country = _countries(raw, seq)
    cells = by_country.select(*seq, "bad", "country_code", "indicator", F.explode_outer("years").alias("year", "value"))
    return cells.filter(F.col("year").isNotNull() | F.col("bad").isNotNull()).select(
        F.when(F.col("bad").isNull(), F.col("country_code")).alias("country_code"), F.when(F.col("bad").isNull(), F.col("indicator")).alias("indicator"),
        "year", F.coalesce("bad", "value").alias("value"), *seq,
    )


def _whole(spark: SparkSession, path: str, files: list[str], schema: T.StructType, ordered: bool) -> DataFrame:
    raw = _json(spark, files, schema, True)
    return payload_order(raw, parquet=False, path=path) if ordered else raw


def _countries(raw: DataFrame, seq: list[str]) -> DataFrame:
    """Nested-map documents -> one row per (indicator, country) with its years."""
    parts = raw.select(*seq, _parts("values").alias("part")).select(*seq, "part.content", "part.bad")
    by_indicator = parts.select(*seq, "bad", F.explode_outer("content").alias("indicator", "countries"))
    return by_indicator.select(*seq, "bad", "indicator", F.explode_outer("countries").alias("country_code", "years"))


def read_parallel_arrays(spark: SparkSession, path: str, multi_line: bool = False, ordered: bool = False, by_ranges: bool = False) -> DataFrame:
    """Per document zip(period, value) -> (country_code, year, value).

    Like a zip over two lists, pairs stop at the shorter array: both arrays are
    sliced to the common length before ``arrays_zip`` (which would pad). Values
    are text (V5 parses them). ``by_ranges``: the entries of ``series.docs`` are
    found from byte ranges in parallel. An unreadable document or entry becomes
    one point without keys whose ``value`` is its text, which validation rejects.
    """
    seq = ["ingest_seq"] if ordered else []
    if by_ranges:
        found, early, without = _elements(spark, path, 3, ("series", "docs"))
        entry = PARALLEL_ARRAYS_SCHEMA["series"].dataType["docs"].dataType.elementType
        declared = T.StructType([*entry.fields, T.StructField(CORRUPT, T.StringType(), True)])
        read = found.withColumn("doc", F.from_json("text", declared, {"columnNameOfCorruptRecord": CORRUPT}))
        docs = read.select("file", "start", "place", F.col(f"doc.{CORRUPT}").alias("bad"), F.struct(*[F.col(f"doc.{f.name}").alias(f.name) for f in entry.fields]).alias("doc"))
        docs = _element_order(docs.unionByName(early.select("file", "bad"), allowMissingColumns=True), path, ordered)
        if without:
            docs = docs.unionByName(_series_docs(_whole(spark, path, without, PARALLEL_ARRAYS_SCHEMA, ordered), seq))
    else:
        raw = _json(spark, path, PARALLEL_ARRAYS_SCHEMA, multi_line)
        if ordered:  # document order; pairs of one document share it
            raw = payload_order(raw, parquet=False, path=path)
        docs = _series_docs(raw, seq)
    n = F.coalesce(F.least(F.size("doc.period"), F.size("doc.value")), F.lit(0))
    zipped = F.arrays_zip(F.slice("doc.period", 1, n).alias("period"), F.slice("doc.value", 1, n).alias("value"))
    pairs = docs.select(
        *seq, "bad", F.col("doc.dimensions.REF_AREA").alias("country_code"), F.inline_outer(F.when((n > 0) & F.col("bad").isNull(), zipped))
    ).filter(F.col("period").isNotNull() | F.col("value").isNotNull() | F.col("bad").isNotNull())
    return pairs.select(
        F.when(F.col("bad").isNull(), F.col("country_code")).alias("country_code"), F.col("period").alias("year"), F.coalesce("bad", "value").alias("value"), *seq
    )


def _series_docs(raw: DataFrame, seq: list[str]) -> DataFrame:
    """Parallel-array documents -> one row per entry of ``series.docs``."""
    parts = raw.select(*seq, _parts("series").alias("part")).select(*seq, "part.content", "part.bad")
    return parts.select(*seq, "bad", F.explode_outer("content.docs").alias("doc"))


def read_layer_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """Named table scan ``layer.name``."""
    return spark.table(f"{layer}.{name}")


#: Files that one sorted read lines up; beyond it the rows are sorted as usual.
SORTED_FILES = 512


def read_clustered(spark: SparkSession, layer: str, name: str, where: dict[str, tuple] | None = None, ordered: bool = False) -> DataFrame:
    """A clustered table, of which only the files that may hold the asked keys are opened.

    ``where``: cluster column -> (lowest, highest) value, either may be None; the
    condition is applied to the rows as well. ``ordered``: the rows come in the
    order of the cluster columns (nulls last) without an exchange: the files are
    sorted ranges, so reading them in the order of their names is reading in key
    order. A table of more than ``SORTED_FILES`` files, or with a file above the
    size of a read partition, is sorted by an ordinary ``ORDER BY``.
    """
    version = sinks.current_version(spark, layer, name)
    index = spark.table(f"`{layer}`.`{sinks.index_of(version)}`")
    keys = [c.removesuffix("__min") for c in index.columns if c.endswith("__min")]
    schema = spark.table(f"`{layer}`.`{version}`").schema
    may, asked = F.lit(True), F.lit(True)
    for col, (lo, hi) in (where or {}).items():
        if lo is not None:
            may, asked = may & (F.col(f"{col}__max") >= lo), asked & (F.col(col) >= lo)
        if hi is not None:
            may, asked = may & (F.col(f"{col}__min") <= hi), asked & (F.col(col) <= hi)
    files = sorted(r["file"] for r in index.filter(may).collect())  # one row per file
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if not ordered:
        return reader.parquet(*files).filter(asked)
    # a file that a scan would cut, or too many files: sort
    if len(files) > SORTED_FILES or _largest(spark, files) > _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        return reader.parquet(*files).filter(asked).orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return reduce(lambda a, b: a.unionAll(b), [reader.parquet(f).filter(asked) for f in files])


def _largest(spark: SparkSession, files: list[str]) -> int:
    return spark.read.format("binaryFile").load(files).agg(F.max("length")).first()[0]


def _bytes(size: str) -> int:
    """A size setting as bytes: a number with an optional unit."""
    number = size.strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def head_sample(df: DataFrame, columns: list[str], order: list[str], n: int = 5) -> DataFrame:
    """``SELECT cols ... LIMIT n``, ordered by a key so the sample is deterministic."""
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


# Fixed digit budgets of the payload order key (decimal(38,0)):
#   file rank < 2^39 (RANK_PARTITIONS range partitions x 2^33 rows each)
#   parquet: rank * 10^13 + row_index            (row_index < 10^13 per file)
#   text:    rank * 10^25 + block_start * 10^10 + row_in_task
#            (byte offset < 10^15, row index within a task < 2^33 < 10^10)
RANK_PARTITIONS = 64
ROW_INDEX_DIGITS = 13
OFFSET_DIGITS = 15
TASK_ROW_DIGITS = 10


def _decimal_power(digits: int):
    """10^digits as a decimal(38,0) literal (beyond the range of a long)."""
    return F.expr(f"CAST({10**digits} AS DECIMAL(38,0))")


def _file_ranks(files: DataFrame) -> DataFrame:
    """An order-preserving rank per file path (column ``__file``), computed in parallel.

    Range-partition the paths, sort each partition, and take
    ``monotonically_increasing_id`` (partition index in the high bits, row in
    the partition in the low bits): it increases with the path. No window
    without a partition, so the file list never funnels through one task.
    Ranks are not dense; the key only needs their order.
    """
    return (
        files.repartitionByRange(RANK_PARTITIONS, "__file")
        .sortWithinPartitions("__file")
        .withColumn("__rank", F.monotonically_increasing_id())
    )


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The payload's files, from their listing alone (no file is opened): one row per path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("__file"))


def payload_order(df: DataFrame, parquet: bool, path: str | list[str], col: str = "ingest_seq") -> DataFrame:
    """Attach the payload row order: (file rank, position within the file).

    ``df`` must come straight from a scan of ``path``. Files are ranked by name
    from the listing of ``path``, so the payload itself is scanned once. The
    ranks (one row per file) are left to the optimizer's own size test; beyond
    it the join shuffles and AQE splits a file that holds most rows. The key is
    ``decimal(38,0)``, a primitive the pivot's ``min_by`` still aggregates with
    a hash aggregate.

    * parquet: ``_metadata.row_index`` is the row's position in its file;
      key ``rank * 10^13 + row_index``.
    * text formats (JSON lines, CSV) may be split across tasks: a row is
      placed by its split's byte offset (``_metadata.file_block_start``) and
      its index within the task (rows of one split are read contiguously, in
      file order); key ``rank * 10^25 + block_start * 10^10 + row_in_task`` --
      exact for any split size or file packing.
    """
    dec = "decimal(38,0)"
    with_meta = df.withColumn("__file", F.col("_metadata.file_path"))
    if parquet:
        pos = F.col("_metadata.row_index").cast(dec)
        scale = _decimal_power(ROW_INDEX_DIGITS)
    else:
        row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        pos = F.col("_metadata.file_block_start").cast(dec) * _decimal_power(TASK_ROW_DIGITS) + row_in_task.cast(dec)
        scale = _decimal_power(OFFSET_DIGITS + TASK_ROW_DIGITS)
    with_meta = with_meta.withColumn("__pos", pos)
    return _with_file_rank(with_meta, path, scale, col)


def _with_file_rank(df: DataFrame, path: str | list[str], scale, col: str) -> DataFrame:
    """``col``: the rank of ``__file`` in the listing of ``path`` times ``scale``, plus ``__pos``."""
    # the two listings may spell a path's scheme differently (file:/ and file:///)
    spelled = lambda c: F.regexp_replace(c, "^file:/+", "file:///")
    ranked = _file_ranks(_listing(df.sparkSession, path).select(spelled("__file").alias("__file")))
    out = df.withColumn("__file", spelled("__file")).join(ranked, "__file", "inner")
    dec = "decimal(38,0)"
    key = (F.col("__rank").cast(dec) * scale + F.col("__pos")).cast(dec)
    return out.withColumn(col, key).drop("__file", "__pos", "__rank")
