"""Reading and writing bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import BAR_TS_FORMAT, BARS, COLUMN_ALIASES, CORE_COLUMNS

CORE_TYPES = {f.name: f.dataType for f in BARS}

# column position of each field in files without a header
POSITIONS = {f.name: i for i, f in enumerate(BARS)}


def normalize_bar_columns(df: DataFrame) -> DataFrame:
    """Map known spellings to the core columns and make sure there is an ``oi`` column.

    Names are mapped only when a core column is missing.  ``openinterest`` replaces ``oi``; without either it is 0.
    """
    if any(c not in df.columns for c in CORE_COLUMNS):
        df = df.withColumnsRenamed({a: b for a, b in COLUMN_ALIASES.items() if a in df.columns})
        missing = [c for c in CORE_COLUMNS if c not in df.columns]
        if missing:
            raise ValueError(f"missing required columns: {missing}")
    if "openinterest" in df.columns:
        return df.withColumn("oi", F.col("openinterest"))
    if "oi" not in df.columns:
        return df.withColumn("oi", F.lit(0).cast("bigint"))
    return df


def _typed(df: DataFrame, ts_format: str, extra_types: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    def column(name: str):
        c = F.col(f"`{name}`")
        if name == "ts":
            return F.to_timestamp_ntz(c, F.lit(ts_format)).alias(name)
        if name in keep:
            return c
        if name in CORE_TYPES:
            return c.cast(CORE_TYPES[name]).alias(name)
        if name == "openinterest":
            return c.cast("bigint").alias(name)
        return c.cast(extra_types.get(name, "double")).alias(name)

    return df.select(*[column(n) for n in df.columns])


def read_bars_csv(
    spark: SparkSession,
    paths: str | list[str],
    ts_format: str = BAR_TS_FORMAT,
    extra_types: dict[str, str] | None = None,
    with_file: bool = False,
    **options,
) -> DataFrame:
    """CSV files with a header; the first column is the time. A value that does not parse is an error.

    Every file's columns go by its own header: files may differ in their order and in columns beyond the core ones, which are
    NULL where a file lacks them.  These are kept as double unless ``extra_types`` says otherwise.  No inference
    pass: only the first line of each file is looked at, and the values are read once, by the query itself.
    """
    raw = spark.read.options(header=True, mode="FAILFAST", **options).csv(paths)
    by_header: dict[str, list[str]] = {}
    for file in raw.inputFiles():
        by_header.setdefault(_first_line(spark, file), []).append(file)
    if len(by_header) <= 1:
        return _named_bars(raw, ts_format, extra_types or {}, with_file)
    if isinstance(paths, str) and str(options.get("recursiveFileLookup", "")).lower() != "true":
        options = {"basePath": paths, **options}  # columns that folders stand for
    out = None
    for files in by_header.values():
        part = spark.read.options(header=True, mode="FAILFAST", **options).csv(files)
        part = _named_bars(part, ts_format, extra_types or {}, with_file)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _first_line(spark: SparkSession, file: str) -> str:
    """The header of a file, read through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    plain = stream if codec is None else codec.createInputStream(stream)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def _named_bars(raw: DataFrame, ts_format: str, extra_types: dict[str, str], with_file: bool) -> DataFrame:
    first = raw.columns[0]
    keep = []
    if with_file:
        raw = raw.select("*", F.col("_metadata.file_path").alias("file_path"),
                         F.col("_metadata.file_name").alias("file_name"))
        keep = ["file_path", "file_name"]
    named = raw.withColumnRenamed(first, "ts")
    return normalize_bar_columns(_typed(_renamed(named), ts_format, extra_types, keep))


def _renamed(df: DataFrame) -> DataFrame:
    """Known spellings first, so that the core types apply to them."""
    if any(c not in df.columns for c in CORE_COLUMNS):
        return df.withColumnsRenamed({a: b for a, b in COLUMN_ALIASES.items() if a in df.columns})
    return df


def read_bars_positional(
    spark: SparkSession,
    paths: str | list[str],
    positions: dict[str, int] | None = None,
    ts_format: str = BAR_TS_FORMAT,
    header: bool = False,
    **options,
) -> DataFrame:
    """CSV files read by column position; ``positions`` overrides single positions, a negative one means absent."""
    at = {**POSITIONS, **(positions or {})}
    raw = spark.read.options(header=header, mode="FAILFAST", **options).csv(paths)
    raw = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    present = {n: i for n, i in at.items() if 0 <= i < len(raw.columns)}
    return normalize_bar_columns(_typed(raw.select(*[F.col(f"c{i}").alias(n) for n, i in present.items()]), ts_format, {}))


def read_bars_directory(
    spark: SparkSession,
    path: str,
    names: DataFrame | None = None,
    ts_format: str = BAR_TS_FORMAT,
    extra_types: dict[str, str] | None = None,
    **options,
) -> DataFrame:
    """All files of a directory as one table with an ``instrument`` column.

    ``names(file_name, instrument)`` maps files to instruments, or ``names(file_path, instrument)`` where folders hold
    files of the same name.  Files it lacks, and all files without it, go by their name up to the first dot.
    """
    bars = read_bars_csv(spark, path, ts_format, extra_types, with_file=True, **options)
    stem = F.regexp_extract("file_name", r"^([^.]*)", 1)
    if names is None:
        return bars.withColumn("instrument", stem).drop("file_path", "file_name")
    by = "file_path" if "file_path" in names.columns else "file_name"
    given = names.select(by, F.col("instrument").alias("__named"))
    mapped = bars.join(given, by, "left")
    instrument = F.coalesce(F.col("__named").cast("string"), stem)
    return mapped.withColumn("instrument", instrument).drop("file_path", "file_name", "__named")


def write_bars(
    df: DataFrame, path: str, fmt: str = "parquet", by_day: bool = True, ts: str = "ts", mode: str = "errorifexists"
) -> None:
    """Write bars with a header (CSV) or as parquet, one folder per trading day so that date ranges prune files.

    Rows are dealt by day first, so a day gets a file or two and not one from every task; Spark splits a day that holds
    more than its advised partition size among several tasks.
    """
    if fmt == "csv":
        # the reading side expects the time first
        first = [ts, *[c for c in df.columns if c != ts]]
        df = df.select(*first).withColumn(ts, F.date_format(ts, BAR_TS_FORMAT))
        day = F.to_date(F.substring(ts, 1, 10))
    else:
        day = F.to_date(ts)
    writer = df.withColumn("trading_day", day).hint("rebalance", "trading_day") if by_day else df
    out = writer.write.mode(mode).format(fmt)
    if fmt == "csv":
        out = out.option("header", True)
    (out.partitionBy("trading_day") if by_day else out).save(path)
