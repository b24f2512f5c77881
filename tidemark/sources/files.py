"""What bar files there are and what they hold."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import BAR_TS_FORMAT

FILE_NAMES = T.StructType([T.StructField("file_name", T.StringType())])


def list_bar_files(spark: SparkSession, path: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """Sorted names of the files matching a glob; no rows when the directory is missing. Contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        files = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_NAMES)
    return files.select(F.col("_metadata.file_name").alias("file_name")).orderBy("file_name")


def bar_file_profile(spark: SparkSession, path: str, ts_format: str = BAR_TS_FORMAT, **options) -> DataFrame:
    """Per file: size, modification time, records, first and last time, column names, and a content error if any.

    The time is the first column.  A value there that does not parse is reported as ``error``, not raised.
    """
    lines = spark.read.options(**options).text(path)
    at = F.try_to_timestamp(F.split_part("value", F.lit(","), F.lit(1)), F.lit(ts_format)).cast("timestamp_ntz")
    # the header is the line without a time that comes first in its file
    d = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
        at.alias("at"),
    ).filter(F.length("value") > 0)
    untimed = F.col("at").isNull()
    profile = d.groupBy("file_path").agg(
        F.first("size").alias("size"),
        F.first("modified").alias("modified"),
        F.count_if(~untimed).alias("records"),
        F.min("at").alias("min_ts"),
        F.max("at").alias("max_ts"),
        F.min_by("value", F.when(untimed, F.struct("block", "line"))).alias("header"),
        F.count_if(untimed).alias("__untimed"),
    )
    bad = F.col("__untimed") - F.when(F.col("header").isNotNull(), 1).otherwise(0)
    return profile.select(
        "file_path",
        "size",
        "modified",
        "records",
        "min_ts",
        "max_ts",
        F.split("header", ",").alias("columns"),
        F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" lines without a valid time"))).alias("error"),
    )
