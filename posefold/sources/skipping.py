"""Which message files a scan must open, told from a small table about each of them.

Parquet's own statistics are looked at file by file, after each was opened, and a file that holds a hundred
topics spans any one of them. This table knows the target topics that a file really holds and the range of
its times and sources, so that a scan opens the files that can matter and no other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.sources.messages import normalise_messages

_FILE = ("file_uri", "file_bytes", "file_time")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """Every data file under ``path`` as it is now. Names, sizes and times only: content is pruned."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(path).select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("file_uri"),
        F.col("length").alias("file_bytes"),
        F.col("modificationTime").alias("file_time"),
    )


def describe_files(messages: DataFrame) -> DataFrame:
    """One line per file behind ``messages``: rows, its target topics with the range of times of each, whether
    other rows must be seen too, and its ranges of times and sources. Reads narrow columns, with map-side partial
    aggregates."""

    def seen(topic: str) -> Column:
        here = F.col("topic") == topic
        first, last = (f(F.when(here, F.col("log_time_ns"))) for f in (F.min, F.max))
        held = F.struct(F.lit(topic).alias("topic"), first.alias("first_time"), last.alias("last_time"))
        return F.when(F.count_if(here) > 0, held)

    return messages.groupBy(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///").alias("file_uri"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array_compact(F.array(*map(seen, C.ARM_TOPICS))).alias("topics"),
        F.count_if(F.col("topic").isNull() | F.col("decode_error").isNotNull()).alias("unusable"),
        F.min("log_time_ns").alias("first_time"),
        F.max("log_time_ns").alias("last_time"),
        F.min("source_uri").alias("first_source"),
        F.max("source_uri").alias("last_source"),
    )


def read_index(spark: SparkSession, index: str) -> DataFrame | None:
    try:
        return spark.read.parquet(index)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def index_files(spark: SparkSession, path: str, index: str) -> int:
    """Describe the files under ``path`` that ``index`` does not know as they are, and add them to it.

    Only those are read, so a grown folder costs what it grew by. Returns how many were described.
    """
    known = read_index(spark, index)
    files = _listed(spark, path)
    fresh = files if known is None else files.join(known.select(*_FILE), list(_FILE), "left_anti")
    names = [r["file_uri"] for r in fresh.select("file_uri").collect()]  # a listing, as the scan's own
    if names:
        describe_files(spark.read.parquet(*names)).write.mode("append").parquet(index)
    return len(names)


def needed_files(
    spark: SparkSession,
    path: str,
    index: str,
    topics: tuple[str, ...] = tuple(C.ARM_TOPICS),
    since_ns: int | None = None,
    until_ns: int | None = None,
    source_uri: str | None = None,
) -> DataFrame:
    """``file_uri`` of the files under ``path`` that may hold a wanted row, and of those the index does not know.

    ``since_ns`` and ``until_ns`` bound times, the latter excluded. A file with unusable rows is always needed,
    unless times or a source exclude it: such rows have to be counted.
    """
    files = _listed(spark, path)
    known = read_index(spark, index)
    if known is None:
        return files.select("file_uri")

    def inside(line) -> Column:
        within = F.lit(True)
        if since_ns is not None:
            within = within & _or_unknown(line["last_time"] >= F.lit(str(since_ns)).cast("decimal(20,0)"))
        if until_ns is not None:
            within = within & _or_unknown(line["first_time"] < F.lit(str(until_ns)).cast("decimal(20,0)"))
        return within

    whole = {"first_time": F.col("first_time"), "last_time": F.col("last_time")}
    wanted = F.exists("topics", lambda t: t["topic"].isin(*topics) & inside(t)) | ((F.col("unusable") > 0) & inside(whole))
    if source_uri is not None:
        wanted = wanted & _or_unknown(F.lit(source_uri).between(F.col("first_source"), F.col("last_source")))
    useless = known.where(~wanted).select(*_FILE)
    return files.join(useless, list(_FILE), "left_anti").select("file_uri")


def _or_unknown(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def read_needed(
    spark: SparkSession,
    path: str,
    index: str,
    topics: tuple[str, ...] = tuple(C.ARM_TOPICS),
    since_ns: int | None = None,
    until_ns: int | None = None,
    source_uri: str | None = None,
) -> DataFrame:
    """The rows of :func:`read_arm_messages` on these topics, times and source, from the files that may hold any."""
    chosen = needed_files(spark, path, index, topics, since_ns, until_ns, source_uri)
    names = [r["file_uri"] for r in chosen.collect()]  # the scan's own list of files
    if not names:
        return spark.createDataFrame([], C.ARM_MESSAGES)
    rows = normalise_messages(spark.read.parquet(*names))
    unusable = F.col("topic").isNull() | F.col("decode_error").isNotNull()
    rows = rows.where(F.col("topic").isin(*topics) | unusable)
    if since_ns is not None:
        rows = rows.where(F.col("log_time_ns") >= F.lit(str(since_ns)).cast("decimal(20,0)"))
    if until_ns is not None:
        rows = rows.where(F.col("log_time_ns") < F.lit(str(until_ns)).cast("decimal(20,0)"))
    return rows if source_uri is None else rows.where(F.col("source_uri") == source_uri)
