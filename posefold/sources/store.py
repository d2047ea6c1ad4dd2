"""A message table laid out so that recovery never moves a payload.

Rows are bucketed by source and slab of time and sorted inside each bucket in reader order. A slab bounds
what one source puts into one bucket, so a source that holds a third of all rows lies in many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLAB = "slab"
LAYOUT = ("source_uri", SLAB)
ORDER = ("log_time_ns", "topic", "sequence")
#: Nanoseconds of one source in one bucket: ten minutes.
SLAB_NS = 600_000_000_000


def slab_of(slab_ns: int) -> Column:
    return F.floor(F.coalesce(F.col("log_time_ns"), F.lit(-1)).cast("decimal(20,0)") / F.lit(slab_ns)).cast("bigint")


def store_messages(messages: DataFrame, table: str, path: str, buckets: int, slab_ns: int = SLAB_NS) -> DataFrame:
    """Write ``messages`` under ``path`` as the bucketed table ``table`` and read it back.

    The one shuffle of the payload is this one, at ingestion. ``buckets`` should be at least the number of
    cores that will read, and ``spark.sql.shuffle.partitions`` not above it, so that joins take the table's layout.
    """
    rows = messages.withColumn(SLAB, slab_of(slab_ns))
    writer = rows.repartition(buckets, *LAYOUT).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *LAYOUT).sortBy(*LAYOUT, *ORDER).saveAsTable(table)
    return read_store(messages.sparkSession, table)


def read_store(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def is_store(messages: DataFrame) -> bool:
    return SLAB in messages.columns
