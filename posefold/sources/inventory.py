"""Scans of file inventories and sample lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold.functions.text import hex_digest, is_episode_path

TREE = "type string, path string, size bigint, oid string, lfs struct<oid: string, size: bigint>"
SAMPLES = (
    "samples array<struct<filepath: string, split: string, task: string, episode_id: string,"
    " n_messages: bigint, station: string, duration_s: double, source_fps: double,"
    " reencoded_to_30fps: boolean>>"
)


def read_inventory(spark: SparkSession, path: str, suffix: str = ".mcap") -> DataFrame:
    """Entries of a tree listing (one JSON list) whose path has the wanted suffix, as listed."""
    tree = spark.read.schema(TREE).json(path, multiLine=True)
    return tree.where(F.endswith("path", F.lit(suffix)))


def tree_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the listing."""
    return spark.read.schema(TREE).json(path, multiLine=True)


def read_inventory_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a tab-separated inventory, in the same nested shape as a tree listing."""
    schema = (
        "path string, size_bytes bigint, git_blob_oid string, lfs_sha256 string, lfs_size_bytes bigint"
    )
    table = spark.read.csv(path, schema=schema, sep="\t", header=True)
    return table.select(
        F.lit("file").alias("type"),
        "path",
        F.col("size_bytes").alias("size"),
        F.col("git_blob_oid").alias("oid"),
        F.struct(F.col("lfs_sha256").alias("oid"), F.col("lfs_size_bytes").alias("size")).alias("lfs"),
    )


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ``samples`` list; an object without that list gives one all-null row."""
    table = spark.read.schema(SAMPLES).json(path, multiLine=True)
    return table.select(F.inline_outer("samples"))


def normalise_inventory(entries: DataFrame) -> DataFrame:
    """Flat ``inventory`` rows plus ``entry_ok``: a file on an allowed path, positive equal sizes,
    and both digests of the right length."""
    flat = entries.select(
        "path",
        "size",
        hex_digest("oid", 40).alias("oid"),
        hex_digest("lfs.oid", 64).alias("lfs_oid"),
        F.col("lfs.size").alias("lfs_size"),
        (F.col("type") == "file").alias("_is_file"),
    )
    ok = (
        F.col("_is_file")
        & is_episode_path("path")
        & (F.col("size") >= 1)
        & (F.col("size") == F.col("lfs_size"))
        & F.col("oid").isNotNull()
        & F.col("lfs_oid").isNotNull()
    )
    return flat.withColumn("entry_ok", F.coalesce(ok, F.lit(False))).drop("_is_file")
