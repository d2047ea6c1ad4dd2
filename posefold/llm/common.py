"""What the operators share: reading, staging, and links to classes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold.operators.scale import cut_lineage

SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe from lost executors."""
    return cut_lineage(df, label)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches (64 MB each at most) in short runs, so that Python objects of few rows live."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (``a``, ``b``): the smallest node reachable.

    Alternates large-star and small-star rounds over staged edge tables until nothing changes. A
    round is two partial-aggregated groupings and joins whose hot keys Spark splits at run time; the
    driver sees one count and one sum a round. Null ends and loops are ignored; an empty table gives
    an empty result.
    """
    pairs = edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    pairs = stage(pairs, f"{label}-edges")
    seen = None
    while True:
        now = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if (now["n"], now["s"]) == seen or not now["n"]:
            break
        seen = (now["n"], now["s"])
        both = pairs.unionByName(pairs.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = (
            both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        )
        large = stage(large, f"{label}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.selectExpr("v AS u", "m AS v").where("u <> v").unionByName(least.selectExpr("u", "m AS v"))
        )
        pairs = stage(small.distinct(), f"{label}-small")
    nodes = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = nodes.select(F.col("component").alias("node")).distinct()
    return nodes.unionByName(roots.selectExpr("node", "node AS component"))


BROADCAST_KEYS = 500_000


def without(documents: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``documents`` whose ``keys`` (nulls are equal) are not in ``dropped``.

    The dropped keys are staged and counted; few are sent to every task, many meet the rows in a shuffle.
    """
    gone = stage(dropped.select(*(F.col(k).alias(f"_gone_{k}") for k in keys)).distinct(), "dropped")
    if gone.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    return documents.join(gone, [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys], "left_anti")


def filtered(documents: DataFrame, text_column: str, keep) -> DataFrame:
    """Whole rows of ``documents`` for whose texts (null as empty) ``keep(texts)`` gives a true flag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [text or "" for text in batch.column(text_column).to_pylist()]
            yield batch.filter(pa.array(keep(texts), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
