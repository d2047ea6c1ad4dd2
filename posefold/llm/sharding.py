"""Sharding by sampled splitters, in DataFrame functions only.

1. Keys are drawn with a chance in proportion to their rows' sizes; quantiles of the sample split the
   key space into ranges of about equal bytes.
2. Ranges that hold too many rows or bytes are subdivided by a hash of the row, so that a key with any
   share of the rows is dealt over many parts.
3. Totals of the parts, one line each, give every part its place; a running sum inside the part gives
   every row its own. The shard is the row's place in bytes over the size of a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from posefold.llm.common import stage, text_or_empty
from posefold.operators.scale import lookup_join

RANGES_PER_SHARD = 4
SAMPLES_PER_RANGE = 200
PART_ROWS = 50_000
WHOLE_GROUP_SHARE = 0.002
ROW_BYTES = 16


def _unit(*columns: Column) -> Column:
    """A number in [0, 1) that the columns fix."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def shard_by_bytes(
    documents: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_rows: int = PART_ROWS,
    whole_group_share: float = WHOLE_GROUP_SHARE,
) -> DataFrame:
    """One row per document: ``id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: shards hold near equal sums of ``size`` (UTF-8 bytes and 16 a row). The key
    is a hash of the text, so equal texts lie together; a group of them goes whole into one shard
    unless it is larger than ``whole_group_share`` of a shard or its range is subdivided. A null text
    has no bytes and the checksum of an empty one; null ids and repeated rows are placed like any
    row; an empty table gives no rows; fewer rows than shards leave shards empty. Other columns are
    not looked at, whatever their names.
    """
    body = text_or_empty(text_column)
    measured = documents.select(
        F.col(id_column).alias("id"),
        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body).cast("bigint").alias("text_crc32"),
        F.xxhash64(body).alias("key"),
    )
    rows = stage(measured, "sizes").withColumn("draw", _unit(F.lit("draw"), "key", "id"))
    spread = F.xxhash64(F.lit("part"), "id", "key")
    ranges = shards * RANGES_PER_SHARD

    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    drawn = rows.where(F.col("draw") * F.lit(float(total["bytes"])) < F.col("size") * F.lit(float(ranges * SAMPLES_PER_RANGE)))
    steps = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    splitters = drawn.agg(F.percentile_approx("key", steps, F.lit(10_000)).alias("s")).first()["s"] or []
    bounds = F.array(*(F.lit(key) for key in sorted(set(splitters))))
    ranged = rows.withColumn(
        "range", F.size(F.filter(bounds, lambda bound: bound <= F.col("key"))) if splitters else F.lit(0)
    )

    # One line a range: how many parts it is subdivided into.
    most = max(1.0, 2.0 * total["bytes"] / ranges)
    loads = ranged.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    cuts = loads.select(
        "range",
        F.greatest(
            F.ceil(F.col("n") / part_rows), F.when(F.col("b") > most, F.ceil(2 * F.col("b") / most)).otherwise(1)
        ).cast("bigint").alias("parts"),
    )
    parted = lookup_join(ranged, cuts, ["range"], how="inner", derived=True).select(
        "id", "size", "text_crc32", "key", "range", F.pmod(spread, "parts").alias("part"), "parts"
    )
    parted = stage(parted, "parts")

    # One line a part: bytes and rows before it.
    sums = parted.groupBy("range", "part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    per_range = sums.groupBy("range").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # bounded by ``ranges``
    range_base = per_range.select(
        "range",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("rb"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rn"),
    )
    inside = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.join(range_base, "range").select(
        "range",
        "part",
        (F.col("rb") + F.coalesce(F.sum("b").over(inside), F.lit(0))).alias("part_bytes"),
        (F.col("rn") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("part_rows"),
    )
    based = lookup_join(parted, bases, ["range", "part"], how="inner", derived=True)

    order = ["key", "id", "size", "text_crc32"]
    running = Window.partitionBy("range", "part").orderBy(*order)
    same = Window.partitionBy("range", "part", "key")
    share = max(1.0, total["bytes"] / shards)
    placed = based.select(
        "id", "size", "text_crc32", "key", "range", "part", "parts",
        (F.col("part_bytes") + F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("at"),
        (F.col("part_rows") + F.row_number().over(running) - 1).alias("rank"),
    )
    group_bytes, group_at = F.sum("size").over(same), F.min("at").over(same)
    whole = (F.col("parts") == 1) & (group_bytes <= whole_group_share * share)
    middle = F.when(whole, group_at + group_bytes / 2).otherwise(F.col("at") + F.col("size") / 2)
    sharded = placed.select(
        "id", "size", "text_crc32", "rank",
        F.least(F.floor(middle / F.lit(share)), F.lit(shards - 1)).cast("int").alias("shard"),
    )
    sharded = stage(sharded, "shards")
    firsts = sharded.groupBy("shard").agg(F.min("rank").alias("first"))  # at most ``shards`` lines
    return sharded.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
