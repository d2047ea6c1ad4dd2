"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every scan partition sorts the short fingerprints of its texts by owner and stages them as
   Golomb-Rice blocks, about ten bits a document. Within a block a fingerprint is sent once, so a
   group of copies of any size sends one value a block.
2. Each owner decodes the blocks of its range and answers every block with a bitmap of the
   fingerprints that some other block has too.
3. Blocks turn their bitmaps (and what they hold twice themselves) into suspect fingerprints. Only
   documents with one of these are shuffled, whole, and compared by their bytes.

A fingerprint shared by chance makes a suspect that the last step clears; equal texts always meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.llm import rice
from posefold.llm.common import stage, text_or_empty, without

OWNER_VALUES = 1 << 19
BLOCK_VALUES = 1 << 20
BROADCAST_SUSPECTS = 500_000
_BLOCK = "part int, flush int, owner int, n int, low_bits int, unary binary, low binary, twice binary"
_KEY = ["part", "flush", "owner"]


def normalised(column: str = "text") -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return as one space."""
    # A single space is left as it is; it would only be replaced by itself.
    return F.regexp_replace(
        text_or_empty(column), "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+", " "
    )


def fingerprint(text: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def fingerprint_bits(rows: int) -> int:
    """Bits at which a chance match of a document with any other has a probability of about 1/256."""
    return min(60, max(16, rows.bit_length() + 8))


def _blocks(bits: int, owner_bits: int):
    width = bits - owner_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, flush, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def coded() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(values, np.arange((1 << owner_bits) + 1, dtype=np.int64) << width)
            out = []
            for owner in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[owner], edges[owner + 1])
                local = values[own] - (owner << width)
                low_bits = rice.parameter(1 << width, len(local))
                unary, low = rice.encode(local, low_bits)
                twice = np.packbits(counts[own] > 1).tobytes()
                out.append((part, flush, owner, len(local), low_bits, unary, low, twice))
            kinds = [pa.int32()] * 5 + [pa.binary()] * 3
            names = [field.split()[0] for field in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names
            )

        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += batch.num_rows
            if rows >= BLOCK_VALUES:
                yield coded()
                flush, held, rows = flush + 1, [], 0
        if rows:
            yield coded()

    return run


def _answer(blocks: pd.DataFrame) -> pd.DataFrame:
    """One owner: for every block a bitmap of the values that another block has as well."""
    values = [
        rice.decode(unary, low, low_bits, n)
        for unary, low, low_bits, n in zip(blocks.unary, blocks.low, blocks.low_bits, blocks.n)
    ]
    _, place, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = np.split(counts[place] > 1, np.cumsum([len(v) for v in values])[:-1])
    return blocks[_KEY].assign(shared=[np.packbits(bits).tobytes() for bits in shared])


def _suspects(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bits = np.frombuffer(row["shared"], np.uint8) | np.frombuffer(row["twice"], np.uint8)
                marked = np.unpackbits(bits)[: row["n"]].astype(bool)
                values = rice.decode(row["unary"], row["low"], row["low_bits"], row["n"])[marked]
                yield pa.RecordBatch.from_arrays([pa.array(values + (row["owner"] << width))], ["fp"])

    return run


def suspect_fingerprints(fingerprints: DataFrame, rows: int, bits: int) -> DataFrame:
    """Distinct values of ``fp`` that more than one row has, by the exchange."""
    owner_bits = min(bits - 8, max(4, (rows // OWNER_VALUES).bit_length()))
    blocks = stage(fingerprints.mapInArrow(_blocks(bits, owner_bits), _BLOCK), "fingerprint-blocks")
    answers = (
        blocks.drop("twice")
        .groupBy("owner")
        .applyInPandas(_answer, "part int, flush int, owner int, shared binary")
    )
    marked = blocks.join(answers, _KEY).mapInArrow(_suspects(bits - owner_bits), "fp bigint")
    return stage(marked.distinct(), "suspects")


def dedup_exact(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document, dropped ones too: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if their bytes are after white-space runs became one space; null counts as
    empty. Of equal texts the smallest id stays; of rows that repeat it, one. Null ids count as
    largest: such a row stays only where all ids of its group are null (``keep_id`` is null then).
    Ids are integers; other columns are not looked at, whatever their names. An empty table gives
    an empty result.
    """
    source = documents.select(F.col(id_column).cast("bigint").alias("id"), normalised(text_column).alias("body"))
    total = documents.count()
    bits = fingerprint_bits(total)
    found = suspect_fingerprints(source.select(fingerprint(F.col("body"), bits).alias("fp")), total, bits)
    found = found.withColumn("suspect", F.lit(True))
    if found.limit(BROADCAST_SUSPECTS + 1).count() <= BROADCAST_SUSPECTS:
        found = F.broadcast(found)  # eight bytes each, counted
    marked = (
        source.withColumn("fp", fingerprint(F.col("body"), bits))
        .join(found, "fp", "left")
        .select(
            F.monotonically_increasing_id().alias("tag"),
            "id",
            F.sha2("body", 256).alias("text_sha256"),
            F.when(F.col("suspect"), F.col("body")).alias("body"),
        )
    )
    rows = stage(marked, "marked-rows")
    # The order of (id, tag) as one number, which partial aggregation can hold.
    tags = F.lit(str(1 << 63)).cast("decimal(19,0)")
    place = F.col("id").cast("decimal(19,0)") * tags + F.col("tag")
    groups = (
        rows.where("body IS NOT NULL")
        .withColumn("place", place.cast("decimal(38,0)"))
        .groupBy("body")
        .agg(
            F.min("text_sha256").alias("text_sha256"),
            F.min("id").alias("keep_id"),
            F.count("*").alias("group_size"),
            F.min("place").alias("place"),
            F.min("tag").alias("tag"),
        )
        .select(
            "text_sha256",
            "keep_id",
            "group_size",
            F.coalesce(
                (F.col("place") - F.col("keep_id").cast("decimal(19,0)") * tags).cast("bigint"),
                "tag",
            ).alias("keep_tag"),
        )
    )
    compared = (
        rows.where("body IS NOT NULL")
        .drop("body")
        .join(groups, "text_sha256")
        .select("id", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"), "text_sha256")
    )
    single = rows.where("body IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return single.unionByName(compared).withColumnRenamed("id", id_column)


def unique_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that ``dedup_exact`` keeps; of rows that repeat id and text, one."""
    columns = documents.columns
    verdicts = (
        dedup_exact(documents, id_column, text_column)
        .groupBy(F.col(id_column).alias("_id"), F.col("text_sha256").alias("_sha"))
        .agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
        .where("n > 1 OR NOT stays")
    )
    verdicts = stage(verdicts, "verdicts")
    keyed = documents.withColumns(
        {"_id": F.col(id_column).cast("bigint"), "_sha": F.sha2(normalised(text_column), 256)}
    )
    once = without(keyed, verdicts, ["_id", "_sha"]).select(*columns)
    repeated = verdicts.where("stays").select("_id", "_sha")
    if repeated.limit(1).count() == 0:
        return once
    again = keyed.join(
        repeated.select(F.col("_id").alias("_i"), F.col("_sha").alias("_s")),
        F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_sha") == F.col("_s")),
        "left_semi",
    )
    one = again.groupBy("_id", "_sha").agg(F.first(F.struct(*columns)).alias("row")).select("row.*")
    return once.unionByName(one)
