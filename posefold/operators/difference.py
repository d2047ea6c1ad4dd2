"""Reconciliation by difference: what crosses the network grows with what differs, not with the tables.

Both tables are cut into ranges of consecutive keys. A count and a hash sum per range settle ranges that are
equal. For the others both sides are folded, with opposite signs, into one invertible Bloom lookup table per
range: every row goes to three cells that keep signed counts and XORs, in which equal rows cancel. Cells
left with one row give it away, and removing it uncovers others. A range whose table does not come apart is
tried with a larger one, and in the end compared row by row, as are all rows with the keys that were found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.operators.augment import key_integrity
from posefold.operators.scale import cut_lineage, lookup_join

#: Keys of one range, and cells of the tables that are tried in turn; a table comes apart up to some 0.7 rows a cell.
RANGE_ROWS = 1 << 16
SIZES = (48, 768, 12_288)
SPREAD = 3
SEED = 42
_BYTES = 8
_FOUND = "source_uri string, block bigint, source_row bigint"


@dataclass(frozen=True)
class Exchange:
    """What was exchanged: ranges and how many differ, cells, found keys, ranges and rows compared in full, bytes.

    ``bytes`` counts eight for every number of a range line or cell, and the keys and values of rows compared in
    full; ``bytes_in_full`` is the same count for comparing every row."""

    ranges: int
    differing: int
    cells: int
    keys: int
    undecoded: int
    rows_in_full: int
    bytes: int
    bytes_in_full: int


def _hash(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(int(value).to_bytes(8, "little", signed=True), seed)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def cells_of(row_hash: int, size: int) -> list[int]:
    """The cell of each third of the table that a row goes to."""
    third = size // SPREAD
    return [i * third + _signed(_hash(i, _hash(row_hash, SEED))) % third for i in range(SPREAD)]


def check_of(key: int, row_hash: int) -> int:
    return _signed(_hash(row_hash, _hash(key, SEED)))


def peel(cell: np.ndarray, count: np.ndarray, key: np.ndarray, row: np.ndarray, check: np.ndarray, size: int) -> list[int] | None:
    """Keys of all rows left in a table; none if it does not come apart."""
    table = {c: [int(n), int(k), int(r), int(x)] for c, n, k, r, x in zip(cell.tolist(), count, key, row, check)}
    found, ready = [], list(table)
    while ready:
        n, k, r, x = table.get(ready.pop(), (0, 0, 0, 0))
        if abs(n) != 1 or check_of(k, r) != x:
            continue
        found.append(k)
        if len(found) > 4 * size:
            return None
        for at in cells_of(r, size):
            held = table.setdefault(at, [0, 0, 0, 0])
            held[0] -= n
            held[1] ^= k
            held[2] ^= r
            held[3] ^= x
            ready.append(at)
    return None if any(any(held) for held in table.values()) else found


def _side(df: DataFrame, values: list[str], sign: int, range_rows: int) -> DataFrame:
    return df.select(
        "source_uri",
        F.floor(F.col("source_row") / F.lit(range_rows)).cast("bigint").alias("block"),
        "source_row",
        F.xxhash64("source_row", *values).alias("row_hash"),
        F.lit(sign).alias("sign"),
    )


def _digests(rows: DataFrame) -> DataFrame:
    """Per range, rows of either side and whether their hash sums agree."""
    total = F.sum(F.col("sign") * F.col("row_hash").cast("decimal(38,0)"))
    return rows.groupBy("source_uri", "block").agg(
        F.count_if(F.col("sign") > 0).alias("left_rows"),
        F.count_if(F.col("sign") < 0).alias("right_rows"),
        (total == 0).alias("agrees"),
    )


def _tables(rows: DataFrame, size: int) -> DataFrame:
    """The non-empty cells of every range's table; equal rows have cancelled in the partial sums."""
    third = size // SPREAD
    places = F.array(
        *(F.lit(i * third) + F.pmod(F.xxhash64("row_hash", F.lit(i).cast("bigint")), F.lit(third)) for i in range(SPREAD))
    )
    each = rows.withColumn("check", F.xxhash64("source_row", "row_hash")).withColumn("cell", F.explode(places))
    return (
        each.groupBy("source_uri", "block", "cell")
        .agg(
            F.sum("sign").alias("n"),
            F.bit_xor("source_row").alias("key"),
            F.bit_xor("row_hash").alias("row"),
            F.bit_xor("check").alias("check"),
        )
        .where("n <> 0 OR key <> 0 OR row <> 0 OR check <> 0")
    )


def _decoded(tables: DataFrame, size: int) -> DataFrame:
    """Found keys, and one line with a null key for every range that did not come apart."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = peel(pdf["cell"], pdf["n"], pdf["key"], pdf["row"], pdf["check"], size)
        frame = pd.DataFrame({"source_row": pd.array([None] if keys is None else keys, dtype="Int64")})
        return frame.assign(source_uri=pdf["source_uri"].iloc[0], block=pdf["block"].iloc[0])[["source_uri", "block", "source_row"]]

    return tables.groupBy("source_uri", "block").applyInPandas(run, _FOUND)


def integrity_by_difference(
    source: DataFrame,
    sidecar: DataFrame,
    values: list[str],
    range_rows: int = RANGE_ROWS,
    sizes: tuple[int, ...] = SIZES,
) -> tuple[DataFrame, Exchange]:
    """The rows of ``key_integrity`` and what was exchanged to get them.

    A key is ``source_uri, source_row``; keys of ``source`` are unique, as positions in files are, and none is
    null. Only ranges that differ are folded into tables, only rows with found keys or in ranges that do not
    come apart are compared in full, so the result is that of comparing everything. Rows are equal if their
    64-bit hashes over key and values are.
    """
    both = _side(source, values, 1, range_rows).unionByName(_side(sidecar, values, -1, range_rows))
    digests = cut_lineage(_digests(both), "ranges")
    unequal = F.expr("NOT agrees OR left_rows <> right_rows")
    counts = digests.agg(F.count(F.lit(1)).alias("n"), F.count_if(unequal).alias("differing"), F.sum(F.col("left_rows") + F.col("right_rows")).alias("rows")).first()
    todo = digests.where(unequal).select("source_uri", "block")
    cells, found = 0, None
    for size in sizes:
        if todo.isEmpty():
            break
        tables = cut_lineage(_tables(lookup_join(both, todo, ["source_uri", "block"], how="inner"), size), "cells")
        cells += tables.count()
        decoded = cut_lineage(_decoded(tables, size), "decoded")
        keys = decoded.where("source_row IS NOT NULL")
        found = keys if found is None else found.unionByName(keys)
        # A range without any cell has equal rows after all.
        todo = decoded.where("source_row IS NULL").select("source_uri", "block")
    undecoded = todo.count()
    schema = both.select("source_uri", "block", "source_row").schema
    found = cut_lineage((found if found is not None else both.sparkSession.createDataFrame([], schema)).distinct(), "keys")
    keys = found.count()

    def chosen(df: DataFrame) -> DataFrame:
        rows = df.withColumn("block", F.floor(F.col("source_row") / F.lit(range_rows)).cast("bigint"))
        named = lookup_join(rows, found.select("source_uri", "source_row"), ["source_uri", "source_row"], how="inner")
        if not undecoded:
            return named.drop("block")
        whole = lookup_join(rows, todo, ["source_uri", "block"], how="inner")
        return whole.unionByName(named, allowMissingColumns=True).drop("block")

    left, right = cut_lineage(chosen(source), "left"), cut_lineage(chosen(sidecar), "right")
    exact = key_integrity(left, right).drop("source_rows", "sidecar_rows")
    totals = digests.groupBy("source_uri").agg(F.sum("left_rows").alias("source_rows"), F.sum("right_rows").alias("sidecar_rows"))
    faults = ("duplicate_keys", "orphan_keys", "missing_keys", "reordered_keys")
    result = totals.join(exact, "source_uri", "left").select(
        "source_uri", "source_rows", "sidecar_rows", *(F.coalesce(name, F.lit(0)).alias(name) for name in faults)
    )
    in_full = left.count() + right.count()
    width = (2 + len(values)) * _BYTES
    report = Exchange(
        ranges=counts["n"], differing=counts["differing"], cells=cells, keys=keys, undecoded=undecoded, rows_in_full=in_full,
        bytes=_BYTES * (5 * counts["n"] + 7 * cells + 3 * keys) + width * in_full, bytes_in_full=width * (counts["rows"] or 0),
    )
    return result, report
