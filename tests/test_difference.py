"""Reconciliation by difference against the comparison of everything, and what it exchanges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from posefold.operators import augment, difference
from posefold.operators.difference import cells_of, check_of, integrity_by_difference, peel

SCHEMA = "source_uri string, source_row long, episode_index long, frame_index long, index long, timestamp double"
VALUES = ["episode_index", "frame_index", "index", "timestamp"]


def table(spark, n, sources=2):
    rows = spark.range(n).select(
        F.concat(F.lit("fx://"), F.when(F.col("id") % 3 == 0, F.col("id") % sources).otherwise(0).cast("string")).alias("source_uri"),
        F.col("id").alias("source_row"), (F.col("id") % 7).alias("episode_index"), F.col("id").alias("frame_index"),
        F.col("id").alias("index"), (F.col("id") / 10).alias("timestamp"),
    )
    return rows


def same(got, want):
    columns = ["source_uri", "source_rows", "sidecar_rows", "duplicate_keys", "orphan_keys", "missing_keys", "reordered_keys"]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert rows(got) == rows(want)


def test_hashes_are_those_of_spark(spark):
    rows = [(k, r) for k in (0, -5, 7) for r in (0, 123456789, -(1 << 63), (1 << 63) - 1)]
    frame = spark.createDataFrame(rows, "source_row long, row_hash long").withColumns({"source_uri": F.lit("a"), "block": F.lit(0).cast("bigint"), "sign": F.lit(1)})
    for k, r in rows:
        cells = difference._tables(frame.where((F.col("source_row") == k) & (F.col("row_hash") == r)), 48).collect()
        assert sorted(c["cell"] for c in cells) == sorted(cells_of(r, 48))
        assert {c["check"] for c in cells} == {check_of(k, r)} and {c["key"] for c in cells} == {k}


@pytest.mark.parametrize("left,right,decodes", [(0, 0, True), (5, 3, True), (20, 10, True), (200, 0, False)])
def test_peel(left, right, decodes):
    rng = random.Random(left)
    rows = [(i, rng.getrandbits(63), 1 if i < left else -1) for i in range(left + right)]
    cells = {}
    for k, r, n in rows:
        for at in cells_of(r, 48):
            held = cells.setdefault(at, [0, 0, 0, 0])
            cells[at] = [held[0] + n, held[1] ^ k, held[2] ^ r, held[3] ^ check_of(k, r)]
    columns = [np.array([v[i] for v in cells.values()], dtype=np.int64) for i in range(4)]
    got = peel(np.array(list(cells), dtype=np.int64), *columns, 48)
    assert (got is not None) == decodes
    if decodes:
        assert sorted(got) == [k for k, _, _ in rows]


def test_equal_tables_exchange_only_ranges(spark):
    rows = table(spark, 5000)
    got, report = integrity_by_difference(rows, rows.repartition(7), VALUES, range_rows=512)
    same(got, augment.key_integrity(rows, rows))
    assert (report.differing, report.cells, report.keys, report.rows_in_full) == (0, 0, 0, 0)
    assert report.bytes * 20 < report.bytes_in_full


@pytest.mark.parametrize("sizes", [difference.SIZES, (6,), (48,)])
def test_broken_sidecar(spark, sizes):
    """Lost, repeated, changed, moved and foreign rows; also where tables are too small to come apart."""
    source = table(spark, 20_000)
    row = F.col("source_row")
    broken = source.where(row % 1001 != 0).withColumn("copies", F.when(row % 1003 == 0, 3).when(row % 1511 == 0, 2).otherwise(1))
    broken = broken.withColumn("index", F.when(row % 1007 == 0, F.col("index") + 1).otherwise(F.col("index")))
    broken = broken.withColumn("source_row", F.when(row % 1009 == 0, -row - 1).otherwise(row))
    broken = broken.select(*source.columns, F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")
    other = broken.limit(30).withColumns({"source_uri": F.lit("fx://foreign"), "timestamp": F.lit(None).cast("double")})
    twice = source.where(row % 1013 == 0).withColumn("timestamp", F.lit(float("nan")))  # a second, different row for the key
    broken = broken.unionByName(other).unionByName(twice)
    got, report = integrity_by_difference(source, broken, VALUES, range_rows=1024, sizes=sizes)
    same(got, augment.key_integrity(source, broken))
    if sizes == difference.SIZES:
        assert 0 < report.rows_in_full and report.undecoded < report.differing
    if sizes == (6,):
        assert report.undecoded > 0


def test_few_differences_in_many_rows(spark):
    source = table(spark, 200_000, sources=1)
    sidecar = source.where("source_row NOT IN (17, 90000, 123456)").withColumn("index", F.when(F.col("source_row") == 5, -1).otherwise(F.col("index")))
    got, report = integrity_by_difference(source, sidecar, VALUES, range_rows=8192)
    same(got, augment.key_integrity(source, sidecar))
    assert (report.keys, report.undecoded) == (4, 0) and report.rows_in_full == 5 and report.bytes * 500 < report.bytes_in_full


def test_empty(spark):
    none = table(spark, 0)
    some = table(spark, 10)
    for a, b in ((none, none), (some, none), (none, some)):
        got, _ = integrity_by_difference(a, b, VALUES)
        same(got, augment.key_integrity(a, b))
