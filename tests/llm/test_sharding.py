"""Sharding: every row once, gapless slots, near equal bytes, skew in keys and sizes."""

import zlib

import pytest

from posefold.llm.sharding import shard_by_bytes


def check(rows, got, shards, tolerance):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total = sum(r.size for r in got)
    loads = [sum(r.size for r in by.get(s, [])) for s in range(shards)]
    largest = max((r.size for r in got), default=0)
    assert max(loads) <= total / shards * (1 + tolerance) + largest
    assert min(loads) >= total / shards * (1 - tolerance) - largest


@pytest.mark.parametrize("part_rows", [40, 50_000])
def test_skewed_rows(spark, part_rows):
    rows = [(i, "same text") for i in range(700)] + [(1000 + i, f"t{i} " * (i % 50)) for i in range(1500)]
    rows += [(None, "n"), (None, None), (7, "same text"), (7, "same text"), (5000, "long " * 2000)]
    documents = spark.createDataFrame([(d, t, 3) for d, t in rows], "doc_id long, text string, shard int")
    got = shard_by_bytes(documents, shards=8, part_rows=part_rows).collect()
    check(rows, got, 8, 0.02)


def test_few_rows_and_none(spark):
    rows = [(1, "a"), (2, "b")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, shard_by_bytes(documents, shards=5).collect(), 5, 1)
    assert shard_by_bytes(documents.limit(0)).count() == 0


def test_small_groups_stay_whole(spark):
    rows = [(i, f"text {i // 3}" * 20) for i in range(9000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_by_bytes(documents, shards=4).collect()
    check(rows, got, 4, 0.02)
    homes = {}
    for r in got:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_whole_table(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op2_sharding"](spark, sf).collect(), 40, 0.02)
