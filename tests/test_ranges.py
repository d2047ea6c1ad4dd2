"""Files hashed by byte ranges: many tasks a file, a tree over the ranges, a flipped byte that is found."""

import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from posefold.operators import gates
from posefold.sources import sinks
from posefold.sources.files import digest_tree, file_fingerprints, folded, proof_of, range_digests, tree_root

KB = 1024


def test_one_large_file_is_many_tasks(spark, tmp_path):
    data = os.urandom(3_000 * KB + 17)
    (tmp_path / "large.bin").write_bytes(data)
    (tmp_path / "small.bin").write_bytes(b"abc")
    (tmp_path / "empty.bin").write_bytes(b"")
    found = range_digests(spark, str(tmp_path), range_bytes=64 * KB).withColumn("task", F.spark_partition_id()).collect()
    large = sorted((r for r in found if r["path"].endswith("large.bin")), key=lambda r: r["range_no"])
    assert len(large) == 47 and {r["size_bytes"] for r in large} == {len(data)}
    assert len({r["task"] for r in large}) >= 6  # of eight cores
    for r in large:
        begin = r["range_no"] * 64 * KB
        assert r["sha256"] == hashlib.sha256(data[begin : begin + 64 * KB]).hexdigest()
    whole = {r["path"]: r["sha256"] for r in file_fingerprints(spark, str(tmp_path)).collect()}
    assert all(r["sha256"] == whole[r["path"]] for r in found if not r["path"].endswith("large.bin"))
    with pytest.raises(ValueError):
        range_digests(spark, str(tmp_path), range_bytes=1 << 40)


@pytest.mark.parametrize("n,fan", [(1, 4), (4, 4), (5, 4), (16, 4), (70, 4), (9, 2)])
def test_tree_and_proofs(spark, n, fan):
    rows = spark.createDataFrame([(f"p{i:03}", i % 3, hashlib.sha256(b"%d" % i).hexdigest()) for i in range(n)], "part string, range_no long, sha256 string")
    levels = digest_tree(rows, ["part", "range_no"], fan)
    want = [hashlib.sha256(b"%d" % i).hexdigest() for i in range(n)]
    leaves = list(want)
    while len(want) > 1:
        want = [hashlib.sha256("".join(want[i : i + fan]).encode()).hexdigest() for i in range(0, len(want), fan)]
    assert tree_root(levels) == want[0]
    for at in {0, n // 2, n - 1}:
        path = proof_of(levels, at, fan)
        assert folded(leaves[at], path) == want[0] and (n == 1 or folded("0" * 64, path) != want[0])


def published(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(3)
    return sinks.publish(rows, str(tmp_path / "out"), "v", 60_000, {}, range_bytes=64 * KB)


def flip(path: Path, at: int):
    data = bytearray(path.read_bytes())
    data[at] ^= 1
    path.write_bytes(bytes(data))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def test_a_flipped_byte_is_found(spark, tmp_path):
    manifest = published(spark, tmp_path)
    out = str(tmp_path / "out")
    assert sinks.read_published(spark, out).count() == 60_000 and manifest["part_files"] == 3
    part = sorted(Path(manifest["data_uri"].removeprefix("file:")).glob("part-*"))[1]
    n = -(-part.stat().st_size // (64 * KB))
    assert n > 5
    proofs = [sinks.part_proof(spark, out, part.name, i) for i in range(n)]
    assert sinks.verify_part(spark, out, part.name, proofs)
    flip(part, 3 * 64 * KB + 5)
    assert [tuple(r) for r in sinks.differing_ranges(spark, manifest).collect()] == [(part.name, 3, 3 * 64 * KB)]
    with pytest.raises(gates.Refused, match=f"1 part files differ, first {part.name} from byte {3 * 64 * KB}"):
        sinks.read_published(spark, out)
    assert not sinks.verify_part(spark, out, part.name, proofs)
    others = sorted(p for p in part.parent.glob("part-*") if p != part)
    good = [sinks.part_proof(spark, out, others[0].name, i) for i in range(-(-others[0].stat().st_size // (64 * KB)))]
    assert sinks.verify_part(spark, out, others[0].name, good)


def test_forged_digests_do_not_lead_to_the_root(spark, tmp_path):
    manifest = published(spark, tmp_path)
    part = sorted(Path(manifest["data_uri"].removeprefix("file:")).glob("part-*"))[0]
    flip(part, 100)
    forged = sinks.relative_parts(range_digests(spark, manifest["data_uri"], glob="*.parquet", range_bytes=64 * KB)).collect()
    schema = "part string, range_no long, size_bytes long, sha256 string"
    spark.createDataFrame(forged, schema).write.mode("overwrite").parquet(manifest["parts_uri"])
    with pytest.raises(gates.Refused, match="part_digests_match_root"):
        sinks.read_published(spark, str(tmp_path / "out"))
