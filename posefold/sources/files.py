"""Content digests of files, computed on executors."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold.functions.text import git_blob_oid
from posefold.operators.scale import cut_lineage, ordinal_within

NATIVE_LIMIT_BYTES = 64 * 1024 * 1024
_CHUNK = 8 * 1024 * 1024


def file_fingerprints(
    spark: SparkSession,
    *paths: str,
    glob: str | None = None,
    recursive: bool = True,
    native_limit: int = NATIVE_LIMIT_BYTES,
) -> DataFrame:
    """``path, size_bytes, sha256`` of every file.

    Small files are hashed by Spark's own binary source. Larger ones (a binary column cannot pass
    2 GiB) are read in chunks by the task that owns the path, so memory stays constant.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(list(paths))
    small = files.where(F.col("length") <= native_limit).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )
    # Content is pruned from this branch: only names and sizes are listed, then spread over tasks.
    large = (
        files.where(F.col("length") > native_limit)
        .select("path", F.col("length").alias("size_bytes"))
        .repartition("path")
        .mapInPandas(_hash_in_chunks, "path string, size_bytes bigint, sha256 string")
    )
    return small.unionByName(large)


def _hash_in_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(sha256=[_stream_digest(path) for path in batch["path"]])


def _stream_digest(path: str) -> str:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    digest = hashlib.sha256()
    with system.open_input_stream(inner) as stream:
        while block := stream.read(_CHUNK):
            digest.update(block)
    return digest.hexdigest()


def arrow_uri(path: str) -> str:
    """Hadoop writes file:/x and s3a://; Arrow expects file:///x and s3://."""
    return re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]://", "s3://", path))


RANGE_BYTES = 64 * 1024 * 1024
FAN = 256
_RANGE = "path string, size_bytes bigint, range_no bigint, sha256 string"


def range_digests(
    spark: SparkSession, *paths: str, glob: str | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``path, size_bytes, range_no, sha256`` of every range of every file; a file of one range has its own digest.

    Files of one range are hashed by Spark's binary source. The ranges of larger ones are dealt to tasks one by
    one and read from where they begin, so a single large file keeps every core busy.
    """
    if range_bytes > NATIVE_LIMIT_BYTES:
        raise ValueError(f"a range has at most {NATIVE_LIMIT_BYTES} bytes")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(list(paths))
    small = files.where(F.col("length") <= range_bytes).select(
        "path", F.col("length").alias("size_bytes"), F.lit(0).cast("bigint").alias("range_no"), F.sha2("content", 256).alias("sha256")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_range_digest(p, int(n) * range_bytes, range_bytes) for p, n in zip(batch["path"], batch["range_no"])]
            yield batch.assign(sha256=found)

    # Names and sizes only. Spark picks one partition a range and core, since each is dealt by its own key.
    ranges = files.where(F.col("length") > range_bytes).select(
        "path", F.col("length").alias("size_bytes"),
        F.explode(F.expr(f"sequence(0L, (length - 1) DIV {range_bytes})")).alias("range_no"),
    )
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    large = ranges.repartition(tasks, "path", "range_no").mapInPandas(run, _RANGE)
    return small.unionByName(large)


def _range_digest(path: str, begin: int, length: int) -> str:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    digest = hashlib.sha256()
    with system.open_input_file(inner) as file:
        file.seek(begin)
        while length > 0 and (block := file.read(min(_CHUNK, length))):
            digest.update(block)
            length -= len(block)
    return digest.hexdigest()


def digest_tree(ranges: DataFrame, order: list[str], fan: int = FAN) -> list[DataFrame]:
    """Levels of ``pos, sha256`` over the ranges in order, lowest (with its ``order`` columns) first, root last."""
    if ranges.limit(fan + 1).count() <= fan:  # one run: at most ``fan`` lines are gathered
        run = ranges.agg(F.sort_array(F.collect_list(F.struct(*order, "sha256"))).alias("run"))
        lowest = run.select(F.posexplode("run").alias("pos", "e")).select("e.*", F.col("pos").cast("bigint").alias("pos"))
    else:
        keyed = ranges.withColumn("_all", F.lit(0))
        lowest = ordinal_within(keyed, ["_all"], list(order), "pos")
    lowest = lowest.select(*order, "pos", "sha256")
    levels = [cut_lineage(lowest, "digests")]
    while (top := levels[-1].agg(F.max("pos")).first()[0]) is not None and top > 0:
        runs = levels[-1].select("pos", "sha256").groupBy(F.expr(f"pos DIV {fan}").alias("pos"))
        # At most ``fan`` digests a run.
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "sha256"))), lambda e: e["sha256"]), "")
        levels.append(cut_lineage(runs.agg(F.sha2(joined, 256).alias("sha256")), "digests"))
    return levels


def tree_root(levels: list[DataFrame]) -> str | None:
    top = levels[-1].first()
    return top["sha256"] if top else None


def proof_of(levels: list[DataFrame], pos: int, fan: int = FAN) -> list[tuple[list[str], list[str]]]:
    """Left and right siblings of leaf ``pos`` on every level below the root: a few digests, whatever the tree."""
    path = []
    for level in levels[:-1]:
        first = pos - pos % fan
        run = level.where(F.col("pos").between(first, first + fan - 1)).select("pos", "sha256").orderBy("pos").collect()
        path.append(([r["sha256"] for r in run if r["pos"] < pos], [r["sha256"] for r in run if r["pos"] > pos]))
        pos //= fan
    return path


def folded(leaf: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its proof lead to."""
    for left, right in path:
        leaf = hashlib.sha256("".join([*left, leaf, *right]).encode()).hexdigest()
    return leaf


def git_oids(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, size_bytes, oid``: the git blob id of each (metadata-sized) file."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", F.col("length").alias("size_bytes"), git_blob_oid().alias("oid"))
