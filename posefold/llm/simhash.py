"""SimHash near-dedup by covering locality-sensitive hashing.

For a radius ``r`` every bit position gets a code of ``r + 1`` bits, and every non-zero vector of so
many bits a mask: the positions whose code has an odd product with it. At most ``r`` differing
positions have codes that span less than the whole space, so some vector is orthogonal to all of
them, and its mask has none of these positions. Hence each pair within the radius has equal bits
under one mask at least: no pair is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import components, slices, stage, text_or_empty, without

RADIUS = 4
BITS = 64
SEED = 42
#: Fingerprints of one bucket that are compared in one go; larger buckets are compared tile by tile.
TILE = 4096
HASHES = 1 << 16
#: Steps that are tried for the codes of the masks.
STEPS = 128
_FOUND = "a bigint, b bigint, t int, key bigint, tile int, fps binary"


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """``2 ** (radius + 1) - 1`` masks as unsigned integers.

    Codes step through the numbers that are not zero. Of the first steps that number has no factor in
    common with, the one whose smallest mask has the most bits is taken: a mask of few bits would put
    unlike fingerprints into one bucket.
    """
    vectors = range(1, 1 << (radius + 1))

    def masks(step: int) -> list[int]:
        codes = [1 + place * step % len(vectors) for place in range(bits)]
        return [sum(((code & v).bit_count() & 1) << place for place, code in enumerate(codes)) for v in vectors]

    steps = [step for step in range(1, STEPS) if gcd(step, len(vectors)) == 1]
    return max(map(masks, steps), key=lambda found: min(mask.bit_count() for mask in found))


def fingerprint(text: str, words: int = 4) -> int:
    """The unsigned fingerprint of a whole text; zero if it has no words."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    shingles = max(1, len(tokens) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, HASHES):
        spans = zip(starts[at : min(shingles, at + HASHES)].tolist(), ends[words - 1 :][at : at + HASHES].tolist() or [len(joined)])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > shingles, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """``id, fp`` (signed) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, words) for t in batch.column("body").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), text_or_empty(text_column).alias("body"))
    return rows.mapInArrow(run, "id bigint, fp bigint")


def stars(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``(centre, other)`` for the classes that links within the radius make of distinct values."""
    centres, others = [], []
    left = values
    while len(left) > 1:
        centre, left = left[0], left[1:]
        front = [centre]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            if near.any():
                reached = left[near]
                left = left[~near]
                centres.append(np.full(len(reached), centre))
                others.append(reached)
                front.extend(reached)
    none = np.array([], dtype=values.dtype)
    return (np.concatenate(centres), np.concatenate(others)) if centres else (none, none)


def _batch(a, b, tiles=()) -> pa.RecordBatch:
    n, m = len(a), len(tiles)
    nulls = [None] * n
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*np.asarray(a).view(np.int64).tolist(), *[None] * m], pa.int64()),
            pa.array([*np.asarray(b).view(np.int64).tolist(), *[None] * m], pa.int64()),
            *(pa.array(nulls + [tile[i] for tile in tiles], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary()))),
        ],
        [field.split()[0] for field in _FOUND.split(", ")],
    )


def _within_buckets(radius: int, tile: int):
    """Over rows sorted by bucket: links of small buckets, tiles of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, cut = np.array([], dtype=np.uint64), None, 0

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                yield _batch(*stars(held, radius))
            if cut and len(held):
                yield _batch((), (), [(*bucket, cut, held.tobytes())])

        for batch in batches:
            t, key = batch.column("t").to_numpy(), batch.column("key").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            edges = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            begins, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(fps)]])
            sizes = ends - begins
            inner = np.ones(len(begins), dtype=bool)
            inner[[0, -1]] = False
            # Buckets that lie whole in this batch: twos side by side, others one by one.
            twos = begins[inner & (sizes == 2)]
            near = twos[np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= radius]
            found = [(fps[near], fps[near + 1])]
            rest = np.flatnonzero(~inner | (sizes > 2)) if len(begins) else []
            for i in rest:
                begin, end = int(begins[i]), int(ends[i])
                if inner[i] and sizes[i] <= tile:
                    found.append(stars(fps[begin:end], radius))
                    continue
                name = (int(t[begin]), int(key[begin]))
                if name != bucket:
                    yield from close()
                    held, bucket, cut = np.array([], dtype=np.uint64), name, 0
                held = np.concatenate([held, fps[begin:end]])
                while len(held) > tile:
                    part, held = held[:tile], held[tile:]
                    found.append(stars(part, radius))
                    yield _batch((), (), [(*bucket, cut, part.tobytes())])
                    cut += 1
            yield _batch(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))
        yield from close()

    return run


def _across_tiles(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                both = np.frombuffer(row["fps"] + row["other"], np.uint64)
                a, b = stars(both, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links that give the same classes as all pairs of ``fp`` within the radius.

    A bucket of n fingerprints gives at most n - 1 links. One of more than ``tile`` is compared tile
    against tile in tasks of their own, so it neither fills a task nor loses a pair.
    """
    signed = [mask - (1 << BITS) * (mask >> (BITS - 1)) for mask in covering_masks(radius)]
    masks = F.array(*(F.lit(mask) for mask in signed))
    keyed = distinct.select("fp", F.posexplode(masks).alias("t", "mask")).select(
        "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )
    sorted_ = keyed.repartition("t", "key").sortWithinPartitions("t", "key")
    found = stage(sorted_.mapInArrow(_within_buckets(radius, tile), _FOUND), "links")
    tiles = found.where("fps IS NOT NULL").select("t", "key", "tile", "fps")
    others = tiles.select("t", "key", F.col("tile").alias("later"), F.col("fps").alias("other"))
    across = (
        tiles.join(others, ["t", "key"])
        .where("tile < later")
        .select("fps", "other")
        .mapInArrow(_across_tiles(radius), "a bigint, b bigint")
    )
    return found.where("a IS NOT NULL").select("a", "b").unionByName(across)


def near_duplicates(
    documents: DataFrame,
    words: int = 4,
    radius: int = RADIUS,
    id_column: str = "doc_id",
    text_column: str = "text",
    tile: int = TILE,
) -> DataFrame:
    """One row per document: ``id, fingerprint, component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; the component is the smallest id that
    links reach. A null or wordless text has fingerprint zero, which links like any other. Rows that
    repeat an id are rows of their own; null ids get the smallest id of their component, null where
    it has none. Copies share a fingerprint and are compared once. Other columns are not looked at,
    whatever their names; an empty table gives no rows.
    """
    rows = stage(fingerprints(documents, words, id_column, text_column), "fingerprints")
    return fingerprint_classes(rows, radius, tile).withColumnRenamed("id", id_column)


def fingerprint_classes(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``id, fingerprint, component_id`` of every row of ``rows`` (``id, fp``, staged)."""
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    classes = components(links(distinct.select("fp"), radius, tile), "near-duplicates")
    classed = stage(
        distinct.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        ),
        "classes",
    )
    least = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classed.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    documents: DataFrame, words: int = 5, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows, with all their columns, that stay when one document of each component does: the one with
    the smallest id. An id of which some row stays keeps all its rows; rows without an id stay."""
    found = near_duplicates(documents, words, radius, id_column, text_column)
    key = F.col(id_column)
    judged = found.where(key.isNotNull()).groupBy(key).agg(F.max(key == F.col("component_id")).alias("stays"))
    return without(documents, judged.where("NOT stays"), [id_column])
