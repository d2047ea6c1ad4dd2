"""Best-fit packing of token pieces into sequences, in bounded space.

A packer keeps a fixed number of open bins. A bitset has a bit for every amount of free space that
some open bin has; the lowest set bit from a piece's length on is the best fit. When one bin too many
is open, the fullest closes, for it is the least likely to take another piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.bpe import piece_encoder
from posefold.llm.common import slices, stage, text_or_empty

SEQUENCE_TOKENS = 1024
OPEN_BINS = 512
PACKER_PIECES = 200_000
PLACEMENT = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Packer:
    """Bounded-space best fit over bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        self._capacity, self._most = capacity, open_bins
        self._free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._bits = 0
        self._open = 0
        self.bins = self.closed = 0

    def place(self, length: int) -> tuple[int, int]:
        """``(bin, offset)`` of the next piece."""
        fits = self._bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self._capacity, self.bins
            self.bins += 1
        if rest := free - length:
            self._free[rest].append(bin_)
            self._bits |= 1 << rest
            self._open += 1
            if self._open > self._most:
                self._take((self._bits & -self._bits).bit_length() - 1)
                self.closed += 1
        return bin_, self._capacity - free

    def _take(self, free: int) -> int:
        bins = self._free[free]
        bin_ = bins.pop()
        self._open -= 1
        if not bins:
            self._bits ^= 1 << free
        return bin_


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones, and the rest first."""
    first = total % capacity
    return [first] * bool(first) + [capacity] * (total // capacity)


def token_pieces(
    documents: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    capacity: int = SEQUENCE_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian) of every piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = piece_encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in slices(batches):
            out = []
            for doc_id, ids in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("body").to_pylist())):
                ids += end
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, piece, start, length, zlib.crc32(own), own if with_ids else None))
                    start += length
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            if out:
                columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns[: 5 + with_ids], names[: 5 + with_ids])

    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), text_or_empty(text_column).alias("body"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, schema)


def pack(
    pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS, packer_pieces: int = PACKER_PIECES
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a staged table of pieces.

    A piece that fills a sequence is one. The others are dealt by hash to as many packers as their
    number asks for and arrive by document and piece, so that a repeated task gives the same sequences;
    a packer sees each once, looks at none to come and holds ``open_bins`` bins whatever their number.
    """
    fields = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes) + ", sequence_id bigint, offset bigint"

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(length) for length in batch.column("length").to_pylist()]
            spots = np.array(placed, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spots[:, 0] + base), pa.array(spots[:, 1])],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    part = pieces.where(F.col("length") < capacity)
    full = pieces.where(F.col("length") >= capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    packers = -(-part.count() // packer_pieces) or 1
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = part.repartition(packers, F.xxhash64("doc_id", "piece", "ids_crc32")).sortWithinPartitions(*order)
    return dealt.mapInArrow(fit, fields).unionByName(full)


def pack_documents(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
                   capacity: int = SEQUENCE_TOKENS, id_column: str = "doc_id", text_column: str = "text",
                   open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Every document is its ids plus the end id; one of more than ``capacity`` ids is cut into full
    pieces, of which the first may be shorter, others are never cut. A null text counts as empty
    (the end id alone), null ids and repeated rows are packed like any row, an empty table gives no
    pieces. Other columns are not looked at, whatever their names.
    """
    pieces = token_pieces(documents, tokenizer, end_id, capacity, id_column, text_column, with_ids)
    packed = pack(stage(pieces, "token-pieces"), capacity, open_bins)
    return packed.withColumnRenamed("doc_id", id_column)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, lengths`` of packed pieces that carry their ids; a sequence has 1024 at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("parts.length").alias("lengths"))
