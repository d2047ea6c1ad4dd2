"""Binary token output: concatenated ids with Elias-Fano document boundaries.

File format: a Parquet folder, written by Spark's committer, so that any store Spark writes to will
do and a lost executor leaves nothing half-written. A row is a segment:

| column | content |
|---|---|
| ``part``, ``seq`` | place of the segment: ascending in document order |
| ``n_docs``, ``n_tokens``, ``width`` | documents, ids, bytes of an id (2 if every id fits, else 4) |
| ``ids`` | ids of all documents, one after another, little-endian |
| ``low_bits``, ``low``, ``high``, ``samples`` | Elias-Fano code of the documents' end offsets |
| ``doc_ids`` | ids of the documents, in order |

``read_segments`` and ``Segment.document`` give the ids of one document by two selects.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from posefold.llm.bpe import load, piece_encoder
from posefold.llm.common import slices, text_or_empty
from posefold.llm.elias_fano import EliasFano
from posefold.operators.scale import checkpoint_root, lookup_join

SEGMENT_TOKENS = 2_000_000
SCHEMA = (
    "part int, seq int, n_docs int, n_tokens bigint, width int, ids binary, low_bits int, low binary,"
    " high binary, samples binary, doc_ids array<bigint>"
)


class Segment:
    """One row of the format, with random access to its documents."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self._ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
        self._ids = np.frombuffer(row["ids"], f"<u{row['width']}")

    def offsets(self, i: int) -> tuple[int, int]:
        return (self._ends.select(i - 1) if i else 0), self._ends.select(i)

    def document(self, i: int) -> np.ndarray:
        """Ids of the ``i``-th document."""
        return self._ids[slice(*self.offsets(i))]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(doc_id, start in the segment, ids)`` of every document."""
        start = 0
        for doc_id, end in zip(self.doc_ids, self._ends.all().tolist()):
            yield doc_id, start, self._ids[start:end]
            start = end


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 0,
    segment_tokens: int = SEGMENT_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, and write segments in ascending id order.

    Rows are range-partitioned on the id and a hash of the text, so neither one repeated id nor one
    frequent text fills a task. Null texts count as empty (just the end id), null ids come first,
    repeated rows are written each; an empty table gives a readable folder without segments. Other
    columns are not looked at, whatever their names. A worker holds one segment at a time; a
    document is never split, so one that is longer than a segment makes a segment of its own.
    """
    width = 2 if load(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = piece_encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, doc_ids, ends, total = [], [], [], 0

        def segment() -> pa.RecordBatch:
            code = EliasFano.of(np.array(ends))
            row = dict(
                part=part, seq=seq, n_docs=len(ends), n_tokens=total, width=width, ids=b"".join(ids),
                low_bits=code.low_bits, low=code.low, high=code.high, samples=code.samples, doc_ids=doc_ids,
            )
            kinds = dict(part=pa.int32(), seq=pa.int32(), n_docs=pa.int32(), n_tokens=pa.int64(), width=pa.int32(),
                         ids=pa.binary(), low_bits=pa.int32(), low=pa.binary(), high=pa.binary(), samples=pa.binary(),
                         doc_ids=pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([row[k]], kind) for k, kind in kinds.items()], list(kinds))

        for batch in slices(batches):
            for doc_id, code in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("body").to_pylist())):
                narrow = np.append(np.frombuffer(code, "<u4"), np.uint32(end_id)).astype(f"<u{width}")
                if ends and total + len(narrow) > segment_tokens:
                    yield segment()
                    ids, doc_ids, ends, total, seq = [], [], [], 0, seq + 1
                total += len(narrow)
                ids.append(narrow.tobytes())
                doc_ids.append(doc_id)
                ends.append(total)
        if ends:
            yield segment()

    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), text_or_empty(text_column).alias("body"))
    order = [F.col("id"), F.xxhash64("body")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, SCHEMA).write.option("compression", "snappy").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per document of a written folder: ``id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it; it is a running sum over segment totals,
    first by part, then inside each part, plus the place in the segment.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                found = [
                    (row["part"], row["seq"], doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in Segment(row).documents()
                ]
                kinds = [pa.int32(), pa.int32()] + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)],
                    ["part", "seq", "id", "start", "n_tokens", "ids_crc32"],
                )

    segments = read_segments(spark, path)
    totals = segments.select("part", "seq", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = totals.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.join(parts, "part").select(
        "part", "seq", (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("base")
    )
    rows = segments.mapInArrow(decode, "part int, seq int, id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    placed = lookup_join(rows, bases, ["part", "seq"], how="inner", derived=True)
    return placed.select(
        F.col("id").alias(id_column), (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{checkpoint_root(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
