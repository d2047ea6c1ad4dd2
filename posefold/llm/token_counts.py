"""Token counts by overlap resynchronisation.

Short texts are encoded where they lie. A huge text is cut into overlapping chunks, which are dealt
over the cluster and encoded one by one with the library's offsets. Two neighbours are spliced at a
boundary that both have and that is proven stable (a non-space character before white space, see
``bpe``): what lies left of it is counted from the left chunk, what lies right of it from the right
one. An overlap without such a boundary is widened until it has one or reaches the end of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.bpe import STABLE, is_byte_level, load, piece_encoder
from posefold.llm.common import slices, text_or_empty

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
_CHUNKS = "text_key binary, chunk int, body string, head int, tail int"
_TOKENIZERS: dict = {}


def cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """``(begin, end, head, tail)`` of every chunk: counted are the tokens from ``head`` to ``tail``.

    ``text[begin:end]`` holds the overlaps on both sides; all four are places in the text.
    """
    begin, head = 0, 0
    while True:
        edge = begin + chunk
        width, found = overlap, None
        while edge < len(text):
            found = STABLE.search(text, edge, min(len(text), edge + width))
            if found or edge + width >= len(text):
                break
            width *= 4
        if edge >= len(text) or not found:
            yield begin, len(text), head, len(text)
            return
        yield begin, min(len(text), edge + width), head, found.start()
        begin, head = edge, found.start()


def _tokenizer(name: str):
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = load(name)
    return _TOKENIZERS[name]


def tokens_between(tokenizer, body: str, head: int, tail: int) -> int:
    """Tokens of ``body`` from place ``head`` to place ``tail``, both of which must be token edges."""
    encoded = tokenizer.encode(body, add_special_tokens=False)

    def before(place: int) -> int:
        if place <= 0:
            return 0
        if place >= len(body):
            return len(encoded)
        token = encoded.char_to_token(place)
        if token is None or encoded.token_to_chars(token)[0] != place:
            raise ValueError(f"no token begins at the proven boundary {place}")
        return token

    return before(tail) - before(head)


def count_tokens(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per document: ``id, n_bytes, n_tokens, over_limit``.

    A null text counts as empty and has no tokens. Repeated rows are counted each; rows with a null
    id are kept. Columns other than the two named are not looked at, whatever their names. Copies of
    a huge text are encoded once. ``tokenizer`` must be a byte-level vocabulary of the tokenizers
    library; its special strings inside texts count as the library takes them.
    """
    if not is_byte_level(load(tokenizer)):
        raise ValueError("boundaries are proven for byte-level vocabularies without a normaliser only")
    rows = documents.select(
        F.col(id_column).alias("id"), text_or_empty(text_column).alias("body")
    ).withColumn("n_bytes", F.octet_length("body").cast("bigint"))
    id_type = rows.schema["id"].dataType.simpleString()

    def short(batches):
        encoder = piece_encoder(tokenizer)
        for batch in slices(batches):
            counts = [len(ids) // 4 for ids in encoder.encode(batch.column("body").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    def chunks(batches):
        for batch in slices(batches, 16):
            for text in batch.column("body").to_pylist():
                key = hashlib.sha256(text.encode()).digest()
                cuts = list(cut(text, chunk, overlap))
                for at in range(0, len(cuts), 256):
                    some = cuts[at : at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(some), pa.binary()),
                            pa.array(range(at, at + len(some)), pa.int32()),
                            pa.array([text[b:e] for b, e, _, _ in some], pa.string()),
                            pa.array([h - b for b, _, h, _ in some], pa.int32()),
                            pa.array([t - b for b, _, _, t in some], pa.int32()),
                        ],
                        ["text_key", "chunk", "body", "head", "tail"],
                    )

    def spliced(batches):
        library = _tokenizer(tokenizer)
        for batch in slices(batches, 64):
            columns = [batch.column(name).to_pylist() for name in ("body", "head", "tail")]
            counts = [tokens_between(library, *one) for one in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), pa.array(counts, pa.int64())], ["text_key", "n_tokens"]
            )

    is_short = F.char_length("body") <= chunk
    counted = rows.where(is_short).mapInArrow(short, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    huge = rows.where(~is_short)
    parts = (
        huge.select("body")
        .mapInArrow(chunks, _CHUNKS)
        .groupBy("text_key", "chunk")
        .agg(*(F.first(name).alias(name) for name in ("body", "head", "tail")))
        .mapInArrow(spliced, "text_key binary, n_tokens bigint")
    )
    totals = parts.groupBy("text_key").agg(F.sum("n_tokens").alias("n_tokens"))
    keyed = huge.select("id", "n_bytes", F.unhex(F.sha2("body", 256)).alias("text_key"))
    resolved = keyed.join(totals, "text_key").select("id", "n_bytes", "n_tokens")
    return counted.unionByName(resolved).select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
