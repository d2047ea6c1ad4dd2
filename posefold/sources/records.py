"""Raw record files as a Spark data source: split by bytes, filtered before payloads are read, broken records kept.

A file holds the records of one source. After a header with its URI it consists of chunks, each begun by a
sync marker, so a split starts at the first marker behind its first byte and ends with the chunk that begins
before its last. A record is an envelope (topic, times, sequence) and a payload (pose, position), each with its
length and CRC-32. A payload that does not check out becomes a row with ``decode_error`` and its envelope, a
broken envelope one without a topic, and a chunk that cannot be followed any further one for all its rest.

Writing tasks leave files under names of their own; the commit writes the list of those that count. Readers
see listed files only, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from posefold import contracts as C
from posefold.sources.files import arrow_uri

FORMAT = "posefold_records"
# Fixed values of the format.
MAGIC = b"PFRS\x01"
SYNC = bytes.fromhex("9d1fe0746c52ab380f47d3b1e68a21c5")
_FRAME, _TIMES, _COUNT = "<II", "<BQQq", "<H"
#: Bytes of a chunk, of a split and of one read.
CHUNK = 1 << 18
SPLIT = 32 << 20
#: Rows of a batch, which small files share.
BATCH = 4096
LIST = "_records.json"


def _packed(values) -> bytes:
    if values is None:
        return b"\x00"
    missing = bytes(1 if v is None else 0 for v in values)
    return b"\x01" + struct.pack(_COUNT, len(values)) + missing + struct.pack(f"<{len(values)}d", *(0.0 if v is None else v for v in values))


def _unpacked(body: bytes, at: int) -> tuple[list | None, int]:
    if body[at] == 0:
        return None, at + 1
    (n,) = struct.unpack_from(_COUNT, body, at + 1)
    at += 1 + struct.calcsize(_COUNT)
    missing, values = body[at : at + n], struct.unpack_from(f"<{n}d", body, at + n)
    return [None if gone else v for gone, v in zip(missing, values)], at + 9 * n


def _framed(body: bytes, broken: bool = False) -> bytes:
    return struct.pack(_FRAME, len(body), zlib.crc32(body) ^ broken) + body


def encode_record(row) -> bytes:
    """One message as a record; a message with a decode error as one whose payload does not check out."""
    names = ("topic", "log_time_ns", "publish_time_ns", "sequence")
    flags = sum((row[name] is not None) << i for i, name in enumerate(names))
    envelope = struct.pack(_TIMES, flags, int(row["log_time_ns"] or 0), int(row["publish_time_ns"] or 0), int(row["sequence"] or 0))
    envelope += (row["topic"] or "").encode()
    return _framed(envelope) + _framed(_packed(row["pose"]) + _packed(row["position"]), broken=row["decode_error"] is not None)


def _envelope(body: bytes) -> tuple:
    flags, log_time, publish_time, sequence = struct.unpack_from(_TIMES, body)
    topic = body[struct.calcsize(_TIMES) :].decode()
    return tuple(v if flags >> i & 1 else None for i, v in enumerate((topic, log_time, publish_time, sequence)))


def decode_chunk(body: bytes, wanted=None) -> Iterator[tuple]:
    """``topic, log_time_ns, publish_time_ns, sequence, pose, position, decode_error`` of a chunk's records.
    ``wanted(envelope)`` tells whose payload is looked at and who is left out."""
    at, none = 0, (None,) * 6
    while at < len(body):
        parts = []
        for _ in range(2):
            if at + struct.calcsize(_FRAME) > len(body):
                break
            size, crc = struct.unpack_from(_FRAME, body, at)
            if at + struct.calcsize(_FRAME) + size > len(body):
                break
            part = body[at + struct.calcsize(_FRAME) : at + struct.calcsize(_FRAME) + size]
            at += struct.calcsize(_FRAME) + size
            parts.append((part, zlib.crc32(part) == crc))
        if len(parts) < 2:
            if wanted is None or wanted(none):
                yield (*none, "chunk: the rest cannot be followed")
            return
        (envelope, known), (payload, sound) = parts
        try:
            head = _envelope(envelope) if known else none[:4]
        except (struct.error, UnicodeDecodeError):
            head, known = none[:4], False
        if wanted is not None and not wanted(head):
            continue
        if not known:
            yield (*none, "envelope")
            continue
        try:
            if not sound:
                raise ValueError
            pose, after = _unpacked(payload, 0)
            position, _ = _unpacked(payload, after)
        except (ValueError, IndexError, struct.error):
            yield (*head, None, None, "payload")
            continue
        yield (*head, pose, position, None)


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    return system, inner


class _Blocks:
    """A file read forward through a window of a few megabytes."""

    def __init__(self, file, at: int):
        self._file, self.at, self._held, self._step = file, at, b"", 4 << 20
        file.seek(at)

    def peek(self, n: int) -> bytes:
        while len(self._held) < n and (more := self._file.read(max(self._step, n - len(self._held)))):
            self._held += more
        return self._held[:n]

    def skip(self, n: int) -> None:
        self.peek(n)
        self.at += min(n, len(self._held))
        self._held = self._held[n:]

    def to_sync(self, end: int) -> bool:
        """Move to the next marker that begins before ``end``; whether there is one."""
        while self.at < end:
            window = self.peek(self._step)
            found = window.find(SYNC)
            if found >= 0:
                self.skip(found)
                return self.at < end
            if len(window) < self._step:
                return False
            self.skip(len(window) - len(SYNC) + 1)
        return False


def read_split(file, source_uri: str, begin: int, end: int, wanted=None) -> Iterator[list[tuple]]:
    """Rows of the chunks that begin between ``begin`` and ``end``, a list per chunk."""
    blocks = _Blocks(file, begin)
    while blocks.to_sync(end):
        head = blocks.peek(len(SYNC) + struct.calcsize(_FRAME))
        if len(head) < len(SYNC) + struct.calcsize(_FRAME):
            return
        size, crc = struct.unpack_from(_FRAME, head, len(SYNC))
        if zlib.crc32(size.to_bytes(4, "little")) != crc:  # the size itself is broken: on to the next marker
            blocks.skip(len(SYNC))
            if wanted is None or wanted((None,) * 4):
                yield [(source_uri, *(None,) * 6, "chunk: the rest cannot be followed")]
            continue
        blocks.skip(len(head))
        body = blocks.peek(size)
        blocks.skip(len(body))
        yield [(source_uri, *row) for row in decode_chunk(body, wanted)]


@dataclass
class Split(InputPartition):
    """Byte ranges ``(path, begin, end)``: one of a large file, or several small files."""

    ranges: list


@dataclass
class Written(WriterCommitMessage):
    files: list


class RecordSource(DataSource):
    """``spark.read.format("posefold_records").load(folder)``: the columns of ``arm_messages``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return C.ARM_MESSAGES

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("record folders are appended to, never overwritten")
        return RecordWriter(self.options["path"])


class RecordReader(DataSourceReader):
    def __init__(self, options):
        self._path, self._split = options["path"].rstrip("/"), int(options.get("splitBytes", SPLIT))
        self._topics, self._since, self._until = None, None, None

    def pushFilters(self, filters: list[Filter]):
        """Topics and bounds of times are looked at in envelopes; other filters stay with Spark."""
        for one in filters:
            if isinstance(one, (EqualTo, In)) and one.attribute == ("topic",):
                topics = {one.value} if isinstance(one, EqualTo) else set(one.value)
                self._topics = topics if self._topics is None else self._topics & topics
            elif isinstance(one, GreaterThanOrEqual) and one.attribute == ("log_time_ns",):
                self._since = max(int(one.value), self._since if self._since is not None else int(one.value))
            elif isinstance(one, LessThan) and one.attribute == ("log_time_ns",):
                self._until = min(int(one.value), self._until if self._until is not None else int(one.value))
            else:
                yield one

    def _wanted(self):
        if self._topics is None and self._since is None and self._until is None:
            return None

        def wanted(envelope: tuple) -> bool:
            topic, time = envelope[0], envelope[1]
            if self._topics is not None and topic not in self._topics:
                return False
            if self._since is not None and (time is None or time < self._since):
                return False
            return self._until is None or time is not None and time < self._until

        return wanted

    def partitions(self) -> list[InputPartition]:
        """Splits of the listed files, whose sizes stand in the list: no file is touched."""
        splits, held, size = [], [], 0
        for name, total in sorted(listed_files(self._path).items()):
            for at in range(0, total, self._split):
                end = min(at + self._split, total)
                if held and size + end - at > self._split:
                    splits.append(Split(held))
                    held, size = [], 0
                held.append((f"{self._path}/{name}", at, end))
                size += end - at
        return [*splits, Split(held)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        schema, held = to_arrow_schema(C.ARM_MESSAGES), []

        def batch() -> pa.RecordBatch:
            uri, topic, log, publish, sequence, pose, position, error = zip(*held)
            columns = (uri, topic, log, publish, sequence, (None,) * len(held), pose, position, error)
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

        for path, begin, end in partition.ranges:
            system, inner = _open(path)
            with system.open_input_file(inner) as file:
                head = file.read(len(MAGIC) + struct.calcsize(_COUNT))
                if head[: len(MAGIC)] != MAGIC:
                    raise ValueError(f"{path} is no record file")
                source_uri = file.read(struct.unpack_from(_COUNT, head, len(MAGIC))[0]).decode()
                for rows in read_split(file, source_uri, begin, end, self._wanted()):
                    held += rows
                    if len(held) >= BATCH:
                        yield batch()
                        held.clear()
        if held:
            yield batch()


class RecordWriter(DataSourceWriter):
    """Rows of a task come source by source; each run of one source is a file."""

    def __init__(self, path: str):
        self._path = path.rstrip("/")

    def write(self, rows) -> Written:
        files, held, size, current, out = [], [], 0, None, None
        system, root = _open(self._path)
        system.create_dir(root, recursive=True)

        def flush() -> None:
            nonlocal held, size
            if held:
                body = b"".join(held)
                length = len(body)
                out.write(SYNC + struct.pack(_FRAME, length, zlib.crc32(length.to_bytes(4, "little"))) + body)
                held, size = [], 0

        def close() -> None:
            if out is not None:
                flush()
                files[-1][1] = out.tell()
                out.close()

        for row in rows:
            if out is None or row["source_uri"] != current:
                close()
                current = row["source_uri"]
                files.append([f"{uuid.uuid4().hex}.rec", 0])
                out = system.open_output_stream(f"{root}/{files[-1][0]}")
                uri = (current or "").encode()
                out.write(MAGIC + struct.pack(_COUNT, len(uri)) + uri)
            record = encode_record(row)
            held.append(record)
            size += len(record)
            if size >= CHUNK:
                flush()
        close()
        return Written(files)

    def commit(self, messages) -> None:
        listed = listed_files(self._path)
        listed.update({name: size for message in messages if message is not None for name, size in message.files})
        system, root = _open(self._path)
        with system.open_output_stream(f"{root}/{LIST}") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        """Files of an aborted write are in no list."""


def listed_files(path: str) -> dict[str, int]:
    system, root = _open(path)
    from pyarrow import fs

    if system.get_file_info(f"{root}/{LIST}").type == fs.FileType.NotFound:
        return {}
    with system.open_input_stream(f"{root}/{LIST}") as file:
        return json.loads(file.read())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_records(messages: DataFrame, path: str) -> None:
    """Messages as record files. A message without a source is written under an empty name. Rows are dealt by ranges of
    sources and times, so a source has one file, or one from each of the neighbouring tasks that share it: files grow
    with the sources, not with sources times tasks."""
    register(messages.sparkSession)
    order = ("source_uri", "log_time_ns", "sequence")
    messages.repartitionByRange(*order).sortWithinPartitions(*order).write.format(FORMAT).mode("append").option("path", path).save()


def read_records(spark: SparkSession, path: str, split_bytes: int = SPLIT) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("splitBytes", split_bytes).load(path)
