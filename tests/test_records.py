"""The record source: round trip, splits anywhere, filters before payloads, every kind of damage."""

import io
import random
import struct
import zlib
from pathlib import Path

from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.sources import records
from posefold.sources.records import SYNC, decode_chunk, encode_record, read_records, read_split, write_records
from tests.build import JOINTS, message, messages, recorded

TOPICS = tuple(C.ARM_TOPICS)
NAN = float("nan")


def rows_of(n=80):
    rng, made = random.Random(3), []
    for i in range(n):
        pose = rng.choice([recorded(), [], None, recorded()[:15], [NAN] + recorded()[1:], [None] + recorded()[1:], [float("inf")]])
        made.append(message(rng.choice([*TOPICS, "/camera/top", None]), pose, rng.choice([JOINTS, None, JOINTS[:5]]), n=i, source=f"fx://{i % 3}"))
    made.append(message(TOPICS[0], None, None, n=n, source="fx://0", error="broken"))
    return made


def plain(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_round_trip_and_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "CHUNK", 700)
    frame = messages(spark, rows_of()).withColumn("log_time_ns", F.when(F.col("sequence") % 9 != 0, F.col("log_time_ns")))
    want = plain(frame.withColumn("decode_error", F.when(F.col("decode_error").isNotNull(), "payload")))
    folder = str(tmp_path / "rec")
    write_records(frame.repartition(3), folder)
    for split in (records.SPLIT, 1000, 97):
        got = read_records(spark, folder, split)
        assert plain(got) == want
        assert got.schema == C.ARM_MESSAGES or got.columns == C.ARM_MESSAGES.names
    assert read_records(spark, folder, 97).rdd.getNumPartitions() > 50
    # Files that no commit lists are not read.
    (tmp_path / "rec/stray.rec").write_bytes(next((tmp_path / "rec").glob("*.rec")).read_bytes())
    assert read_records(spark, folder).count() == len(want)
    write_records(frame.limit(5), folder)
    assert read_records(spark, folder).count() == len(want) + 5
    assert read_records(spark, str(tmp_path / "none")).count() == 0


def test_filters_reach_the_envelopes(spark, tmp_path):
    folder = str(tmp_path / "rec")
    frame = messages(spark, rows_of())
    write_records(frame, folder)
    table = read_records(spark, folder)
    for condition in (F.col("topic").isin(*TOPICS[:2]), F.col("topic") == TOPICS[0], (F.col("topic") == TOPICS[1]) & (F.col("log_time_ns") >= 1020) & (F.col("log_time_ns") < 1060),
                      F.col("topic").isNull(), F.col("sequence") > 40):
        assert table.where(condition).count() == frame.where(condition).count()
    seen = []
    body = b"".join(encode_record(r) for r in frame.collect())
    list(decode_chunk(body, lambda head: seen.append(head) or head[0] == TOPICS[0]))
    assert len(seen) == 81


def test_damage(tmp_path, spark):
    frame = messages(spark, [message(TOPICS[0], recorded(), JOINTS, n=i) for i in range(40)])
    rows = frame.collect()
    one = [encode_record(r) for r in rows]

    def chunk(body):
        return SYNC + struct.pack(records._FRAME, len(body), zlib.crc32(len(body).to_bytes(4, "little"))) + body

    first, second = b"".join(one[:20]), b"".join(one[20:])
    sound = chunk(first) + chunk(second)

    def read(data):
        return [row for rows in read_split(io.BytesIO(data), "u", 0, len(data)) for row in rows]

    assert [r[-1] for r in read(sound)] == [None] * 40
    rng = random.Random(1)
    for _ in range(200):
        data = bytearray(sound)
        data[rng.randrange(len(data))] ^= 1 << rng.randrange(8)
        got = read(bytes(data))
        errors = [r for r in got if r[-1] is not None]
        good = [r for r in got if r[-1] is None]
        # No flipped bit goes unnoticed, none changes a record, none reaches the other chunk but through its marker.
        assert all(r in [("u", *x) for x in decode_chunk(first + second)] for r in good)
        assert len(good) < 40 and (errors or len(got) in (20, 0)) and len(got) <= 41
    head = bytearray(sound)
    at = len(SYNC) + 2 * 4 + 2
    head[at] ^= 0xFF  # the length of the first envelope
    got = read(bytes(head))
    assert [r[-1] for r in got] == ["chunk: the rest cannot be followed"] + [None] * 20
    assert read(sound[: len(chunk(first)) + 60])[-1][-1] is not None
    assert Path(tmp_path).exists()


def test_files_grow_with_sources(spark, tmp_path):
    """A source lies in one file, or in one from each neighbouring task, however many tasks the rows come from."""
    made = [message(TOPICS[i % 4], None, JOINTS, n=i, source=f"fx://{i % 40}") for i in range(800)]
    folder = str(tmp_path / "rec")
    write_records(messages(spark, made).repartition(8), folder)
    shared = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 40 <= len(records.listed_files(folder)) <= 40 + shared < 8 * 40
    assert read_records(spark, folder).count() == 800
