"""File skipping: the same rows from fewer files, whatever the index knows."""

from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.sources.messages import read_arm_messages
from posefold.sources.skipping import index_files, needed_files, read_index, read_needed
from tests.build import JOINTS, message, messages

TOPICS = tuple(C.ARM_TOPICS)


def write(spark, folder, rows):
    messages(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))


def rows_of(df):
    return sorted(map(str, df.drop("pose").collect()))


def test_only_needed_files_are_opened(spark, tmp_path):
    folder, index = tmp_path / "messages", str(tmp_path / "index")
    for i, topic in enumerate((*TOPICS, "/camera/top")):
        write(spark, folder, [message(topic, [], JOINTS, n=100 * i + j, source=f"fx://{i}") for j in range(5)])
    assert index_files(spark, str(folder), index) == 5 and index_files(spark, str(folder), index) == 0
    plain = read_arm_messages(spark, str(folder))
    for topic in TOPICS:
        got = read_needed(spark, str(folder), index, (topic,))
        assert len(got.inputFiles()) == 1
        assert rows_of(got) == rows_of(plain.where(F.col("topic") == topic))
    assert len(read_needed(spark, str(folder), index).inputFiles()) == 4
    assert rows_of(read_needed(spark, str(folder), index)) == rows_of(plain)
    late = read_needed(spark, str(folder), index, since_ns=1200, until_ns=1302)
    assert len(late.inputFiles()) == 2 and rows_of(late) == rows_of(plain.where("log_time_ns >= 1200 AND log_time_ns < 1302"))
    one = read_needed(spark, str(folder), index, source_uri="fx://2")
    assert len(one.inputFiles()) == 1 and one.count() == 5
    assert read_needed(spark, str(folder), index, source_uri="fx://none").count() == 0


def test_unknown_changed_and_unusable_files_are_opened(spark, tmp_path):
    folder, index = tmp_path / "messages", str(tmp_path / "index")
    write(spark, folder, [message("/camera/top", n=1), message("/camera/top", n=2, error="broken")])
    write(spark, folder, [message("/camera/top", n=3)])
    assert needed_files(spark, str(folder), index).count() == 2 and read_index(spark, index) is None
    index_files(spark, str(folder), index)
    got = read_needed(spark, str(folder), index, TOPICS[:1])
    assert len(got.inputFiles()) == 1 and got.count() == 1  # the undecodable row has to be counted
    write(spark, folder, [message(TOPICS[0], [], JOINTS, n=4)])
    assert read_needed(spark, str(folder), index, TOPICS[:1]).count() == 2
    # A file replaced under its name is another file.
    quiet = [f for f in folder.glob("part-*") if f.stat().st_size][0]
    fresh = tmp_path / "fresh"
    write(spark, fresh, [message(TOPICS[0], [], JOINTS, n=i) for i in range(7)])
    target = next(f for f in folder.glob("part-*") if "camera" in str(spark.read.parquet(str(f)).first()["topic"]) and spark.read.parquet(str(f)).count() == 1)
    target.write_bytes(next(fresh.glob("part-*")).read_bytes())
    (folder / f".{target.name}.crc").unlink(missing_ok=True)
    assert quiet.exists() and read_needed(spark, str(folder), index, TOPICS[:1]).count() == 9
