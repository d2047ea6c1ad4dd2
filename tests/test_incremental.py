"""The incremental audit and its sketches: parts equal the whole, repeats and crashes change nothing."""

import math
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from posefold.operators import accounting, audit, sketches
from posefold.streaming import incremental
from tests.build import JOINTS, message, messages, recorded


def rows_of(spark, n=90):
    rng, made = random.Random(2), []
    for i in range(n):
        joints = [q + rng.uniform(-0.3, 0.3) for q in JOINTS]
        arm = ("left", "right")[i % 2]
        pose = recorded(joints, arm)
        pose[3] += rng.choice([0, 0, 0.01, 0.05])
        if i % 9 == 0:
            pose = []
        made.append(message(f"/{arm}-arm-state", pose, joints if i % 11 else [], n=i, source=f"fx://{i % 3}"))
    made += [message("/camera/top", n=200, source="fx://0"), message("/left-arm-state", error="bad", n=201, source="fx://2")]
    return messages(spark, made)


def comparable(topics):
    rows = topics.drop(*audit.SKETCHES).orderBy("source_uri", "topic").collect()
    return [tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r) for r in rows]


def test_parts_equal_the_whole(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = rows_of(spark)
    want = comparable(audit.topic_audit(audit.score_messages(rows)))
    thirds = [rows.where(F.col("sequence") % 3 == i) for i in (0, 1, 2)]  # every source in every part, one part at a time
    for i, part in enumerate(thirds):
        part.coalesce(1).write.parquet(f"{inbox}/day-{i}")
    got = incremental.audit_new_files(spark, f"{inbox}/day-*", out, files_per_batch=1)
    assert comparable(got) == want
    assert len(list((tmp_path / "out/state").glob("batch=*"))) == 3
    assert comparable(incremental.audit_new_files(spark, f"{inbox}/day-*", out)) == want

    again = comparable(incremental.stored_topics(spark, out))
    incremental.compact(spark, out)
    incremental.compact(spark, out)
    incremental.absorb(rows, 2, out)  # a batch that the base covers
    assert comparable(incremental.stored_topics(spark, out)) == again == want
    more = rows.withColumn("source_uri", F.lit("fx://new"))
    more.coalesce(1).write.parquet(f"{inbox}/day-9")
    both = incremental.audit_new_files(spark, f"{inbox}/day-*", out)
    assert comparable(both.where("source_uri <> 'fx://new'")) == want and both.count() == 16
    total = both.where("source_uri = 'fx://new'").agg(F.sum("messages")).first()[0]
    assert total == 90


def test_a_crash_inside_a_batch(spark, tmp_path, monkeypatch):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = rows_of(spark)
    rows.coalesce(1).write.parquet(inbox)
    whole = incremental._lines

    def dies(*args):
        raise OSError("gone")

    monkeypatch.setattr(incremental, "_lines", dies)
    with pytest.raises(StreamingQueryException):
        incremental.audit_new_files(spark, inbox, out)
    monkeypatch.setattr(incremental, "_lines", whole)
    with pytest.raises(FileNotFoundError):
        incremental.stored_topics(spark, out)
    assert comparable(incremental.audit_new_files(spark, inbox, out)) == comparable(audit.topic_audit(audit.score_messages(rows)))


def test_sketches_merge_to_the_quantiles_of_all(spark):
    rng = random.Random(8)
    rows = [(f"s{i % 5}", rng.choice("ab"), rng.gauss(0, 1)) for i in range(20_000)] + [("empty", "a", None)]
    frame = spark.createDataFrame(rows, "source_uri string, topic string, translation_m double").withColumn("rotation_deg", F.lit(0.0))
    topics = frame.groupBy("source_uri", "topic").agg(*audit.sketch_columns(sketches.SKETCH_K)).cache()
    probabilities = (0.01, 0.5, 0.9, 0.999)
    for keys in (["source_uri", "topic"], ["topic"], []):
        found = sketches.sketch_quantiles(topics, "translation", keys, probabilities)
        errors = sketches.rank_errors(found, frame, "translation_m", keys).collect()
        assert len(errors) == 4 * max(1, {2: 10, 1: 2}.get(len(keys), 1))
        assert all(r["rank_error"] <= sketches.RANK_ERROR for r in errors)
    # Merged in two steps, as files are before the corpus.
    files = sketches.merged_sketches(topics, ["source_uri"])
    assert files.count() == 6
    median = sketches.sketch_quantiles(files, "translation", [], (0.5,)).first()
    assert median["total"] == 20_000 and abs(median["value"]) < 0.1
    # Few values are kept whole: the estimates are the exact quantiles.
    few = frame.where("source_uri = 's0'").limit(500).cache()
    small = few.groupBy("source_uri").agg(*audit.sketch_columns(sketches.SKETCH_K))
    got = {r["probability"]: r["value"] for r in sketches.sketch_quantiles(small, "translation", ["source_uri"], (0.1, 0.5)).collect()}
    exact = accounting.residual_quantiles(few, "translation_m", ["source_uri"], (0.1, 0.5))
    assert {r["probability"]: r["value"] for r in exact.collect()} == got and not any(map(math.isnan, got.values()))
