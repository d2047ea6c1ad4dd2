"""The bucketed store: ordinals and order as from the plain table, and no shuffle of a payload."""

import pytest
from pyspark.sql import functions as F

from posefold.operators import recovery
from posefold.sources.store import is_store, store_messages
from tests.build import JOINTS, message, messages

NAMES = "source_uri string, source_sha256 string, task string, episode string"


def rows_of(spark, n=300):
    """A source with most rows, rows out of order, topics that are ignored, null times and ties."""
    made = []
    for i in range(n):
        topic = ("/left-arm-state", "/right-arm-action", "/camera/top")[i % 3]
        made.append(message(topic, [], JOINTS, n=97 * i % n, source=f"fx://{i % 4 if i % 5 == 0 else 0}"))
    made.append(message("/left-arm-state", [], JOINTS, n=5, source="fx://9"))
    return messages(spark, made).withColumn("log_time_ns", F.when(F.col("sequence") % 50 != 7, F.col("log_time_ns")))


def nodes(plan):
    """Class and output columns of every node of a physical plan."""
    out, children = plan.output(), plan.children()
    found = [(plan.getClass().getSimpleName(), {out.apply(i).name() for i in range(out.size())})]
    for i in range(children.size()):
        found += nodes(children.apply(i))
    return found


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_in_place_equals_moved(spark, tmp_path, broadcast):
    sources = spark.createDataFrame([(f"fx://{i}", "s", f"t{i}", "e") for i in range(4)], NAMES)
    plain = rows_of(spark)
    name = f"store_{'m' if broadcast == '-1' else 'b'}"
    stored = store_messages(plain, name, str(tmp_path / "store"), 8, slab_ns=40)
    assert is_store(stored) and not is_store(plain) and stored.select("slab").distinct().count() > 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = recovery.recovery_rows_in_place(stored, sources)
        moved = [columns for kind, columns in nodes(got._jdf.queryExecution().executedPlan()) if kind == "ShuffleExchangeExec"]
        assert moved and not any({"pose", "position", "q0"} & columns for columns in moved), moved
        placed = got.withColumns({"p": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    drop = ("pose_arm_local",)
    want = recovery.recovery_rows(plain, sources).drop(*drop)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got.drop(*drop)) == rows(want)
    # Inside a file, in order of source and ordinal.
    last = {}
    for r in sorted(placed, key=lambda r: r["at"]):
        key = (r["source_uri"], r["message_ordinal"])
        assert key > last.get(r["p"], ("", -1))
        last[r["p"]] = key
    assert len(last) > 2


def test_a_hot_source_lies_in_many_buckets(spark, tmp_path):
    rows = messages(spark, [message("/left-arm-state", [], JOINTS, n=i, source="fx://hot") for i in range(400)])
    stored = store_messages(rows, "store_hot", str(tmp_path / "hot"), 8, slab_ns=20)
    sizes = [r["n"] for r in stored.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < 200
