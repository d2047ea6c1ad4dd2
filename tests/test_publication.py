"""One publication record: observed counts, tables before the manifest, one read-back of the written rows."""

import json

import pytest
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.operators import gates, recovery
from posefold.plans import jobs
from posefold.sources import sinks
from tests.build import JOINTS, message, messages, recorded

URIS = ["fx://a", "fx://b", "fx://c"]


def rows_of(spark, n=60):
    made = []
    for i in range(n):
        pose = recorded() if i % 3 else []
        joints = JOINTS if i % 7 else [0.1] * 5
        made.append(message("/left-arm-state", pose, joints, n=i, source=URIS[i % 3 if i % 4 else 0]))
    return messages(spark, made)


def sources_of(spark):
    rows = [(uri, f"data/val/task_t/episode_{i}/e.fo.mcap", "ab" * 32, 5) for i, uri in enumerate(URIS)]
    return spark.createDataFrame(rows, "source_uri string, path string, sha256 string, size_bytes long")


def scans_of(spark, folder, since):
    """SQL executions after ``since`` whose plan scans ``folder``, by what they scan."""
    found = []
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    for i in range(executions.size()):
        if executions.apply(i).executionId() <= since:
            continue
        plan = executions.apply(i).physicalPlanDescription()
        if any(line.startswith("Location") and folder in line for line in plan.splitlines()):
            found.append("binary" if "Scan binaryFile" in plan else "rows")
    return found


def executions(spark):
    """The last SQL execution so far; the store keeps the newest only."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((listed.apply(i).executionId() for i in range(listed.size())), default=-1)


@pytest.mark.parametrize("per_source", [True, False])
def test_counts_are_observed_by_the_write(spark, tmp_path, per_source):
    out = str(tmp_path / "out")
    messages_ = rows_of(spark)
    since = executions(spark)
    manifest = jobs.run_recovery(messages_, sources_of(spark), out, per_source_counts=per_source)
    executions(spark)
    scans = scans_of(spark, f"data-{manifest['run_id']}", since)
    assert sorted(scans) == (["binary", "rows"] if per_source else ["binary"])

    table = sinks.read_published(spark, out)
    internal = table.select(*(F.col(f"`{C.RECOVERY_COLUMNS[n]}`").alias(n) for n in ("source_uri", *recovery.STATUSES)))
    want = {tuple(r) for r in recovery.status_histogram(internal).select("source_uri", "field", "status", "n").collect()}
    got = {tuple(r) for r in sinks.read_beside(spark, out, "status_counts").select("source_uri", "field", "status", "n").collect()}
    assert got == (want if per_source else {r for r in want if r[0] is None})
    details = json.loads(manifest["details"])
    assert {tuple(name.split("|")): n for name, n in details["counts"].items() if "|" in name and n} == {r[1:3]: r[3] for r in want if r[0] is None}
    assert gates.content_digest(table).first()["digest"] == manifest["content_digest"]
    kept = {r["source_uri"]: r["target_messages"] for r in sinks.read_beside(spark, out, "provenance").collect()}
    assert sum(kept.values()) == manifest["rows"] == 60 and set(kept) == set(URIS)


def test_a_crash_before_the_manifest_leaves_nothing_readable(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")

    def dies(*args, **kwargs):
        raise OSError("disk gone")

    monkeypatch.setattr(sinks, "relative_parts", dies)
    with pytest.raises(OSError):
        jobs.run_recovery(rows_of(spark), sources_of(spark), out)
    monkeypatch.undo()
    for read in (lambda: sinks.read_published(spark, out), lambda: sinks.read_beside(spark, out, "status_counts")):
        with pytest.raises(gates.Refused, match="no manifest"):
            read()
    # The tables had been written by then: whoever finds a manifest line finds them.
    assert len(list((tmp_path / "out").glob("provenance-*"))) == len(list((tmp_path / "out").glob("status_counts-*"))) == 1
    manifest = jobs.run_recovery(rows_of(spark), sources_of(spark), out)
    assert set(json.loads(manifest["details"])["tables"]) == {"status_counts", "provenance"}


def test_unknown_status_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(recovery.STATUS_WORDS, "fk_status", ("derived",))
    with pytest.raises(gates.Refused, match="every_fk_status_is_known"):
        jobs.run_recovery(rows_of(spark), sources_of(spark), str(tmp_path / "out"))


def test_column_metadata_is_compared_after_reading_back(spark, tmp_path, monkeypatch):
    table = spark.range(3).select(F.col("id").alias("n", metadata={"units": "metres"}))
    sinks.publish(table, str(tmp_path / "kept"), "v", 3, {})
    assert sinks.read_published(spark, str(tmp_path / "kept")).schema["n"].metadata == {"units": "metres"}

    class Blind:
        """A reader that loses the description of the columns."""

        def __init__(self, frame):
            self.schema = frame.select(F.col("n").alias("n", metadata={})).schema

    real = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path, *a: Blind(real(self, path)) if "/data-" in path else real(self, path, *a))
    with pytest.raises(gates.Refused, match="staged schema"):
        sinks.publish(table, str(tmp_path / "lost"), "v", 3, {})
