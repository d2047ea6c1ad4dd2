import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from build import JOINTS, derive, message, messages, recorded
from posefold import contracts as C
from posefold.functions.kinematics import FunctionKinematics
from posefold.operators import accounting, gates, recovery, series

GOOD = recorded()


def broken(joints, arms):
    raise RuntimeError("no model")


def sources(spark, uris=("fx://a",)):
    rows = [(u, "d" * 64, "task", "episode_1") for u in uris]
    return spark.createDataFrame(rows, "source_uri string, source_sha256 string, task string, episode string")


CASES = [
    ([], JOINTS, None, ("missing", "intact", "derived", "recovered", 14, True)),
    (GOOD, JOINTS, None, ("intact", "intact", "derived", "source_pose_intact", 7, False)),
    ([], JOINTS[:5], None, ("missing", "malformed", "not_attempted_invalid_joints", "unrecoverable_invalid_joints", 0, False)),
    (GOOD, JOINTS[:5], None, ("intact", "malformed", "not_attempted_invalid_joints", "source_pose_intact_invalid_joints", 1, False)),
    ([], JOINTS, broken, ("missing", "intact", "failure", "unrecoverable_fk_failure", 2, False)),
    (GOOD, JOINTS, broken, ("intact", "intact", "failure", "source_pose_intact_fk_failure", 3, False)),
]


@pytest.mark.parametrize("pose, position, fn, expected", CASES)
def test_outcomes(spark, pose, position, fn, expected):
    def fails(joints, arms):
        raise RuntimeError("no model")

    adapter = FunctionKinematics(fails) if fn else None
    df = messages(spark, [message(pose=pose, position=position, ordinal=0)])
    row = recovery.recovery_rows(df, sources(spark), adapter).first()
    found = tuple(row[n] for n in ("pose_status", "joint_status", "fk_status", "recovery_status", "status_mask", "recovered"))
    assert found == expected
    vector = row["pose_arm_local"]
    assert len(vector) == 7
    if expected[2] == "derived":
        matrix = np.reshape(derive(JOINTS), (4, 4))
        np.testing.assert_allclose(vector[:3], matrix[:3, 3], atol=1e-15)
    else:
        assert all(math.isnan(v) for v in vector)
    assert list(row.asDict()) == list(C.RECOVERY_COLUMNS)


def test_right_arm_stays_in_its_own_frame(spark):
    df = messages(spark, [message("/right-arm-state", [], JOINTS, ordinal=0)])
    row = recovery.recovery_rows(df, sources(spark)).first()
    assert row["arm"] == "right" and row["pose_arm_local"][1] == pytest.approx(derive(JOINTS)[7], abs=1e-15)


def test_stored_ordinals_are_kept_and_absent_ones_filled(spark):
    stored = [message(pose=[], position=JOINTS, n=n, ordinal=o) for n, o in ((5, 0), (1, 1))]
    rows = recovery.recovery_rows(messages(spark, stored), sources(spark)).collect()
    assert {r["sequence"]: r["message_ordinal"] for r in rows} == {5: 0, 1: 1}
    absent = [message(pose=[], position=JOINTS, n=n) for n in (5, 1)] + [message("/camera/top", n=0)]
    rows = recovery.recovery_rows(messages(spark, absent), sources(spark)).collect()
    assert {r["sequence"]: r["message_ordinal"] for r in rows} == {1: 0, 5: 1}


def test_histogram_has_totals(spark):
    rows = recovery.with_statuses(recovery.target_messages(messages(spark, [
        message(pose=[], position=JOINTS), message(pose=GOOD, position=JOINTS, n=1, source="fx://b"),
    ])))
    found = {(r["source_uri"], r["field"], r["status"]): r["n"] for r in recovery.status_histogram(rows).collect()}
    assert found[(None, "fk_status", "derived")] == 2
    assert found[("fx://b", "pose_status", "intact")] == 1


def test_facts_find_each_envelope_fault(spark):
    df = messages(spark, [message(pose=[], position=JOINTS, n=i, ordinal=i) for i in range(3)])
    faulty = df.withColumns({
        "log_time_ns": F.expr("IF(sequence = 0, NULL, log_time_ns)"),
        "publish_time_ns": F.expr("IF(sequence = 1, cast(-1 AS decimal(20,0)), publish_time_ns)"),
        "sequence": F.expr("IF(sequence = 2, 4294967296, sequence)"),
    })
    row = recovery.message_facts(faulty).first()
    assert (row["rows"], row["bad_log_time_ns"], row["bad_publish_time_ns"], row["bad_sequence"], row["unnumbered"]) == (3, 1, 1, 1, 0)
    top = df.withColumn("log_time_ns", F.lit(str(C.UINT64_MAX)).cast("decimal(20,0)"))
    assert recovery.message_facts(top).first()["bad_log_time_ns"] == 0


def test_adapter_in_another_frame_is_refused(spark):
    shared = FunctionKinematics(broken, frame="shared_bimanual")
    with pytest.raises(ValueError):
        recovery.with_statuses(recovery.target_messages(messages(spark, [message()])), shared)


def files(spark, rows):
    names = ("source_uri", "messages", "invalid_pose", "missing_pose", "recoverable_invalid_pose", "unrecoverable_invalid_pose")
    return spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'source_uri' else 'long'}" for n in names))


@pytest.mark.parametrize("row, decision, reason", [
    (("a", 8, 0, 0, 0, 0), "intact", None),
    (("a", 8, 8, 8, 8, 0), "selected", None),
    (("a", 8, 4, 4, 4, 0), "refused", "mixed_intact_and_invalid"),
    (("a", 8, 8, 8, 7, 1), "refused", "not_all_recoverable"),
    (("a", 8, 8, 7, 8, 0), "refused", "not_literally_missing"),
])
def test_release_decisions(spark, row, decision, reason):
    facts = gates.release_facts(files(spark, [row]))
    found = facts.first()
    assert (found["decision"], found["reason"]) == (decision, reason)
    if decision == "selected":
        gates.require(gates.release_gate(facts))
    else:
        with pytest.raises(gates.Refused):
            gates.require(gates.release_gate(facts))


@pytest.mark.parametrize("given, session, conflict, expected", [
    ("mine", "u1", False, ("mine", "supplied", False)),
    (None, "u1", False, ("episode_u1", "session", False)),
    (None, "episode_u1", False, ("episode_u1", "session", False)),
    (None, None, None, ("episode_7", "path", False)),
    (None, "u1", True, ("episode_u1", "session", True)),
    ("mine", "u1", True, ("mine", "supplied", False)),
])
def test_episode_resolution(spark, given, session, conflict, expected):
    table = spark.createDataFrame(
        [("fx://a", "data/val/t/episode_7/episode.fo.mcap", None, given)],
        "source_uri string, path string, task string, episode string",
    )
    sessions = spark.createDataFrame([("fx://a", session, conflict)], "source_uri string, session_uuid string, conflicting boolean")
    row = recovery.resolve_sources(table, sessions.where("session_uuid IS NOT NULL")).first()
    assert (row["episode"], row["episode_from"], row["conflict"]) == expected
    assert row["task"] == "t"


def test_quarantine_and_accounting(spark):
    rows = recovery.with_statuses(recovery.target_messages(messages(spark, [
        message(pose=[], position=JOINTS), message(pose=[], position=[], n=1), message(pose=GOOD, position=JOINTS, n=2),
    ])))
    held = accounting.quarantine(rows).collect()
    assert [(r["sequence"], r["reason"]) for r in held] == [(1, "unrecoverable_invalid_joints")]
    channels = spark.createDataFrame([("fx://a", "/left-arm-state", 3), ("fx://a", "/camera/top", 9)], "source_uri string, topic string, n long")
    row = accounting.three_way_accounting(rows, channels).first()
    assert (row["observed_valid"], row["derived_valid"], row["refused"], row["reconciles"]) == (1, 1, 1, True)


def test_canaries_are_all_caught(spark):
    df = messages(spark, [message(pose=GOOD, position=JOINTS, n=i) for i in range(400)])
    report = accounting.canary_report(accounting.plant_canaries(df, every=10)).collect()
    assert all(r["rows"] == r["caught"] for r in report)
    assert {r["expected_class"] for r in report if r["planted"]} == {"missing", "malformed", "nonfinite"}


def test_joint_limits(spark):
    df = messages(spark, [message(position=[0.0, -0.1, 0.5, 0.0, 0.0, 3.0]), message(position=[0.0] * 6, n=1)])
    found = {r["joint"]: r["outside"] for r in accounting.joint_limit_violations(df).collect()}
    assert found == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_stride_series(spark):
    rows = [message(pose=GOOD, position=JOINTS, n=i) for i in range(7)] + [message("/left-arm-action", GOOD, JOINTS, n=9)]
    table = series.recorded_vs_derived(messages(spark, rows + [message(pose=[], position=JOINTS, n=20)]))
    sampled = series.stride_series(table, 3).orderBy("ordinal").collect()
    assert [r["sequence"] for r in sampled] == [0, 3, 6]
    row = series.series_summary(table, 3).first()
    assert (row["source_records"], row["sampled_records"]) == (7, 3)
    assert row["max_residual_m"] == pytest.approx(0, abs=1e-14)
    with pytest.raises(ValueError):
        series.stride_series(table, 0)


def test_strided_states_equal_the_strided_series(spark):
    rows = messages(spark, [message(pose=GOOD, position=JOINTS, n=i, source=f"fx://{i % 2}") for i in range(23)])
    columns = ["source_uri", "arm", "ordinal", "sequence", "rec_x", "der_x", "residual_m"]
    late = series.stride_series(series.recorded_vs_derived(rows), 4).select(*columns)
    early = series.strided_states(rows, 4).select(*columns)
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect())) and early.count() == 6


@pytest.mark.parametrize("limit", [None, 1])
def test_sidecar_order_does_not_depend_on_the_broadcast_limit(spark, monkeypatch, limit):
    from posefold.operators import scale

    rows = [message("/left-arm-state", [], JOINTS, n=97 * i % 50, source=f"fx://{i % 3}") for i in range(50)]
    if limit is not None:
        whole = scale.lookup_join
        monkeypatch.setattr(scale, "lookup_join", lambda *a, **k: whole(*a, **(k | {"limit": limit})))
        monkeypatch.setattr(recovery, "lookup_join", lambda *a, **k: whole(*a, **(k | {"limit": limit})))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sources = spark.createDataFrame(
            [(f"fx://{i}", "s", "t", "e") for i in range(3)], "source_uri string, source_sha256 string, task string, episode string"
        )
        table = recovery.recovery_rows(messages(spark, rows), sources, ordered=True)
        placed = table.select("source_uri", "message_ordinal", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"))
        found = [tuple(r)[:2] for r in sorted(placed.collect(), key=lambda r: r["at"])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 50 and found == sorted(found)


def test_joint_limits_can_refuse(spark):
    from posefold.functions.kinematics import SIX_JOINT_ARM

    far = [JOINTS[0], 9.0, *JOINTS[2:]]
    rows = recovery.target_messages(messages(spark, [message(pose=[], position=q, n=i) for i, q in enumerate((JOINTS, far))]))
    found = {r["sequence"]: r["recovery_status"] for r in recovery.with_statuses(rows, limits=SIX_JOINT_ARM).collect()}
    assert found[1] == "unrecoverable_invalid_joints"
    kept = {r["sequence"]: r["recovery_status"] for r in recovery.with_statuses(rows).collect()}
    assert kept[1] == "recovered"
