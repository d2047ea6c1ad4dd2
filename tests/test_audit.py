import math
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark.sql import functions as F

from build import JOINTS, message, messages, recorded
from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions.kinematics import FunctionKinematics
from posefold.operators import audit, cohorts, reconcile

GOOD = recorded()
NAN, INF = math.nan, math.inf


def changed(index, value):
    pose = list(GOOD)
    pose[index] = value
    return pose


POSES = [
    (None, "missing"),
    ([], "missing"),
    (GOOD[:15], "malformed"),
    (GOOD[:14] + [NAN], "malformed"),
    (GOOD + [0.0], "malformed"),
    (changed(0, NAN), "nonfinite"),
    (changed(3, INF), "nonfinite"),
    (changed(15, None), "nonfinite"),
    (changed(12, 0.5), "malformed"),
    (changed(12, 9e-6), "intact"),
    (changed(13, 1.1e-5), "malformed"),
    ([v * 1.01 if i % 4 < 3 and i < 12 else v for i, v in enumerate(GOOD)], "malformed"),
    ([-v if i % 4 == 0 and i < 12 else v for i, v in enumerate(GOOD)], "malformed"),
    (GOOD, "intact"),
    ([1e200 if i < 3 else v for i, v in enumerate(GOOD)], "malformed"),
]
POSITIONS = [
    (None, "missing"), ([], "missing"), (JOINTS[:5], "malformed"), (JOINTS + [0.0], "malformed"),
    ([NAN] + JOINTS[1:], "nonfinite"), ([None] + JOINTS[1:], "nonfinite"), ([-INF] + JOINTS[1:], "nonfinite"),
    (JOINTS, "intact"),
]


def test_pose_classes(spark):
    df = messages(spark, [message(pose=p, position=JOINTS, n=i) for i, (p, _) in enumerate(POSES)])
    found = {r["sequence"]: r["pose_status"] for r in K.pose_status_only(df).collect()}
    assert [found[i] for i in range(len(POSES))] == [status for _, status in POSES]


def test_joint_classes(spark):
    df = messages(spark, [message(pose=[], position=p, n=i) for i, (p, _) in enumerate(POSITIONS)])
    found = {r["sequence"]: r["joint_status"] for r in K.joint_status_only(df).collect()}
    assert [found[i] for i in range(len(POSITIONS))] == [status for _, status in POSITIONS]


def test_finiteness_of_any_length(spark):
    rows = [([1.0, 2.0], True), ([], True), ([1.0, None], False), ([NAN], False), ([INF], False)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "a array<double>")
    found = df.select(K.vector_is_finite("a").alias("ok"), reconcile._holds_nonfinite("a").alias("bad")).collect()
    assert [r["ok"] for r in found] == [ok for _, ok in rows]
    assert [r["bad"] for r in found] == [not ok for _, ok in rows]


def topics_of(df, **options):
    return {r["topic"]: r for r in audit.topic_audit(audit.score_messages(df, **options)).collect()}


def test_three_kinds_of_invalid_pose_are_recoverable(spark):
    rows = [message(pose=p, position=JOINTS, n=i) for i, p in enumerate(([], GOOD[:15], changed(0, NAN)))]
    row = topics_of(messages(spark, rows))["/left-arm-state"]
    assert (row["missing_pose"], row["malformed_pose"], row["nonfinite_pose"]) == (1, 1, 1)
    assert (row["recoverable_invalid_pose"], row["unrecoverable_invalid_pose"]) == (3, 0)


def test_bad_joints_make_a_bad_pose_unrecoverable(spark):
    rows = [message(pose=[], position=JOINTS[:5]), message(pose=GOOD, position=JOINTS[:5], n=1)]
    row = topics_of(messages(spark, rows))["/left-arm-state"]
    assert (row["unrecoverable_invalid_pose"], row["malformed_joints"], row["fk_compared"]) == (1, 2, 0)


def test_other_base_offset_is_seen_and_measured(spark):
    rows = [message("/right-arm-state", recorded(arm="right", y=-0.8), JOINTS)]
    row = topics_of(messages(spark, rows))["/right-arm-state"]
    assert row["translation_max_m"] == pytest.approx(0.19, abs=1e-12)
    assert row["fk_outside_tolerance"] == 1
    offsets = [row[f"offset_mean_{a}"] for a in "xyz"]
    assert offsets == pytest.approx([0, -0.8, 0], abs=1e-12)
    assert row["offset_std_y"] == pytest.approx(0, abs=1e-12)
    moved = topics_of(messages(spark, rows), right_offset=(0, -0.8, 0))["/right-arm-state"]
    assert moved["fk_outside_tolerance"] == 0


def test_tolerance_is_strict_and_adjustable(spark):
    pose = changed(3, GOOD[3] + 0.02)
    df = messages(spark, [message(pose=pose, position=JOINTS)])
    assert topics_of(df)["/left-arm-state"]["fk_outside_tolerance"] == 1
    assert topics_of(df, translation_tolerance_m=0.03)["/left-arm-state"]["fk_outside_tolerance"] == 0


def test_empty_topics_have_zero_rows_and_null_statistics(spark):
    df = messages(spark, [message(pose=GOOD, position=JOINTS), message("/camera/top", n=1)])
    rows = topics_of(df)
    assert list(rows) == list(C.ARM_TOPICS)
    empty = rows["/right-arm-action"]
    assert (empty["messages"], empty["offset_count"], empty["offset_mean_x"], empty["translation_mean_m"]) == (0, 0, None, None)
    topics = audit.topic_audit(audit.score_messages(df))
    assert [r["topic"] for r in audit.missing_topics(topics).orderBy("topic_order").collect()] == list(C.ARM_TOPICS)[1:]
    file = audit.file_audit(topics).first()
    assert (file["ignored_messages"], file["missing_topic_count"], file["passed"]) == (1, 3, False)


def clean_file(source="fx://a"):
    return [
        message(t, recorded(arm=arm), JOINTS, n=i, source=source)
        for i, (t, (arm, _)) in enumerate(C.ARM_TOPICS.items())
    ]


def test_verdict_and_batch(spark):
    bad = clean_file("fx://b")[:3] + [message("/right-arm-action", [], JOINTS, n=3, source="fx://b")]
    files = audit.audit_messages(messages(spark, clean_file() + bad))[1]
    assert {r["source_uri"]: r["passed"] for r in files.collect()} == {"fx://a": True, "fx://b": False}
    batch = audit.batch_audit(files).first()
    assert (batch["files"], batch["messages"], batch["invalid_pose"], batch["passed"]) == (2, 8, 1, False)


def test_undecodable_rows_are_counted_only(spark):
    rows = clean_file() + [message("/left-arm-state", error="broken", n=9), message(None, GOOD, JOINTS, n=10)]
    file = audit.audit_messages(messages(spark, rows))[1].first()
    assert (file["messages"], file["decode_errors"], file["passed"], file["issue_count"]) == (4, 2, False, 2)


def test_failing_adapter_is_a_failure_not_a_crash(spark):
    def broken(joints, arms):
        raise RuntimeError("no model")

    rows = [message(pose=[], position=JOINTS), message(pose=GOOD, position=JOINTS, n=1)]
    row = topics_of(messages(spark, rows), kinematics=FunctionKinematics(broken))["/left-arm-state"]
    assert (row["fk_failures"], row["unrecoverable_invalid_pose"], row["fk_compared"]) == (2, 1, 0)


def test_adapter_without_local_frame_has_residuals_but_no_offsets(spark):
    shared = FunctionKinematics(
        lambda j, a: np.array([[GOOD[3], GOOD[7], GOOD[11], 1.0, 0, 0, 0]] * len(j)), frame="shared_bimanual"
    )
    row = topics_of(messages(spark, [message(pose=GOOD, position=JOINTS)]), kinematics=shared)["/left-arm-state"]
    assert (row["fk_compared"], row["offset_count"]) == (1, 0)
    assert row["translation_max_m"] == 0


def test_issue_sample_keeps_the_first_and_the_true_count(spark):
    rows = [message(pose=[], position=JOINTS[:5], n=i) for i in range(6)]
    df = messages(spark, rows)
    scored = audit.score_messages(df, details=True, keep=("sequence",))
    files = audit.file_audit(audit.topic_audit(scored))
    sample = audit.issue_sample(audit.issues(scored), files, 3).orderBy("sequence", "code").collect()
    assert [(r["sequence"], r["code"]) for r in sample] == [(0, "malformed_joints"), (0, "missing_pose"), (1, "missing_pose")]
    assert {(r["issue_count"], r["truncated"]) for r in sample} == {(12, True)}
    assert audit.issue_sample(audit.issues(scored), files, 0).count() == 0


@pytest.mark.parametrize("options", [{"translation_tolerance_m": -1.0}, {"rotation_tolerance_deg": NAN}])
def test_bad_parameters_are_refused(spark, options):
    with pytest.raises(ValueError):
        audit.score_messages(messages(spark, [message()]), **options)
    with pytest.raises(ValueError):
        audit.check_tolerances(0.0, 0.0, -1)


def stored(spark, rows):
    """Topic rows of stored offset summaries: (source, topic order, n, mean y, std y)."""
    data = [
        (s, "right", n, *(v for m, d in ((0.0, 0.0), (y, sd), (0.0, 0.0)) for v in ((m, d, m - d, m + d) if n else (None,) * 4)))
        for s, n, y, sd in rows
    ]
    names = ", ".join(f"offset_{k}_{a} double" for a in "xyz" for k in ("mean", "std", "min", "max"))
    return spark.createDataFrame(data, f"source_uri string, arm string, offset_count long, {names}")


@pytest.mark.parametrize("keys", [["source_uri"], ["arm"], []])
def test_merge_of_stored_statistics(spark, keys):
    table = stored(spark, [("a", 1, -0.61, 0.0), ("a", 3, -0.63, 0.0), ("a", 0, None, None)])
    row = cohorts.merge_offsets(table, keys).first()
    assert row["offset_count"] == 4
    assert row["offset_mean_y"] == pytest.approx(-0.625)
    assert row["offset_std_y"] == pytest.approx(math.sqrt(0.000075))
    assert (row["offset_min_y"], row["offset_max_y"]) == (-0.63, -0.61)


def test_cohorts_of_forty_files(spark):
    rows = [(f"f{i:02d}", 2, -0.8 if i < 2 else -0.61, 0.0) for i in range(32)] + [(f"f{i}", 0, None, None) for i in range(32, 40)]
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(stored(spark, rows)))
    found = [(r["cohort_y"], r["files"], r["pose_records"]) for r in cohorts.rig_cohorts(assigned).collect()]
    assert found == [(None, 8, 0), (-0.8, 2, 4), (-0.61, 30, 60)]
    tasks = cohorts.cohort_tasks(assigned.withColumn("task", F.lit("t"))).collect()
    assert [(r["cohort_y"], r["files"]) for r in tasks] == [(-0.8, 2), (-0.61, 30)]


def test_shared_frame_needs_an_observed_cohort(spark):
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(stored(spark, [("a", 2, -0.8, 0.0), ("b", 0, None, None)])))
    derived = spark.createDataFrame(
        [("a", "right", True, 1.0, 1.0, 1.0), ("a", "left", True, 1.0, 1.0, 1.0), ("b", "right", True, 1.0, 1.0, 1.0), ("a", "right", False, None, None, None)],
        "source_uri string, arm string, fk_ok boolean, fk_x double, fk_y double, fk_z double",
    )
    rows = cohorts.shared_frame_or_refusal(derived, assigned).collect()
    got = sorted((r["source_uri"], r["arm"], r["fk_ok"], r["shared_y"] and round(r["shared_y"], 9), r["refusal"] or "") for r in rows)
    assert got == [("a", "left", True, 1.0, ""), ("a", "right", False, None, "no_arm_local_pose"),
                   ("a", "right", True, 0.2, ""), ("b", "right", True, None, "cohort_unobserved")]
