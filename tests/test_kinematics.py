import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from build import derive
from posefold.functions.kinematics import (
    SIX_JOINT_ARM,
    ChainKinematics,
    FunctionKinematics,
    with_chain_pose,
)
from posefold.functions.rotation import homogeneous, matrix_from_quaternion, pose_vector, with_quaternion

# Two published records (six joints and the recorded 4x4 transform).
LEFT = (
    [-0.48161287861448265, 0.7116426337071786, 0.7040131227588304,
     -0.7028686961165764, -0.012016479743651942, -0.13103685053788006],
    [-0.632531141717365, 0.3756759502397681, 0.6773270518510042, 0.2229318922544835,
     0.18317820509999394, 0.9222451495056406, -0.3404550328452526, -0.11421321941931482,
     -0.7525623561765962, -0.09127685700529321, -0.6521644236242606, 0.1754101887061787,
     0.0, 0.0, 0.0, 1.0],
)
RIGHT_SHARED = (
    [0.43926909285114846, 1.0530632486457616, 0.7162203402761875,
     -0.7997634851606019, -0.03337911039902686, 0.0997558556496525],
    [-0.8605964623532097, -0.35379918654529247, 0.3663329968553596, 0.21752706566379915,
     -0.2944080765331712, 0.9325444245486542, 0.20900904457763797, -0.5015181464597505,
     -0.41556902369784254, 0.0720210513885209, -0.906705770743582, 0.08778088368163128,
     0.0, 0.0, 0.0, 1.0],
)
ANGLES = [f"q[{i}]" for i in range(6)]


def frame(spark, rows):
    return spark.createDataFrame([(i, list(map(float, q))) for i, q in enumerate(rows)], "id int, q array<double>")


@pytest.mark.parametrize("joints, transform, y", [(*LEFT, 0.0), (*RIGHT_SHARED, -0.61)])
def test_chain_reproduces_recorded_transform(spark, joints, transform, y):
    posed = with_chain_pose(frame(spark, [joints]), ANGLES, "p_").withColumn("p_y", F.col("p_y") + y)
    found = posed.select(homogeneous("p_").alias("m")).first()["m"]
    np.testing.assert_allclose(found, transform, rtol=0, atol=2e-15)


def test_chain_equals_plain_product_on_random_angles(spark):
    angles = np.random.default_rng(7).uniform(-3, 3, (200, 6))
    rows = with_chain_pose(frame(spark, angles), ANGLES, "p_").select("id", homogeneous("p_").alias("m")).collect()
    for row in rows:
        np.testing.assert_allclose(row["m"], derive(angles[row["id"]]), rtol=0, atol=5e-15)


def test_quaternion_is_unit_canonical_and_round_trips(spark):
    angles = np.random.default_rng(3).uniform(-3, 3, (300, 6))
    posed = with_chain_pose(frame(spark, angles), ANGLES, "p_")
    posed = with_quaternion(posed, "p_", drop_rotation=False)
    again = [F.expr(text).alias(f"again_{name}") for name, text in matrix_from_quaternion("p_").items()]
    for row in posed.select("*", *again).collect():
        assert abs(sum(row[f"p_{n}"] ** 2 for n in ("qw", "qx", "qy", "qz")) - 1) < 1e-15
        assert row["p_qw"] >= 0
        for i in range(3):
            for j in range(3):
                assert row[f"again_r{i}{j}"] == pytest.approx(row[f"p_r{i}{j}"], abs=1e-14)


@pytest.mark.parametrize("axis", [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0.6, 0.8, 0), (0, 0.6, -0.8)])
def test_half_turns_pick_the_right_branch(spark, axis):
    x, y, z = axis
    entries = [[2 * a * b - (1 if i == j else 0) for j, b in enumerate(axis)] for i, a in enumerate(axis)]
    names = {f"p_r{i}{j}": float(entries[i][j]) for i in range(3) for j in range(3)}
    df = spark.range(1).select(*(F.lit(v).alias(n) for n, v in names.items()))
    row = with_quaternion(df, "p_").first()
    found = np.array([row[f"p_{n}"] for n in ("qw", "qx", "qy", "qz")])
    expected = np.array([0, x, y, z], dtype=float)
    assert min(abs(found - expected).max(), abs(found + expected).max()) < 1e-15


def test_generated_code_stays_within_the_jit_limit(spark):
    import re

    from posefold.operators.augment import augment_frames
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = augment_frames(spark.range(4).selectExpr(
            "'a' AS source_uri", "id AS source_row", "id AS episode_index", "id AS frame_index", "id AS index",
            "double(id) AS timestamp", "array_repeat(double(id), 14) AS state", "array_repeat(double(id), 14) AS action",
        ).repartition(2))._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_function_adapter_marks_only_the_failing_row(spark):
    def picky(joints, arms):
        if (joints[:, 0] > 5).any():
            raise RuntimeError("out of range")
        return np.stack([np.r_[q[:3], 2.0, 0, 0, 0] for q in joints])

    df = frame(spark, [[1, 2, 3, 0, 0, 0], [9, 0, 0, 0, 0, 0], [4, 5, 5, 0, 0, 0]]).coalesce(1)
    adapter = FunctionKinematics(picky, digest="d", revision="r")
    rows = adapter.attach(df, ANGLES, "p_", "id <> 2", "'left'").orderBy("id").collect()
    assert [r["p_ok"] for r in rows] == [True, False, False]
    assert rows[0]["p_x"] == 1.0 and rows[0]["p_r00"] == 1.0
    assert adapter.model_name == "picky"


@pytest.mark.parametrize("bad", [[0.0] * 7, [math.nan] * 7, [1.0] * 6])
def test_function_adapter_refuses_unusable_poses(spark, bad):
    adapter = FunctionKinematics(lambda joints, arms: np.array([bad] * len(joints)))
    row = adapter.attach(frame(spark, [[0] * 6]), ANGLES, "p_", "true").first()
    assert row["p_ok"] is False


def test_function_adapter_pose_is_canonical(spark):
    adapter = FunctionKinematics(lambda j, a: np.array([[1, 2, 3, -2.0, 0, 0, 0]] * len(j)))
    posed = adapter.attach_vector(frame(spark, [[0] * 6]), ANGLES, "p_", "true")
    assert posed.select(pose_vector("p_").alias("v")).first()["v"] == [1, 2, 3, 1, 0, 0, 0]


def test_identity_changes_with_any_constant():
    from dataclasses import replace

    other = replace(SIX_JOINT_ARM, site_offset=(0, 0, 0.2))
    assert other.digest != SIX_JOINT_ARM.digest
    assert ChainKinematics().model_name.endswith(SIX_JOINT_ARM.digest)
    with pytest.raises(ValueError):
        FunctionKinematics(len, frame="world")


def test_function_adapter_is_called_on_halves():
    """One row that raises costs some calls, not one call for every row beside it."""
    import pandas as pd

    from posefold.functions.kinematics import _call_rows

    calls = []

    def model(joints, arms):
        calls.append(len(joints))
        if (joints[:, 0] == 700).any():
            raise ValueError("out of reach")
        poses = np.zeros((len(joints), 7))
        poses[:, 0], poses[:, 3] = joints[:, 0], np.where(joints[:, 0] == 3, np.nan, -2.0)
        return poses

    values = pd.Series([None if i == 5 else np.full(6, float(i)) for i in range(1000)])
    got = _call_rows(model, values, pd.Series(["left"] * 1000))
    assert [i for i, pose in enumerate(got) if pose is None] == [3, 5, 700]
    assert all(pose.tolist() == [i, 0, 0, 1, 0, 0, 0] for i, pose in enumerate(got) if pose is not None)
    assert len(calls) < 30
