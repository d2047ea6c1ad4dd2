"""Names, layouts and schemas shared by every operator.

Everything here is a fixed value of the data contract: topic names, status words, mask bits, column
orders and feature names. Nothing in this module touches Spark data.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import types as T

# The four arm topics and what each one carries, in contract order.
ARM_TOPICS = MappingProxyType(
    {
        "/left-arm-state": ("left", "state"),
        "/right-arm-state": ("right", "state"),
        "/left-arm-action": ("left", "action"),
        "/right-arm-action": ("right", "action"),
    }
)
PLOT_SUFFIX = ".plot"
POSE_LENGTH = 16
JOINT_COUNT = 6
VECTOR_LENGTH = 14
POSE_LAYOUT = ("x_m", "y_m", "z_m", "qw", "qx", "qy", "qz")

# Status words and the bit each fact occupies.
POSE_STATES = ("missing", "malformed", "nonfinite", "intact")
RECOVERY_BITS = MappingProxyType(
    {"source_pose_intact": 0, "joints_intact": 1, "fk_valid": 2, "recovered": 3}
)
LIMB_BITS = MappingProxyType(
    {
        "observation.left_arm": 0,
        "observation.right_arm": 1,
        "action.left_arm": 2,
        "action.right_arm": 3,
    }
)

# Classifier and residual tolerances.
BOTTOM_ROW_ATOL = 1e-5
ROTATION_ATOL = 1e-4
TRANSLATION_TOLERANCE_M = 1e-5
ROTATION_TOLERANCE_DEG = 1e-3
ISSUE_SAMPLE_LIMIT = 100
COHORT_DECIMALS = 2
DEFAULT_RIGHT_OFFSET = (0.0, -0.61, 0.0)

UINT32_MAX = (1 << 32) - 1
UINT64_MAX = (1 << 64) - 1

AUDIT_SCHEMA_VERSION = "telemetry-geometry-audit/v1"
RECOVERY_SCHEMA_VERSION = "raw-pose-recovery/v1"
SIDECAR_SCHEMA_VERSION = "frame-pose-sidecar/v1"


@dataclass(frozen=True)
class Limb:
    """One arm's slice of a 14-value vector column."""

    name: str
    vector: str
    arm: str
    start: int  # 0-based first joint; six joints follow
    bit: int

    @property
    def pose(self) -> str:
        return f"{self.name.replace('.', '_')}_pose"


LIMBS = (
    Limb("observation.left_arm", "state", "left", 0, 0),
    Limb("observation.right_arm", "state", "right", 7, 1),
    Limb("action.left_arm", "action", "left", 0, 2),
    Limb("action.right_arm", "action", "right", 7, 3),
)


# Ordered names of both vectors.
FEATURE_NAMES = MappingProxyType(
    {
        "observation.state": (
            "left_arm_joint_1", "left_arm_joint_2", "left_arm_joint_3", "left_arm_joint_4",
            "left_arm_joint_5", "left_arm_joint_6", "left_gripper", "right_arm_joint_1",
            "right_arm_joint_2", "right_arm_joint_3", "right_arm_joint_4", "right_arm_joint_5",
            "right_arm_joint_6", "right_gripper",
        ),
        "action": (
            "left_arm_action_1", "left_arm_action_2", "left_arm_action_3", "left_arm_action_4",
            "left_arm_action_5", "left_arm_action_6", "left_gripper_action", "right_arm_action_1",
            "right_arm_action_2", "right_arm_action_3", "right_arm_action_4", "right_arm_action_5",
            "right_arm_action_6", "right_gripper_action",
        ),
    }
)

FRAME_KEYS = ("episode_index", "frame_index", "index", "timestamp")
FRAME_INPUT_COLUMNS = MappingProxyType({"observation.state": "state", "action": "action"})

ARM_MESSAGES = T.StructType(
    [
        T.StructField("source_uri", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("log_time_ns", T.DecimalType(20, 0)),
        T.StructField("publish_time_ns", T.DecimalType(20, 0)),
        T.StructField("sequence", T.LongType()),
        T.StructField("message_ordinal", T.LongType()),
        T.StructField("pose", T.ArrayType(T.DoubleType())),
        T.StructField("position", T.ArrayType(T.DoubleType())),
        T.StructField("decode_error", T.StringType()),
    ]
)

# Published sidecar columns (internal name -> contract name), in contract order.
RECOVERY_COLUMNS = MappingProxyType(
    {
        "source_uri": "provenance.source_uri",
        "source_sha256": "provenance.source_sha256",
        "task": "provenance.task",
        "episode": "provenance.episode",
        "topic": "provenance.topic",
        "log_time_ns": "provenance.log_time_ns",
        "publish_time_ns": "provenance.publish_time_ns",
        "sequence": "provenance.sequence",
        "message_ordinal": "provenance.source_message_index",
        "arm": "source.arm",
        "stream": "source.stream",
        "pose_status": "source.pose_status",
        "joint_status": "source.joint_status",
        "fk_status": "geometry.fk_status",
        "recovery_status": "geometry.recovery_status",
        "status_mask": "geometry.status_mask",
        "recovered": "geometry.recovered",
        "pose_arm_local": "geometry.pose.arm_local",
    }
)
RECOVERY_TYPES = MappingProxyType(
    {
        "log_time_ns": T.DecimalType(20, 0),
        "publish_time_ns": T.DecimalType(20, 0),
        "sequence": T.LongType(),
        "message_ordinal": T.LongType(),
        "status_mask": T.ShortType(),
        "recovered": T.BooleanType(),
        "pose_arm_local": T.ArrayType(T.DoubleType()),
    }
)
SIDECAR_COLUMNS = MappingProxyType(
    {
        "episode_index": "episode_index",
        "frame_index": "frame_index",
        "index": "index",
        "timestamp": "timestamp",
        "source_uri": "provenance.source_uri",
        "source_row": "provenance.source_row",
        "source_sha256": "provenance.source_sha256",
        "observation_left_arm_pose": "observation.left_arm.pose.arm_local",
        "observation_right_arm_pose": "observation.right_arm.pose.arm_local",
        "action_left_arm_pose": "action.left_arm.pose.arm_local",
        "action_right_arm_pose": "action.right_arm.pose.arm_local",
        "valid_mask": "geometry.valid_mask",
        "invalid_input_mask": "geometry.invalid_input_mask",
        "derivation_failure_mask": "geometry.derivation_failure_mask",
    }
)
SIDECAR_TYPES = MappingProxyType(
    {
        "episode_index": T.LongType(),
        "frame_index": T.LongType(),
        "index": T.LongType(),
        "timestamp": T.DoubleType(),
        "source_row": T.LongType(),
        **{limb.pose: T.ArrayType(T.DoubleType()) for limb in LIMBS},
        "valid_mask": T.ShortType(),
        "invalid_input_mask": T.ShortType(),
        "derivation_failure_mask": T.ShortType(),
    }
)
