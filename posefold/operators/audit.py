"""Per-message scores and their rollup to topic, file and batch.

``score_messages`` is one map-only pass. ``topic_audit`` is the only shuffle of the audit: one group
per file and topic with map-side partial aggregates, so a file that holds a third of all rows sends
only a few lines per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions.kinematics import ChainKinematics
from posefold.functions.rotation import rotation_error_deg, translation_error
from posefold.operators.scale import first_rows_per_key, hold

POSE_COUNTS = (
    "missing_pose",
    "malformed_pose",
    "nonfinite_pose",
    "intact_pose",
    "recoverable_invalid_pose",
    "unrecoverable_invalid_pose",
)
JOINT_COUNTS = ("missing_joints", "malformed_joints", "nonfinite_joints")
FK_COUNTS = ("fk_failures", "fk_compared", "fk_outside_tolerance")
COUNTS = ("messages", *POSE_COUNTS, *JOINT_COUNTS, *FK_COUNTS)
RESIDUALS = {"translation": "m", "rotation": "deg"}
OFFSET_AXES = ("x", "y", "z")
TOPIC_STATS = (
    *(f"{name}_{kind}_{unit}" for name, unit in RESIDUALS.items() for kind in ("mean", "rmse", "max")),
    "offset_count",
    *(f"offset_{kind}_{axis}" for axis in OFFSET_AXES for kind in ("mean", "std", "min", "max")),
)


def check_tolerances(translation_m: float, rotation_deg: float, issue_limit: int = 0) -> None:
    """Refuse unusable audit parameters before any plan is built."""
    for name, value in (("translation tolerance", translation_m), ("rotation tolerance", rotation_deg)):
        if not math.isfinite(value) or value < 0:
            raise ValueError(f"{name} must be finite and non-negative")
    if issue_limit < 0:
        raise ValueError("issue sample limit must be non-negative")


def with_topic_roles(messages: DataFrame) -> DataFrame:
    """Add ``arm``, ``stream`` and ``role``: target, ignored, decode_error or record_error."""
    return messages.select(
        "*",
        K.arm_of().alias("arm"),
        K.stream_of().alias("stream"),
        F.expr(
            "CASE WHEN decode_error IS NOT NULL THEN 'decode_error'"
            " WHEN topic IS NULL THEN 'record_error'"
            f" WHEN topic IN ({', '.join(repr(t) for t in C.ARM_TOPICS)}) THEN 'target'"
            " ELSE 'ignored' END"
        ).alias("role"),
    )


def score_messages(
    messages: DataFrame,
    kinematics=None,
    right_offset: tuple[float, float, float] = C.DEFAULT_RIGHT_OFFSET,
    translation_tolerance_m: float = C.TRANSLATION_TOLERANCE_M,
    rotation_tolerance_deg: float = C.ROTATION_TOLERANCE_DEG,
    details: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per message with its classes, FK validity, residuals and observed base offset.

    Residuals are measured in the shared frame: the right arm's derived pose is moved by
    ``right_offset``. They are null unless pose, joints and FK are all valid.
    """
    check_tolerances(translation_tolerance_m, rotation_tolerance_deg)
    kinematics = kinematics or ChainKinematics()
    rows = with_topic_roles(messages)
    # Other rows are only counted; nulling their payload keeps them out of every test below.
    target = F.col("role") == "target"
    wanted = ("source_uri", "topic", "arm", "stream", "role", "log_time_ns", *keep)
    rows = rows.select(
        *dict.fromkeys(wanted),
        *(["decode_error"] if details else []),
        F.when(target, F.col("pose")).alias("pose"),
        F.when(target, F.col("position")).alias("position"),
    )
    rows = K.with_joint_status(K.with_pose_status(rows, "rec_", details), "q", details)
    extra = ["pose_detail", "joint_detail", "decode_error"] if details else []
    rows = rows.drop("position", *(["pose"] if "pose" not in keep else []))
    joints = [f"q{i}" for i in range(C.JOINT_COUNT)]
    usable = "joint_status = 'intact' AND role = 'target'"
    rows = kinematics.attach(rows, joints, "fk_", usable, "arm").drop(*joints)

    local = kinematics.frame == "arm_local"
    offset = tuple(
        f"IF(arm = 'right', {value!r}D, 0D)" if local else "0D" for value in map(float, right_offset)
    )
    compared = "fk_ok AND pose_status = 'intact'"
    rows = rows.select(
        *dict.fromkeys(wanted),
        "pose_status",
        "joint_status",
        *extra,
        "fk_ok",
        (F.col("pose_status") == "intact").alias("pose_ok"),
        (F.col("joint_status") == "intact").alias("joints_ok"),
        F.expr(compared).alias("compared"),
        F.when(F.expr(compared), translation_error("rec_", "fk_", offset)).alias("translation_m"),
        F.when(F.expr(compared), rotation_error_deg("rec_", "fk_")).alias("rotation_deg"),
        *(
            F.when(F.expr(compared if local else "false"), F.expr(f"rec_{a} - fk_{a}")).alias(f"offset_{a}")
            for a in OFFSET_AXES
        ),
    )
    outside = (F.col("translation_m") > translation_tolerance_m) | (
        F.col("rotation_deg") > rotation_tolerance_deg
    )
    return rows.withColumn("outside", F.coalesce(outside, F.lit(False)))


def _count(condition: str, name: str) -> Column:
    return F.count_if(F.expr(condition)).alias(name)


def counter_columns() -> list[Column]:
    """Pose, joint, recoverability and FK counters over scored target rows."""
    states = [
        _count(f"{kind}_status = '{state}'", f"{state}_{word}")
        for kind, word in (("pose", "pose"), ("joint", "joints"))
        for state in C.POSE_STATES
        if (kind, state) != ("joint", "intact")
    ]
    return [
        F.count(F.lit(1)).alias("messages"),
        *states,
        _count("NOT pose_ok AND fk_ok", "recoverable_invalid_pose"),
        _count("NOT pose_ok AND NOT fk_ok", "unrecoverable_invalid_pose"),
        _count("joints_ok AND NOT fk_ok", "fk_failures"),
        F.count_if("compared").alias("fk_compared"),
        _count("outside", "fk_outside_tolerance"),
    ]


def residual_columns() -> list[Column]:
    columns = []
    for name, unit in RESIDUALS.items():
        value = F.col(f"{name}_{unit}")
        columns += [
            F.avg(value).alias(f"{name}_mean_{unit}"),
            F.sqrt(F.avg(value * value)).alias(f"{name}_rmse_{unit}"),
            F.max(value).alias(f"{name}_max_{unit}"),
        ]
    return columns


def offset_columns() -> list[Column]:
    columns = [F.count("offset_x").alias("offset_count")]
    for axis in OFFSET_AXES:
        value = F.col(f"offset_{axis}")
        for kind, function in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max)):
            columns.append(function(value).alias(f"offset_{kind}_{axis}"))
    return columns


SKETCHES = tuple(f"{name}_sketch" for name in RESIDUALS)


def sketch_columns(sketch_k: int) -> list[Column]:
    return [
        F.kll_sketch_agg_double(f"{name}_{unit}", sketch_k).alias(f"{name}_sketch")
        for name, unit in RESIDUALS.items()
    ]


def topic_audit(scored: DataFrame, sketch_k: int | None = None) -> DataFrame:
    """Four rows per source, one per target topic, zero-filled where a topic never occurs.

    Ignored, undecodable and unusable rows are counted per source and repeated on its four rows as
    ``source_ignored`` and ``source_decode_errors``. With ``sketch_k`` every row also keeps a KLL sketch of
    each residual, a few kilobytes that merge into those of files and of the corpus (``sketches``).
    """
    kept = (*TOPIC_STATS, *(SKETCHES if sketch_k is not None else ()))
    target = F.col("role") == "target"
    grouped = scored.groupBy("source_uri", F.when(target, F.col("topic")).alias("topic")).agg(
        *counter_columns(),
        *residual_columns(),
        *offset_columns(),
        *(sketch_columns(sketch_k) if sketch_k is not None else ()),
        _count("role = 'ignored'", "ignored"),
        _count("role IN ('decode_error', 'record_error')", "decode_errors"),
    )
    # At most five lines per source (four topics and the rest), so the map below is bounded.
    payload = F.struct(*COUNTS, *kept)
    per_source = grouped.groupBy("source_uri").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("topic").isNotNull(), F.struct("topic", payload.alias("v"))))
        ).alias("by_topic"),
        F.sum("ignored").alias("source_ignored"),
        F.sum("decode_errors").alias("source_decode_errors"),
    )
    topics = F.array(*(F.lit(topic) for topic in C.ARM_TOPICS))
    rows = per_source.select(
        "source_uri",
        "source_ignored",
        "source_decode_errors",
        "by_topic",
        F.posexplode(topics).alias("topic_order", "topic"),
    ).withColumn("v", F.try_element_at("by_topic", F.col("topic")))
    zero = {*COUNTS, "offset_count"}
    return rows.select(
        "source_uri",
        "topic",
        "topic_order",
        K.arm_of().alias("arm"),
        K.stream_of().alias("stream"),
        *(
            (F.coalesce(F.col(f"v.{n}"), F.lit(0)) if n in zero else F.col(f"v.{n}")).alias(n)
            for n in (*COUNTS, *kept)
        ),
        "source_ignored",
        "source_decode_errors",
    )


def missing_topics(topics: DataFrame) -> DataFrame:
    """Target topics a source never carries, in contract order."""
    return topics.where(F.col("messages") == 0).select("source_uri", "topic", "topic_order")


FILE_SUMS = COUNTS


def file_audit(topics: DataFrame) -> DataFrame:
    """Totals and verdict of each source from its topic rows."""
    invalid_joints = " + ".join(JOINT_COUNTS)
    totals = topics.groupBy("source_uri").agg(
        *(F.sum(name).alias(name) for name in FILE_SUMS),
        F.max("source_ignored").alias("ignored_messages"),
        F.max("source_decode_errors").alias("decode_errors"),
        F.count_if(F.col("messages") == 0).alias("missing_topic_count"),
        _count("messages > 0 AND missing_pose + malformed_pose + nonfinite_pose + intact_pose"
               " <> messages", "unclassified_topics"),
        _count("offset_count <> fk_compared", "offset_mismatch_topics"),
    )
    return totals.select(
        "*",
        F.expr("missing_pose + malformed_pose + nonfinite_pose").alias("invalid_pose"),
        F.expr(invalid_joints).alias("invalid_joints"),
        F.expr(issue_count_text()).alias("issue_count"),
        F.expr(
            "missing_topic_count = 0 AND decode_errors = 0 AND fk_outside_tolerance = 0"
            " AND fk_failures = 0 AND missing_pose + malformed_pose + nonfinite_pose = 0"
            f" AND {invalid_joints} = 0"
        ).alias("passed"),
    )


def issue_count_text() -> str:
    """Every refusal counts once per cause, whatever the size of the issue sample."""
    return (
        "missing_pose + malformed_pose + nonfinite_pose + missing_joints + malformed_joints"
        " + nonfinite_joints + fk_failures + fk_outside_tolerance + decode_errors"
    )


def batch_audit(files: DataFrame) -> DataFrame:
    """One row of totals over all files, and whether every file passed."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        *(
            F.sum(name).alias(name)
            for name in ("messages", "ignored_messages", "invalid_pose", "intact_pose",
                         "recoverable_invalid_pose", "unrecoverable_invalid_pose", "fk_compared",
                         "fk_outside_tolerance", "decode_errors")
        ),
        F.coalesce(F.every("passed"), F.lit(True)).alias("passed"),
    )


def issues(scored: DataFrame) -> DataFrame:
    """Every issue of every row, as (source, order keys, code, detail).

    ``scored`` needs ``details=True`` and ``sequence`` in ``keep``.
    """
    candidates = [
        ("role = 'decode_error'", "'<decoder>'", "'decode_error'", "concat('payload: ', decode_error)"),
        ("role = 'record_error'", "'<unknown>'", "'record_error'", "'record has no topic'"),
        ("role = 'target' AND NOT pose_ok", "topic", "concat(pose_status, '_pose')", "pose_detail"),
        ("role = 'target' AND NOT joints_ok", "topic", "concat(joint_status, '_joints')", "joint_detail"),
        ("role = 'target' AND joints_ok AND NOT fk_ok", "topic", "'fk_failure'", "'no finite pose derived'"),
        (
            "outside",
            "topic",
            "'fk_residual_outside_tolerance'",
            "format_string('translation=%.9f m, rotation=%.9f deg', translation_m, rotation_deg)",
        ),
    ]
    entries = [
        f"IF({when}, named_struct('code_order', {i}, 'topic', {topic}, 'code', {code}, 'detail',"
        f" {detail}), NULL)"
        for i, (when, topic, code, detail) in enumerate(candidates)
    ]
    rows = hold(scored, ["outside"]).where("role IN ('decode_error', 'record_error') OR (role = 'target' AND"
                        " (NOT pose_ok OR NOT joints_ok OR NOT fk_ok OR outside))")
    exploded = rows.withColumn(
        "issue", F.explode(F.expr(f"array_compact(array({', '.join(entries)}))"))
    )
    undated = F.col("role").isin("decode_error", "record_error")
    return exploded.select(
        "source_uri",
        F.col("issue.topic").alias("topic"),
        F.when(~undated, F.col("log_time_ns")).alias("log_time_ns"),
        F.col("issue.code").alias("code"),
        F.col("issue.detail").alias("detail"),
        F.col("issue.code_order").alias("code_order"),
        F.col("log_time_ns").alias("scan_time_ns"),
        F.col("topic").alias("scan_topic"),
        "sequence",
    )


SCAN_ORDER = ("scan_time_ns", "scan_topic", "sequence", "code_order")


def issue_sample(
    issue_rows: DataFrame, files: DataFrame, limit: int = C.ISSUE_SAMPLE_LIMIT
) -> DataFrame:
    """The first ``limit`` issues of each file in scan order, with the file's true count and whether
    the sample is shorter than it."""
    check_tolerances(0.0, 0.0, limit)
    sampled = first_rows_per_key(issue_rows, ["source_uri"], list(SCAN_ORDER), limit)
    counts = files.select("source_uri", "issue_count")
    return sampled.join(counts, "source_uri", "left").withColumn(
        "truncated", F.col("issue_count") > limit
    )


def audit_messages(messages: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Topic and file audits of a message table."""
    topics = topic_audit(score_messages(messages, **options))
    return topics, file_audit(topics)
