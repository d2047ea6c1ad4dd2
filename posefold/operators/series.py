"""Strided recorded-versus-derived series per arm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions.kinematics import ChainKinematics
from posefold.functions.rotation import translation_error
from posefold.operators.recovery import READER_ORDER
from posefold.operators.scale import ordinal_within


def recorded_vs_derived(
    messages: DataFrame, kinematics=None, right_offset: tuple[float, float, float] = C.DEFAULT_RIGHT_OFFSET
) -> DataFrame:
    """State-topic rows with a 16-value pose and six joints, both xyz positions and their distance.

    Lengths are the only test here, as the series shows what was recorded; a non-finite value yields a
    null residual rather than a number.
    """
    return _derived(_recorded(messages), kinematics, right_offset)


def strided_states(
    messages: DataFrame,
    stride: int,
    kinematics=None,
    right_offset: tuple[float, float, float] = C.DEFAULT_RIGHT_OFFSET,
) -> DataFrame:
    """``stride_series`` of the messages: rows are numbered as recorded, and FK runs on those kept."""
    return _derived(stride_series(_recorded(messages), stride), kinematics, right_offset)


def _recorded(messages: DataFrame) -> DataFrame:
    states = [topic for topic, (_, stream) in C.ARM_TOPICS.items() if stream == "state"]
    rows = messages.where(F.col("decode_error").isNull() & F.col("topic").isin(*states)).where(
        f"size(pose) = {C.POSE_LENGTH} AND size(position) = {C.JOINT_COUNT}"
    )
    return rows.select(
        "source_uri", "topic", K.arm_of().alias("arm"), "log_time_ns", "sequence", F.col("position").alias("joints"),
        *(F.expr(f"{K.element('pose', i)} AS rec_{a}") for a, i in zip("xyz", (3, 7, 11))),
    )


def _derived(rows: DataFrame, kinematics, right_offset: tuple[float, float, float]) -> DataFrame:
    numbered = ["ordinal"] if "ordinal" in rows.columns else []
    joints = [K.element("joints", i) for i in range(C.JOINT_COUNT)]
    rows = (kinematics or ChainKinematics()).attach(rows, joints, "fk_", K.finite([f"({j})" for j in joints]), "arm")
    offset = tuple(f"IF(arm = 'right', {v!r}D, 0D)" for v in map(float, right_offset))
    known = F.expr(f"fk_ok AND {K.finite(['rec_x', 'rec_y', 'rec_z'])}")
    return rows.select(
        "source_uri", "arm", "topic", "log_time_ns", "sequence", *numbered, "joints",
        *(f"rec_{a}" for a in "xyz"),
        *(F.when(F.col("fk_ok"), F.expr(f"fk_{a} + {o}")).alias(f"der_{a}") for a, o in zip("xyz", offset)),
        F.when(known, translation_error("rec_", "fk_", offset)).alias("residual_m"),
    )


def stride_series(series: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th row of each source and arm in scan order, with its 0-based ordinal."""
    if stride <= 0:
        raise ValueError("stride must be positive")
    numbered = ordinal_within(series, ["source_uri", "arm"], list(READER_ORDER), "ordinal")
    return numbered.where(F.col("ordinal") % stride == 0)


def series_summary(series: DataFrame, stride: int) -> DataFrame:
    """Per source and arm: rows, rows a stride keeps, and the largest residual over all rows."""
    return series.groupBy("source_uri", "arm").agg(
        F.count(F.lit(1)).alias("source_records"),
        F.expr(f"(count(1) + {stride} - 1) DIV {stride}").alias("sampled_records"),
        F.max("residual_m").alias("max_residual_m"),
    )
