"""Pose sidecar of a 14-value frame table: four arm-local poses and three masks per row.

The whole job is one map stage: no shuffle between the scan and the sink.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions.kinematics import ChainKinematics
from posefold.functions.rotation import pose_vector
from posefold.functions.spans import end_of_span
from posefold.operators.scale import key_counts, lookup_join


def frame_masks(frames: DataFrame) -> DataFrame:
    """Add ``valid_mask`` and ``invalid_input_mask`` from the inputs alone (no derivation)."""
    usable = {limb.bit: K.limb_is_usable(limb) for limb in C.LIMBS}
    return frames.select(
        "*",
        K.bit_mask(usable).alias("valid_mask"),
        K.bit_mask({bit: f"NOT ({text})" for bit, text in usable.items()}).alias("invalid_input_mask"),
    )


def augment_frames(
    frames: DataFrame, sources: DataFrame | None = None, kinematics=None
) -> DataFrame:
    """The pose sidecar under internal names, one row per frame.

    ``sources`` may give ``source_uri, source_sha256``. Limbs are derived one after the other, each in
    generated-code spans of its own; a limb's six angles give way to its seven pose values.
    """
    kinematics = kinematics or ChainKinematics()
    if kinematics.frame != "arm_local":
        raise ValueError("the sidecar emits arm-local poses only; the adapter reports another frame")
    base = ["source_uri", "source_row", *C.FRAME_KEYS]
    angles = {limb: [f"{limb.pose}_q{i}" for i in range(C.JOINT_COUNT)] for limb in C.LIMBS}
    # Both vectors are taken apart once; from here on every column has a fixed width.
    rows = frames.select(
        *base,
        *(
            F.expr(text).alias(name)
            for limb in C.LIMBS
            for text, name in zip(K.limb_joints(limb), angles[limb])
        ),
        *(
            F.expr(f"coalesce(size({v}) = {C.VECTOR_LENGTH}, false)").alias(f"{v}_sized")
            for v in C.FRAME_INPUT_COLUMNS.values()
        ),
    )
    rows = end_of_span(rows, angles[C.LIMBS[0]][0])
    rows = rows.select(
        *base,
        *(name for limb in C.LIMBS for name in angles[limb]),
        *(
            F.expr(f"{limb.vector}_sized AND {K.finite(angles[limb])}").alias(f"{limb.pose}_usable")
            for limb in C.LIMBS
        ),
    )
    for limb in C.LIMBS:
        prefix = f"{limb.pose}_"
        rows = kinematics.attach_vector(rows, angles[limb], prefix, f"{prefix}usable", f"'{limb.arm}'")
        rows = rows.drop(*angles[limb])

    def mask(fact: str):
        return K.bit_mask({limb.bit: fact.format(p=f"{limb.pose}_") for limb in C.LIMBS})

    rows = rows.select(
        *base,
        *(F.when(F.col(f"{limb.pose}_ok"), pose_vector(f"{limb.pose}_")).alias(limb.pose) for limb in C.LIMBS),
        mask("{p}ok").alias("valid_mask"),
        mask("NOT {p}usable").alias("invalid_input_mask"),
        mask("{p}usable AND NOT {p}ok").alias("derivation_failure_mask"),
    )
    if sources is None:
        rows = rows.withColumn("source_sha256", F.lit(None).cast("string"))
    else:
        rows = lookup_join(rows, sources.select("source_uri", "source_sha256"), ["source_uri"])
    return rows.select(
        *(
            F.col(name).cast(C.SIDECAR_TYPES[name]).alias(name) if name in C.SIDECAR_TYPES else name
            for name in C.SIDECAR_COLUMNS
        )
    )


# What the three masks tell.
MASKS = {
    "valid": "valid_mask",
    "invalid_input": "invalid_input_mask",
    "derivation_failure": "derivation_failure_mask",
}


def mask_measures(masks: Mapping[str, str] = MASKS) -> dict[str, Column]:
    """Rows with each bit of each mask set, as ``mask_bit`` aggregates to observe."""
    return {
        f"{name}_{bit}": F.count_if(K.bit_is_set(f"`{column}`", bit))
        for name, column in masks.items()
        for bit in C.LIMB_BITS.values()
    }


def measured_masks(measured: Mapping[str, int]) -> list[tuple]:
    """``limb, valid, invalid_input, derivation_failure`` from observed :func:`mask_measures`."""
    return [(limb, *(measured[f"{name}_{bit}"] for name in MASKS)) for limb, bit in C.LIMB_BITS.items()]


def mask_bit_counts(rows: DataFrame) -> DataFrame:
    """Per limb: rows with its valid, invalid-input and derivation-failure bit set."""
    masks = {name: column for name, column in MASKS.items() if column in rows.columns}
    totals = rows.agg(*(column.alias(name) for name, column in mask_measures(masks).items()))
    return totals.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(limb).alias("limb"),
                        *(F.col(f"{name}_{bit}").alias(name) for name in masks),
                    )
                    for limb, bit in C.LIMB_BITS.items()
                )
            )
        )
    )


def key_violations(frames: DataFrame) -> DataFrame:
    """Per source: rows whose keys are null or whose timestamp is null or not finite."""
    stamp = F.col("timestamp")
    broken = stamp.isNull() | F.isnan(stamp) | (F.abs(stamp) == F.lit(float("inf")))
    return frames.groupBy("source_uri").agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in C.FRAME_KEYS[:3]),
        F.count_if(broken).alias("bad_timestamp"),
    )


def key_integrity(source: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Compare sidecar keys with source keys row by row, without a join.

    Per source file: source rows, sidecar rows, keys repeated in the sidecar, sidecar keys without a
    source row, source rows without a sidecar key, and positions whose key values differ.
    """
    keys = ["source_uri", "source_row"]
    counts = key_counts(source, sidecar, keys, list(C.FRAME_KEYS))
    both = "n_left > 0 AND n_right > 0"
    differ = f"{both} AND NOT (l_min <=> r_min AND l_max <=> r_max)"
    return counts.groupBy("source_uri").agg(
        F.sum("n_left").alias("source_rows"),
        F.sum("n_right").alias("sidecar_rows"),
        F.count_if(F.col("n_right") > 1).alias("duplicate_keys"),
        F.count_if(F.col("n_left") == 0).alias("orphan_keys"),
        F.count_if(F.col("n_right") == 0).alias("missing_keys"),
        F.count_if(F.expr(differ)).alias("reordered_keys"),
    )
