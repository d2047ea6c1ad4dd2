"""Independent field profile, count reconciliation and the cross-check against the primary audit.

The profile looks only at literal lengths and finiteness of the two fields. It shares no code with
the classifiers, which is what makes the comparison worth something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.operators.corpus import named_checks


def _is_target() -> Column:
    return F.col("topic").isin(*C.ARM_TOPICS)


def _holds_nonfinite(field: str) -> Column:
    """Some value of the field is absent, NaN or infinite."""
    bad = F.filter(field, lambda v: ~F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(F.size(bad) > 0, F.lit(False))


def field_profile(messages: DataFrame) -> DataFrame:
    """Per source and pair of field lengths: rows, and rows holding a non-finite value of any length.

    An absent field has length zero. This one grouped table feeds every profile number below.
    """
    rows = messages.where(F.col("decode_error").isNull() & _is_target())
    return (
        rows.select(
            "source_uri",
            F.coalesce(F.size("pose"), F.lit(0)).alias("pose_length"),
            F.coalesce(F.size("position"), F.lit(0)).alias("joint_length"),
            _holds_nonfinite("pose").alias("bad_pose"),
            _holds_nonfinite("position").alias("bad_joints"),
        )
        .groupBy("source_uri", "pose_length", "joint_length")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("bad_pose").alias("nonfinite_pose"),
            F.count_if("bad_joints").alias("nonfinite_joints"),
        )
    )


def length_histogram(profile: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Long-form histogram of both fields' lengths; ``keys`` may keep it per source."""
    fields = F.array(
        F.struct(F.lit("pose").alias("field"), F.col("pose_length").alias("length"), F.col("nonfinite_pose").alias("bad")),
        F.struct(F.lit("position").alias("field"), F.col("joint_length").alias("length"), F.col("nonfinite_joints").alias("bad")),
    )
    rows = profile.select(*keys, "n", F.explode(fields).alias("f")).select(*keys, "n", "f.*")
    return rows.groupBy(*keys, "field", "length").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("nonfinite")
    )


def cross_check(
    profile: DataFrame, files: DataFrame, digests: DataFrame, keep: list[str] = ()
) -> DataFrame:
    """Eight named equalities between the primary audit and the independent profile.

    ``digests`` has ``source_uri, primary_sha256, sha256``. ``keep`` names extra grouping columns
    present in all three inputs (used to check several variants in one run).
    """
    keep = list(keep)
    independent = profile.groupBy(*keep).agg(
        F.sum("n").alias("i_messages"),
        F.sum(F.when(F.col("pose_length") == 0, F.col("n")).otherwise(0)).alias("i_missing"),
        F.sum(F.when(F.col("pose_length") == C.POSE_LENGTH, F.col("n")).otherwise(0)).alias("i_sixteen"),
        F.every(F.col("pose_length").isin(0, C.POSE_LENGTH)).alias("i_lengths_ok"),
        F.every(F.col("joint_length") == C.JOINT_COUNT).alias("i_six"),
        F.sum("nonfinite_pose").alias("i_bad_pose"),
        F.sum("nonfinite_joints").alias("i_bad_joints"),
    )
    primary = files.groupBy(*keep).agg(
        F.sum("messages").alias("p_messages"),
        F.sum("missing_pose").alias("p_missing"),
        F.sum("intact_pose").alias("p_intact"),
        F.sum("nonfinite_pose").alias("p_bad_pose"),
    )
    hashes = digests.groupBy(*keep).agg(
        F.every(F.coalesce(F.col("primary_sha256") == F.col("sha256"), F.lit(False))).alias("hashes_ok")
    )
    if keep:
        joined = primary.join(independent, keep, "left").join(hashes, keep, "left")
    else:  # three one-row tables
        joined = primary.join(F.broadcast(independent)).join(F.broadcast(hashes))

    def equal(a: str, b: str) -> Column:
        return F.coalesce(F.col(a), F.lit(0)) == F.coalesce(F.col(b), F.lit(0))

    checks = {
        "all_source_hashes": F.col("hashes_ok"),
        "target_messages": equal("i_messages", "p_messages"),
        "missing_pose_records": equal("i_missing", "p_missing"),
        "intact_length_pose_records": equal("i_sixteen", "p_intact"),
        "only_expected_pose_lengths": F.col("i_lengths_ok"),
        "six_joint_records": F.col("i_six") & equal("i_messages", "p_messages"),
        "nonfinite_pose_records": equal("i_bad_pose", "p_bad_pose"),
        "nonfinite_joint_records": F.coalesce(F.col("i_bad_joints"), F.lit(0)) == 0,
    }
    return named_checks(joined, checks, keep)


def decoded_vs_declared(topics: DataFrame, channels: DataFrame) -> DataFrame:
    """Per source and target topic: decoded rows beside the count its channel summary declares.

    ``channels`` has ``source_uri, topic, n``. Sources known to either side appear.
    """
    declared = channels.where(_is_target()).groupBy("source_uri", "topic").agg(
        F.sum("n").alias("declared")
    )
    decoded = topics.select("source_uri", "topic", F.col("messages").alias("decoded"))
    joined = decoded.join(declared, ["source_uri", "topic"], "full_outer")
    return joined.select(
        "source_uri",
        "topic",
        F.coalesce("decoded", F.lit(0)).alias("decoded"),
        F.coalesce("declared", F.lit(0)).alias("declared"),
        (F.coalesce("decoded", F.lit(0)) == F.coalesce("declared", F.lit(0))).alias("matches"),
    )
