"""Quarantine, three-way accounting, coverage matrix, residual quantiles and planted canaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions.kinematics import SIX_JOINT_ARM, ChainModel, joint_limit_flags
from posefold.operators.scale import cut_lineage, first_rows_per_key, hold, lookup_join, ordinal_within

CLASS_OF_STATUS = (
    "CASE WHEN startswith(recovery_status, 'source_pose_intact') THEN 'observed_valid'"
    " WHEN recovery_status = 'recovered' THEN 'derived_valid' ELSE 'refused' END"
)


def quarantine(rows: DataFrame) -> DataFrame:
    """Keys of every refused row with a reason code and the evidence to act on."""
    refused = rows.where(F.startswith("recovery_status", F.lit("unrecoverable")))
    return refused.select(
        "source_uri",
        "topic",
        "log_time_ns",
        "sequence",
        F.col("recovery_status").alias("reason"),
        F.concat_ws(", ", F.concat(F.lit("pose "), "pose_status"), F.concat(F.lit("joints "), "joint_status"),
                    F.concat(F.lit("fk "), "fk_status")).alias("evidence"),
    )


def three_way_accounting(rows: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """Each source and topic's rows by terminal class, reconciled with declared counts if given."""
    classes = ("observed_valid", "derived_valid", "refused")
    counted = rows.withColumn("class", F.expr(CLASS_OF_STATUS)).groupBy("source_uri", "topic").agg(
        F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("class") == c).alias(c) for c in classes)
    )
    if channels is None:
        return counted
    declared = channels.where(K.is_target_topic()).select("source_uri", "topic", F.col("n").alias("declared"))
    joined = counted.join(declared, ["source_uri", "topic"], "full_outer")
    return joined.select(
        "source_uri",
        "topic",
        *(F.coalesce(name, F.lit(0)).alias(name) for name in ("total", *classes, "declared")),
        (F.coalesce("total", F.lit(0)) == F.coalesce("declared", F.lit(0))).alias("reconciles"),
    )


def audit_matrix(rows: DataFrame) -> DataFrame:
    """Episode by topic matrix of usable share: rows with a recorded or rebuilt pose over all rows."""
    usable = F.avg(F.expr(f"IF(({CLASS_OF_STATUS}) = 'refused', 0D, 1D)"))
    grouped = rows.groupBy("source_uri").pivot("topic", list(C.ARM_TOPICS)).agg(usable)
    return grouped.withColumnsRenamed(
        {topic: f"coverage_{arm}_{stream}" for topic, (arm, stream) in C.ARM_TOPICS.items()}
    )


def audit_matrix_by_cohort(rows: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Rig cohort by topic by field, in long form: rows, and the share whose recorded pose, joints or
    pose of either kind can be used. ``cohorts`` has ``source_uri, cohort_x, cohort_y, cohort_z``."""
    fields = {
        "recorded_pose": "pose_status = 'intact'",
        "joints": "joint_status = 'intact'",
        "pose": f"({CLASS_OF_STATUS}) <> 'refused'",
    }
    key = ["cohort_x", "cohort_y", "cohort_z", "topic"]
    counted = rows.groupBy("source_uri", "topic").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.expr(text)).alias(name) for name, text in fields.items())
    )
    wide = counted.join(cohorts.select("source_uri", *key[:3]), "source_uri", "left").groupBy(*key).agg(
        F.sum("n").alias("n"), *(F.sum(name).alias(name) for name in fields)
    )
    entries = F.array(*(F.struct(F.lit(name).alias("field"), F.col(name).alias("usable")) for name in fields))
    long = wide.select(*key, "n", F.inline(entries))
    return long.select(*key, "field", "n", (F.col("usable") / F.col("n")).alias("share"))


def residual_quantiles(
    rows: DataFrame, value: str, keys: list[str], probabilities: tuple[float, ...]
) -> DataFrame:
    """Exact quantiles (smallest value covering at least the share) per group, in long form.

    Values are first counted per distinct value. Ranks come from a distributed numbering of those
    distinct values, so no group's values are ever held in one task.
    """
    present = hold(rows, [value]).where(F.col(value).isNotNull())
    counts = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    # The running total up to each distinct value needs the order; rank rows carry their weight.
    ranked = _running_totals(counts, keys, value)
    totals = ranked.groupBy(*keys).agg(F.sum("n").alias("total"))
    wanted = lookup_join(ranked, totals, keys, how="inner", null_safe=True, derived=True)
    probes = F.array(*(F.lit(float(p)) for p in probabilities))
    needed = wanted.withColumn("probability", F.explode(probes)).withColumn(
        "rank", F.greatest(F.lit(1), F.ceil(F.col("probability") * F.col("total")))
    )
    hit = needed.where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
    return hit.select(*keys, "probability", F.col(value).alias("value"), "total")


def _running_totals(counts: DataFrame, keys: list[str], value: str, block: int = 10_000) -> DataFrame:
    """Add ``before``: the weight of smaller values in the same group."""
    from pyspark.sql.window import Window

    numbered = ordinal_within(counts, keys, [value], "_ordinal")
    # Blocks of consecutive ordinals are summed on their own, then blocks of blocks, then those: no window
    # holds more than ``block`` lines until a group has block ** 3 distinct values.
    rows = numbered.withColumn("_block", F.expr(f"_ordinal DIV {block}"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_ordinal").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_block").agg(F.sum("n").alias("_n"))
    sums = cut_lineage(sums.withColumn("_super", F.expr(f"_block DIV {block}")), "blocks")
    near = Window.partitionBy(*keys, "_super").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*keys).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    supers = sums.groupBy(*keys, "_super").agg(F.sum("_n").alias("_m")).select(
        *keys, "_super", F.coalesce(F.sum("_m").over(far), F.lit(0)).alias("_far")
    )
    placed = sums.withColumn("_near", F.coalesce(F.sum("_n").over(near), F.lit(0)))
    placed = lookup_join(placed, supers, [*keys, "_super"], how="inner", null_safe=True, derived=True)
    blocks = placed.select(*keys, "_block", (F.col("_far") + F.col("_near")).alias("_base"))
    rows = rows.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = lookup_join(rows, blocks, [*keys, "_block"], how="inner", null_safe=True, derived=True)
    return joined.select(*counts.columns, (F.col("_base") + F.col("_inside")).alias("before"))


def worst_residuals(rows: DataFrame, value: str, keys: list[str], k: int, tie: list[str]) -> DataFrame:
    """The ``k`` largest residuals of every group. Rows without a residual must be filtered out first."""
    return first_rows_per_key(rows, keys, [F.desc_nulls_last(value), *tie], k)


def plant_canaries(messages: DataFrame, every: int = 50) -> DataFrame:
    """Copy of the intact-length rows in which a hash picks rows to damage, with the class to expect.

    One pose in ``every`` is removed, one cut short and one made non-finite.
    """
    rows = messages.where(F.col("decode_error").isNull() & K.is_target_topic())
    rows = K.pose_status_only(rows)
    pick = F.expr(
        "cast(conv(substring(md5(concat_ws('|', source_uri, topic, log_time_ns, sequence)), 1, 8), 16, 10)"
        f" AS bigint) % {every}"
    )
    rows = rows.withColumn("plant", F.when(F.col("pose_status") == "intact", pick))
    damaged = (
        "CASE plant WHEN 0 THEN cast(array() AS array<double>) WHEN 1 THEN slice(pose, 1, 15)"
        " WHEN 2 THEN transform(pose, (v, i) -> IF(i = 5, double('NaN'), v)) ELSE pose END"
    )
    expected = (
        "CASE plant WHEN 0 THEN 'missing' WHEN 1 THEN 'malformed' WHEN 2 THEN 'nonfinite'"
        " ELSE pose_status END"
    )
    return rows.select(
        *(c for c in messages.columns if c != "pose"),
        F.expr(damaged).alias("pose"),
        F.expr(expected).alias("expected_class"),
        F.coalesce(F.col("plant").isin(0, 1, 2), F.lit(False)).alias("planted"),
    )


def canary_report(planted: DataFrame) -> DataFrame:
    """Classify the damaged copy again and count how many rows got the expected class."""
    found = K.pose_status_only(planted)
    return found.groupBy("planted", "expected_class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("pose_status") == F.col("expected_class")).alias("caught"),
    )


def joint_limit_violations(messages: DataFrame, model: ChainModel = SIX_JOINT_ARM) -> DataFrame:
    """Per topic and joint: rows with intact joints outside the declared range (an opt-in refusal)."""
    rows = messages.where(F.col("decode_error").isNull() & K.is_target_topic()).select("topic", "position")
    rows = K.with_joint_status(rows, "q").where(F.col("joint_status") == "intact")
    names = [f"q{i}" for i in range(C.JOINT_COUNT)]
    flags = joint_limit_flags(names, model)
    wide = rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(~flag).alias(f"out{i}") for i, flag in enumerate(flags)),
    )
    entries = F.array(
        *(F.struct(F.lit(i + 1).alias("joint"), F.col(f"out{i}").alias("outside")) for i in range(len(flags)))
    )
    return wide.select("topic", "rows", F.inline(entries))
