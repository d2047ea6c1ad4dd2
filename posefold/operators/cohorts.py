"""Merging stored statistics, rig cohorts from observed base offsets, and frame refusal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from posefold import contracts as C
from posefold.functions.text import cohort_coordinate
from posefold.operators.audit import OFFSET_AXES, RESIDUALS
from posefold.operators.identities import linked_cells
from posefold.operators.scale import cut_lineage, lookup_join


def merge_offsets(topics: DataFrame, keys: list[str]) -> DataFrame:
    """Pool stored offset summaries (count, mean, population deviation, range) by ``keys``.

    Means are pooled first and squared distances are taken from the pooled mean, so two large, nearly
    equal numbers are never subtracted. Per file that is one window over its few topic rows, on the
    same partitioning as the sum that follows; over many files it is a second small aggregate joined
    back. Groups without any observation keep a row with count zero and null statistics.
    """
    n = F.col("offset_count")

    def mean(axis: str) -> Column:
        return F.col(f"offset_mean_{axis}")

    if "source_uri" in keys:
        own = Window.partitionBy(*keys)
        rows = topics.select(
            "*",
            *(
                (F.sum(n * mean(a)).over(own) / F.nullif(F.sum(n).over(own), F.lit(0))).alias(f"pooled_{a}")
                for a in OFFSET_AXES
            ),
        )
    else:
        pooled = topics.groupBy(*keys).agg(
            *((F.sum(n * mean(a)) / F.nullif(F.sum(n), F.lit(0))).alias(f"pooled_{a}") for a in OFFSET_AXES)
        )
        rows = topics.join(pooled, keys, "inner") if keys else topics.join(F.broadcast(pooled))
    columns = []
    for a in OFFSET_AXES:
        std, away = F.col(f"offset_std_{a}"), mean(a) - F.col(f"pooled_{a}")
        columns += [
            F.max(f"pooled_{a}").alias(f"offset_mean_{a}"),
            F.sqrt(F.sum(n * (std * std + away * away)) / F.nullif(F.sum(n), F.lit(0))).alias(f"offset_std_{a}"),
            F.min(f"offset_min_{a}").alias(f"offset_min_{a}"),
            F.max(f"offset_max_{a}").alias(f"offset_max_{a}"),
        ]
    return rows.groupBy(*keys).agg(F.sum(n).alias("offset_count"), *columns)


def merged_residual_columns() -> list[Column]:
    """Residual summaries weighted by the number of compared rows."""
    n = F.col("fk_compared")
    total = F.nullif(F.sum(F.when(n > 0, n)), F.lit(0))
    columns = []
    for name, unit in RESIDUALS.items():
        mean, rmse = F.col(f"{name}_mean_{unit}"), F.col(f"{name}_rmse_{unit}")
        columns += [
            (F.sum(mean * n) / total).alias(f"{name}_mean_{unit}"),
            F.sqrt(F.sum(rmse * rmse * n) / total).alias(f"{name}_rmse_{unit}"),
            F.max(f"{name}_max_{unit}").alias(f"{name}_max_{unit}"),
        ]
    return columns


def observed_right_offsets(topics: DataFrame) -> DataFrame:
    """Per file: pooled right-arm base offset, count zero where nothing could be observed."""
    return merge_offsets(topics.where(F.col("arm") == "right"), ["source_uri"])


def assign_cohorts(file_offsets: DataFrame) -> DataFrame:
    """Add the cohort key: each pooled mean rounded to a centimetre (null when unobserved)."""
    observed = F.col("offset_count") > 0
    return file_offsets.select(
        "*",
        *(
            F.when(observed, cohort_coordinate(f"offset_mean_{a}")).alias(f"cohort_{a}")
            for a in OFFSET_AXES
        ),
    )


COHORT = tuple(f"cohort_{a}" for a in OFFSET_AXES)


def rig_cohorts(assigned: DataFrame) -> DataFrame:
    """One row per cohort, ordered by offset: files and pose records. Unobservable files are one row
    with a null cohort, so every file is accounted for."""
    return (
        assigned.groupBy(*COHORT)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("offset_count").alias("pose_records"))
        .orderBy(*COHORT)
    )


LINK_GAP_M = 0.002


def linked_cohorts(assigned: DataFrame, gap: float = LINK_GAP_M) -> DataFrame:
    """One row per rig of linked cohorts: ``rig`` (its first cohort), cohorts, files, pose records, range.

    A rounded mean puts 0.6049 and 0.6051 into two cohorts. Here neighbouring cohorts whose files' means come
    within ``gap`` of each other on every axis are one rig; the rounded key stays on every file
    (:func:`with_linked_cohort`). There are as many cells as rounded offsets, however many files.
    """
    rows = with_linked_cohort(assigned, gap)
    return (
        rows.groupBy("rig")
        .agg(
            F.count_distinct(*COHORT).alias("cohorts"),
            F.count(F.lit(1)).alias("files"),
            F.sum("offset_count").alias("pose_records"),
            *(f(f"offset_mean_{a}").alias(f"{n}_{a}") for a in OFFSET_AXES for n, f in (("least", F.min), ("most", F.max))),
        )
        .orderBy("rig")
    )


def with_linked_cohort(assigned: DataFrame, gap: float = LINK_GAP_M) -> DataFrame:
    """Add ``rig``, the name of the linked cohorts a file belongs to; null where nothing was observed."""
    scale = 10**C.COHORT_DECIMALS
    places = {a: F.round(F.col(f"cohort_{a}") * scale).cast("bigint") for a in OFFSET_AXES}
    name = F.concat_ws(",", *(F.format_string("%+07d", place) for place in places.values()))
    named = assigned.withColumn("cell", F.when(F.col("offset_count") > 0, name))
    axes, low, high = ([f"{n}_{a}" for a in OFFSET_AXES] for n in ("place", "low", "high"))
    cells = named.where("cell IS NOT NULL").groupBy("cell").agg(
        *(F.min(places[a]).alias(f"place_{a}") for a in OFFSET_AXES),
        *(F.min(f"offset_mean_{a}").alias(f"low_{a}") for a in OFFSET_AXES),
        *(F.max(f"offset_mean_{a}").alias(f"high_{a}") for a in OFFSET_AXES),
    )
    linked = linked_cells(cut_lineage(cells, "cells"), axes, low, high, 1 / scale, gap)
    return lookup_join(named, linked.withColumnRenamed("component", "rig"), ["cell"], derived=True).drop("cell")


def cohort_tasks(assigned: DataFrame) -> DataFrame:
    """Tasks of each cohort with their number of files: the sorted task list with repeats, stored as
    counts so that no list grows with the number of files."""
    return (
        assigned.where(F.col("offset_count") > 0)
        .groupBy(*COHORT, "task")
        .agg(F.count(F.lit(1)).alias("files"))
        .orderBy(*COHORT, "task")
    )


def attach_cohort_offset(scored: DataFrame, file_offsets: DataFrame) -> DataFrame:
    """Add each file's observed right-arm offset to its rows, null where unobserved."""
    table = file_offsets.where(F.col("offset_count") > 0).select(
        "source_uri", *(F.col(f"offset_mean_{a}").alias(f"base_{a}") for a in OFFSET_AXES)
    )
    return lookup_join(scored, table, ["source_uri"], how="left", derived=True)


def cohort_corrected(scored: DataFrame, file_offsets: DataFrame) -> DataFrame:
    """Residual translation after the right arm is moved by its file's own observed offset."""
    rows = attach_cohort_offset(scored.where("compared"), file_offsets)
    deltas = [
        f"(offset_{a} - IF(arm = 'right', coalesce(base_{a}, 0D), 0D))" for a in OFFSET_AXES
    ]
    return rows.withColumn(
        "corrected_translation_m", F.expr("sqrt(" + " + ".join(f"{d} * {d}" for d in deltas) + ")")
    )


def shared_frame_or_refusal(derived: DataFrame, assigned: DataFrame) -> DataFrame:
    """Move arm-local poses into the shared frame only where the file's cohort was observed.

    ``derived`` has ``source_uri, arm, fk_ok`` and ``fk_x .. fk_z``. Without a cohort the shared
    position is null and ``refusal`` says why. The left arm is the origin of the shared frame, but it
    is refused too: the frame itself is unproven for that file.
    """
    table = assigned.where(F.col("offset_count") > 0).select("source_uri", *COHORT)
    rows = lookup_join(derived, table, ["source_uri"], how="left", derived=True)
    known = F.col("cohort_x").isNotNull()
    return rows.select(
        *derived.columns,
        *(
            F.when(
                F.col("fk_ok") & known,
                F.col(f"fk_{a}") + F.when(F.col("arm") == "right", F.col(f"cohort_{a}")).otherwise(0.0),
            ).alias(f"shared_{a}")
            for a in OFFSET_AXES
        ),
        F.when(~F.col("fk_ok"), "no_arm_local_pose").when(~known, "cohort_unobserved").alias("refusal"),
    )


def residual_summary(rows: DataFrame, keys: list[str], value: str, tolerance: float = C.TRANSLATION_TOLERANCE_M) -> DataFrame:
    """Count, mean, rmse, max and number above tolerance of one residual column."""
    v = F.col(value)
    return rows.groupBy(*keys).agg(
        F.count(v).alias("compared"),
        F.avg(v).alias("mean"),
        F.sqrt(F.avg(v * v)).alias("rmse"),
        F.max(v).alias("max"),
        F.count_if(v > tolerance).alias("outside"),
    )
