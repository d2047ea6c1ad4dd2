"""Corpus rollup, named invariants and the conclusion drawn from file audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.operators.audit import COUNTS
from posefold.operators.cohorts import merged_residual_columns


def corpus_rollup(topics: DataFrame) -> DataFrame:
    """Totals per topic and over the corpus (``topic`` null) in one grouping-sets pass."""
    return topics.rollup("topic").agg(
        *(F.sum(name).alias(name) for name in COUNTS),
        *merged_residual_columns(),
        F.count_if(F.col("messages") == 0).alias("missing_topic_occurrences"),
    )


def corpus_totals(files: DataFrame, inventory: DataFrame, samples: DataFrame, summaries: DataFrame) -> DataFrame:
    """One row of corpus sums. All four inputs have one row per file."""
    joined = (
        files.join(inventory.select("source_uri", "size_bytes"), "source_uri", "left")
        .join(samples.select("source_uri", "n_messages"), "source_uri", "left")
        .join(summaries.select("source_uri", "all_messages", "plot_messages"), "source_uri", "left")
    )
    return joined.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size_bytes").alias("bytes"),
        F.sum("n_messages").alias("declared_all_messages"),
        F.sum("all_messages").alias("summary_all_messages"),
        F.sum("plot_messages").alias("plot_messages"),
        *(F.sum(name).alias(name) for name in COUNTS),
        F.sum("decode_errors").alias("decode_errors"),
        F.sum("missing_topic_count").alias("missing_topic_occurrences"),
        F.sum("issue_count").alias("issues"),
    )


def conclusion_facts(files: DataFrame, cohorts: DataFrame) -> DataFrame:
    """What the corpus shows, as one row computed from the file audits and the rig cohorts."""
    seen = cohorts.agg(
        F.count_if(F.col("cohort_x").isNotNull()).alias("observed_cohorts"),
        (F.count_if(F.col("cohort_x").isNotNull()) > 1).alias("several_base_offsets"),
    )
    facts = files.agg(
        (F.sum("missing_pose") > 0).alias("missing_poses_exist"),
        (F.sum("malformed_pose") > 0).alias("malformed_poses_exist"),
        (F.sum("nonfinite_pose") > 0).alias("nonfinite_poses_exist"),
        (F.sum("invalid_pose") > 0).alias("invalid_poses_exist"),
        F.count_if(F.col("invalid_pose") > 0).alias("episodes_with_invalid_poses"),
        F.count_if(F.col("invalid_pose") == F.col("messages")).alias("episodes_all_invalid"),
        F.try_divide(F.sum("missing_pose"), F.sum("messages")).alias("missing_pose_fraction"),
        F.sum("recoverable_invalid_pose").alias("recoverable_invalid_pose"),
        F.sum("unrecoverable_invalid_pose").alias("unrecoverable_invalid_pose"),
        F.count_if(F.col("fk_outside_tolerance") > 0).alias("episodes_outside_tolerance"),
    )
    return facts.join(F.broadcast(seen))  # one row each


def named_checks(row: DataFrame, checks: dict[str, Column], keep: list[str] = ()) -> DataFrame:
    """Turn boolean columns into (name, passed) rows. A check that cannot be told, as over no rows, fails."""
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("name"), F.coalesce(check, F.lit(False)).alias("passed"))
            for name, check in checks.items()
        )
    )
    return row.select(*keep, F.inline(entries))


def corpus_invariants(evidence: DataFrame, expected_files: int, uri_prefix: str, keep: list[str] = ()) -> DataFrame:
    """Eleven named checks over one evidence row per file that is listed, audited or both.

    ``evidence`` has the file audit plus ``listed, audited, size_matches, sha256_matches, unchanged,
    n_messages, all_messages, plot_messages, counts_match``; the checks compare accounting, not data
    quality, so a corpus full of missing poses can still pass all of them. What is null fails.
    """
    def every(text: str) -> Column:
        return F.every(F.coalesce(F.expr(text), F.lit(False)))

    checks = {
        "expected_file_count": F.count_if(F.expr("listed AND audited")) == expected_files,
        "sizes_match_inventory": every("size_matches"),
        "digests_match_inventory": every("sha256_matches"),
        "sources_unchanged_by_audit": every("unchanged"),
        "audit_sources_are_pinned_uris": every(
            f"listed AND audited AND startswith(source_uri, '{uri_prefix}')"
        ),
        "declared_plus_plot_equals_summary": every("n_messages + plot_messages = all_messages"),
        "decoded_counts_match_summary": every("counts_match"),
        "pose_classification_is_exhaustive": every("unclassified_topics = 0"),
        "offset_counts_match_compared": every("offset_mismatch_topics = 0"),
        "no_decode_errors": F.sum("decode_errors") == 0,
        "no_missing_target_topics": F.sum("missing_topic_count") == 0,
    }
    grouped = evidence.groupBy(*keep).agg(*(check.alias(name) for name, check in checks.items()))
    return named_checks(grouped, {name: F.col(name) for name in checks}, list(keep))


def corpus_audit_row(
    files: DataFrame, invariants: DataFrame, reconciliation: DataFrame, dataset_id: str, revision: str
) -> DataFrame:
    """Integrity verdict (accounting is sound) beside the data verdict (every file also passed) and
    whether the independent profile reconciles with the audit."""
    sound = invariants.agg(F.every("passed").alias("integrity_passed"))
    agreed = reconciliation.agg(F.every("passed").alias("reconciled"))
    passed = files.agg(F.every("passed").alias("files_passed"), F.count(F.lit(1)).alias("files"))
    return sound.join(F.broadcast(passed)).join(F.broadcast(agreed)).select(  # one row each
        F.lit(C.AUDIT_SCHEMA_VERSION).alias("schema_version"),
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(revision).alias("dataset_revision"),
        "files",
        "integrity_passed",
        "reconciled",
        (F.col("integrity_passed") & F.col("files_passed")).alias("passed"),
    )
