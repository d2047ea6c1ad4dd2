"""Registered queries: every operator run over whole tables derived from ``events`` and ``embeddings``.

Gate queries run on a clean and on a deliberately broken input and return both, told apart by a
``variant`` column. Numbers are rounded so that another engine's last digit does not matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions import text as X
from posefold.functions.kinematics import SIX_JOINT_ARM, ChainKinematics, FunctionKinematics
from posefold.functions.rotation import matrix_from_quaternion
from posefold.functions.spans import end_of_span
from posefold.operators import accounting, audit, augment, cohorts, corpus, difference, gates, identities, inventory
from posefold.operators import reconcile, recovery, series, sketches
from posefold.operators.scale import checkpoint_root, cut_lineage, hold
from posefold.plans import jobs
from posefold.plans.jobs import corpus_evidence
from posefold.sources import fixtures, records, sinks, skipping, store
from posefold.sources import frames as frame_source
from posefold.sources import inventory as inventory_source
from posefold.sources.files import file_fingerprints
from posefold.sources.frames import FrameSchemaError
from posefold.sources.messages import normalise_messages, read_arm_messages
from posefold.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACES, DEGREE_PLACES = 9, 4
DATASET, REVISION = "lab/arm-telemetry", "rev-1"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(column: str | Column, places: int = PLACES) -> Column:
    """Rounded value in which a negative zero has become zero."""
    return F.round(column, places) + F.lit(0.0)


def round_all(df: DataFrame) -> DataFrame:
    """Round every double column; angles in degrees more coarsely."""
    return df.select(
        *(
            rounded(name, DEGREE_PLACES if name.endswith("_deg") else PLACES).alias(name)
            if kind == "double" and name != "timestamp"
            else F.col(name).cast("bigint").alias(name)
            if kind in ("int", "smallint", "decimal(20,0)")
            else F.col(name)
            for name, kind in df.dtypes
        )
    )


def tag(df: DataFrame, variant: str) -> DataFrame:
    return df.withColumn("variant", F.lit(variant))


def episode_number(column: str = "source_uri") -> Column:
    return F.regexp_extract(column, r"episode_(\d+)/", 1).cast("int")


def number_text(column: str = "source_uri") -> str:
    return rf"cast(regexp_extract({column}, 'episode_(\\d+)/', 1) AS int)"


def is_clean(column: str = "source_uri") -> Column:
    return episode_number(column) % 5 != 4


def _scored(spark, sf, **options) -> DataFrame:
    return audit.score_messages(fixtures.arm_messages(spark, sf), **options)


def _topics(spark, sf) -> DataFrame:
    return audit.topic_audit(_scored(spark, sf))


def _files(spark, sf) -> DataFrame:
    return audit.file_audit(_topics(spark, sf))


def _statuses(spark, sf) -> DataFrame:
    return recovery.with_statuses(recovery.target_messages(fixtures.arm_messages(spark, sf)))


def _by_uri(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("source_uri", F.concat(F.lit("fx://"), F.col(path)))


# --- classification and audit --------------------------------------------------------------------


@query
def topic_counts_ignored(spark, sf):
    rows = audit.with_topic_roles(fixtures.arm_messages(spark, sf))
    return rows.groupBy("role", "topic", "arm", "stream").agg(F.count(F.lit(1)).alias("n"))


@query
def pose_class_by_topic(spark, sf):
    rows = recovery.target_messages(fixtures.arm_messages(spark, sf))
    return K.pose_status_only(rows).groupBy("topic", "pose_status").agg(F.count(F.lit(1)).alias("n"))


@query
def joint_class_by_topic(spark, sf):
    rows = recovery.target_messages(fixtures.arm_messages(spark, sf))
    return K.joint_status_only(rows).groupBy("topic", "joint_status").agg(F.count(F.lit(1)).alias("n"))


@query
def residuals_by_topic(spark, sf):
    rows = _scored(spark, sf).where("role = 'target'")
    grouped = rows.groupBy("topic").agg(
        F.count_if("compared").alias("compared"),
        F.count_if("outside").alias("outside"),
        *audit.residual_columns(),
    )
    return round_all(grouped)


@query
def base_offset_stats(spark, sf):
    topics = _topics(spark, sf)
    names = [n for n in audit.TOPIC_STATS if n.startswith("offset_")]
    return round_all(topics.select("source_uri", "topic", *names))


@query
def offset_merge_from_topics(spark, sf):
    return round_all(cohorts.observed_right_offsets(_topics(spark, sf)))


@query
def offset_merge_by_arm(spark, sf):
    topics = _topics(spark, sf)
    residuals = topics.groupBy("arm").agg(*cohorts.merged_residual_columns())
    return round_all(cohorts.merge_offsets(topics, ["arm"]).join(residuals, "arm"))


@query
def rig_cohorts(spark, sf):
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(_topics(spark, sf)))
    return round_all(cohorts.rig_cohorts(assigned))


@query
def rig_cohort_tasks(spark, sf):
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(_topics(spark, sf)))
    return round_all(cohorts.cohort_tasks(assigned.withColumn("task", X.task_from_path("source_uri"))))


@query
def file_audit_verdict(spark, sf):
    return _files(spark, sf)


@query
def batch_totals(spark, sf):
    return audit.batch_audit(_files(spark, sf))


@query
def corpus_rollup(spark, sf):
    return round_all(corpus.corpus_rollup(_topics(spark, sf)))


@query
def corpus_totals(spark, sf):
    channels = inventory.channel_summary(fixtures.channel_counts(spark, sf))
    listing = fixtures.inventory(spark, sf).withColumnRenamed("size", "size_bytes")
    samples = _by_uri(fixtures.samples(spark, sf), "filepath")
    return corpus.corpus_totals(_files(spark, sf), _by_uri(listing), samples, _by_uri(channels))


@query
def conclusion_facts(spark, sf):
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(_topics(spark, sf)))
    return round_all(corpus.conclusion_facts(_files(spark, sf), cohorts.rig_cohorts(assigned)))


@query
def issue_sample(spark, sf):
    detailed = _scored(spark, sf, details=True, keep=("sequence",))
    sample = audit.issue_sample(audit.issues(detailed), _files(spark, sf), 7)
    shown = F.when(F.col("code") != "fk_residual_outside_tolerance", F.col("detail"))
    return sample.select(
        "source_uri",
        "topic",
        F.col("log_time_ns").cast("bigint").alias("log_time_ns"),
        "sequence",
        "code",
        shown.alias("detail"),
        "issue_count",
        "truncated",
    )


@query
def missing_topics(spark, sf):
    return round_all(audit.missing_topics(_topics(spark, sf)))


@query
def decode_error_counts(spark, sf):
    rows = fixtures.arm_messages(spark, sf)
    # A second variant loses the topic of some rows, which makes them unusable records.
    lost = rows.withColumn("topic", F.when(F.col("sequence") % 89 != 0, F.col("topic")))
    both = tag(recovery.message_facts(rows), "clean").unionByName(tag(recovery.message_facts(lost), "lost_topics"))
    return both.select("variant", "source_uri", "decode_errors", "record_errors")


# --- kinematics ----------------------------------------------------------------------------------


@query
def fk_pose_arm_local(spark, sf):
    rows = _statuses(spark, sf).where("fk_status = 'derived'")
    return rows.select(
        "source_uri",
        "sequence",
        *(rounded(f"fk_{n}").alias(n) for n in ("x", "y", "z", "qw", "qx", "qy", "qz")),
    )


@query
def pose_roundtrip_matrix(spark, sf):
    rows = _statuses(spark, sf).where("fk_status = 'derived'")
    return rows.select(
        "sequence",
        *(rounded(F.expr(text)).alias(name) for name, text in matrix_from_quaternion("fk_").items()),
    )


@query
def joint_limit_violations(spark, sf):
    return round_all(accounting.joint_limit_violations(fixtures.arm_messages(spark, sf)))


@query
def joint_limit_refusal(spark, sf):
    """Outcomes when joints outside the declared ranges are refused."""
    rows = recovery.with_statuses(recovery.target_messages(fixtures.arm_messages(spark, sf)), limits=SIX_JOINT_ARM)
    return rows.groupBy("topic", "joint_status", "recovery_status").agg(F.count(F.lit(1)).alias("n"))


@query
def cohort_corrected_residuals(spark, sf):
    scored = _scored(spark, sf)
    offsets = cohorts.observed_right_offsets(audit.topic_audit(scored))
    corrected = cohorts.cohort_corrected(scored, offsets)
    return round_all(cohorts.residual_summary(corrected, ["topic"], "corrected_translation_m"))


@query
def shared_frame_or_refusal(spark, sf):
    offsets = cohorts.observed_right_offsets(_topics(spark, sf))
    derived = _statuses(spark, sf).withColumn("fk_ok", F.col("fk_status") == "derived")
    shared = cohorts.shared_frame_or_refusal(
        derived.select("source_uri", "sequence", "arm", "fk_ok", "fk_x", "fk_y", "fk_z"),
        cohorts.assign_cohorts(offsets),
    )
    return round_all(
        shared.select("source_uri", "sequence", "arm", "shared_x", "shared_y", "shared_z", "refusal")
    )


# --- recovery ------------------------------------------------------------------------------------


@query
def recovery_rows(spark, sf):
    sources = fixtures.source_table(spark, sf).withColumnRenamed("sha256", "source_sha256")
    resolved = recovery.resolve_sources(sources, _sessions(spark, sf))
    rows = recovery.recovery_rows(fixtures.arm_messages(spark, sf), resolved)
    names = ("x", "y", "z", "qw", "qx", "qy", "qz")
    return round_all(
        rows.select(
            *(c for c in rows.columns if c != "pose_arm_local"),
            *(F.nanvl(F.get("pose_arm_local", F.lit(i)), F.lit(None)).alias(n) for i, n in enumerate(names)),
        )
    )


@query
def recovery_status_hist(spark, sf):
    return recovery.status_histogram(_statuses(spark, sf))


@query
def quarantine(spark, sf):
    return round_all(accounting.quarantine(_statuses(spark, sf)))


@query
def accounting_three_way(spark, sf):
    channels = _by_uri(fixtures.channel_counts(spark, sf)).drop("path")
    return accounting.three_way_accounting(_statuses(spark, sf), channels)


@query
def audit_matrix(spark, sf):
    return round_all(accounting.audit_matrix(_statuses(spark, sf)))


@query
def audit_matrix_by_cohort(spark, sf):
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(_topics(spark, sf)))
    return round_all(accounting.audit_matrix_by_cohort(_statuses(spark, sf), assigned))


def _fragile(joints, arms):
    """A model that reports no number for some joints and raises for others."""
    if (joints[:, 1] > 1.2).any():
        raise ValueError("second joint out of reach")
    poses = np.zeros((len(joints), 7))
    poses[:, 3] = np.where(joints[:, 0] > 0.9, np.nan, 1.0)
    return poses


@query
def fk_failure_statuses(spark, sf):
    """All six recovery statuses, through a Python model that fails on some rows."""
    messages = recovery.target_messages(fixtures.arm_messages(spark, sf))
    rows = recovery.with_statuses(messages, FunctionKinematics(_fragile))
    return rows.groupBy("topic", "recovery_status", "fk_status", F.col("status_mask").cast("bigint").alias("status_mask")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def fk_failure_audit(spark, sf):
    """Failures as the audit counts them, by topic."""
    topics = audit.topic_audit(_scored(spark, sf, kinematics=FunctionKinematics(_fragile)))
    counts = ("messages", "fk_failures", "fk_compared", "recoverable_invalid_pose", "unrecoverable_invalid_pose")
    return topics.groupBy("topic").agg(*(F.sum(name).alias(name) for name in counts))


@query
def frame_failure_masks(spark, sf):
    """All three frame masks, through the same model."""
    rows = augment.augment_frames(fixtures.frames(spark, sf), None, FunctionKinematics(_fragile))
    masks = ("valid_mask", "invalid_input_mask", "derivation_failure_mask")
    return rows.groupBy(*(F.col(m).cast("bigint").alias(m) for m in masks)).agg(F.count(F.lit(1)).alias("n"))


@query
def envelope_range_violations(spark, sf):
    rows = fixtures.arm_messages(spark, sf)
    broken = rows.withColumns(
        {
            "publish_time_ns": F.expr("IF(sequence % 50 = 0, cast(-1 AS decimal(20,0)), publish_time_ns)"),
            "log_time_ns": F.expr("IF(sequence % 70 = 0, NULL, log_time_ns)"),
            "sequence": F.expr("IF(sequence % 30 = 0, sequence + 4294967296, sequence)"),
        }
    )
    both = tag(recovery.message_facts(rows), "clean").unionByName(tag(recovery.message_facts(broken), "broken"))
    return both.select("variant", "source_uri", "rows", "bad_log_time_ns", "bad_publish_time_ns", "bad_sequence")


def _sessions(spark, sf, conflicting=False) -> DataFrame:
    from posefold.sources.messages import session_episodes

    return session_episodes(fixtures.session_metadata(spark, sf, conflicting))


@query
def episode_resolution(spark, sf):
    sources = fixtures.source_table(spark, sf).select("source_uri", "path")
    number = episode_number("path")
    given = sources.withColumn("episode", F.when(number % 8 == 0, F.lit("\t given\n")).when(number % 8 == 3, F.lit(" \t\n")))
    clean = recovery.resolve_sources(sources, _sessions(spark, sf))
    broken = recovery.resolve_sources(given, _sessions(spark, sf, conflicting=True))
    columns = ["source_uri", "task", "episode", "episode_from", "conflict", "blank_identity"]
    return tag(clean.select(*columns), "clean").unionByName(tag(broken.select(*columns), "broken"))


@query
def release_selection(spark, sf):
    facts = gates.release_facts(_files(spark, sf))
    return facts.withColumn("clean", is_clean())


@query
def release_gate(spark, sf):
    facts = gates.release_facts(_files(spark, sf))
    everything = gates.release_gate(facts)
    clean = gates.release_gate(facts.where(is_clean()))
    return tag(everything, "all").unionByName(tag(clean, "clean")).drop("detail")


@query
def release_rows(spark, sf):
    """Rows of the selected files, each of which must come out as recovered."""
    messages = fixtures.arm_messages(spark, sf)
    facts = gates.release_facts(_files(spark, sf)).where(is_clean())
    rows = recovery.with_statuses(recovery.target_messages(gates.select_release(messages, facts)))
    return rows.groupBy("source_uri", "recovery_status").agg(
        F.count(F.lit(1)).alias("n"), F.max("status_mask").cast("bigint").alias("status_mask")
    )


# --- series and distributions --------------------------------------------------------------------


@query
def stride_series(spark, sf):
    rows = series.strided_states(fixtures.arm_messages(spark, sf), 20)
    return round_all(
        rows.select(
            "source_uri", "arm", "ordinal", "sequence", "log_time_ns",
            *(F.when(F.col("residual_m").isNotNull(), F.col(f"{side}_{a}")).alias(f"{side}_{a}")
              for side in ("rec", "der") for a in "xyz"),
            "residual_m",
        )
    )


@query
def series_summary(spark, sf):
    return round_all(series.series_summary(series.recorded_vs_derived(fixtures.arm_messages(spark, sf)), 20))


@query
def residual_quantiles(spark, sf):
    scored = _scored(spark, sf).where("compared")
    scored = scored.select("topic", rounded("translation_m").alias("residual"))
    return round_all(accounting.residual_quantiles(scored, "residual", ["topic"], (0.5, 0.9, 0.95, 0.99, 1.0)))


@query
def residual_sketches(spark, sf):
    """Residual quantiles of topics, files and the corpus from the sketches of one stored topic audit: rows
    behind each, and whether the exact rank of the estimate is within the stated bound."""
    scored = _scored(spark, sf)
    topics = cut_lineage(audit.topic_audit(scored, sketches.SKETCH_K), "topics")
    probabilities = (0.05, 0.25, 0.5, 0.9, 0.99)
    found = []
    for level, keys in (("topic", ["topic"]), ("file", ["source_uri"]), ("corpus", [])):
        estimates = cut_lineage(sketches.sketch_quantiles(topics, "translation", keys, probabilities), "estimates")
        errors = sketches.rank_errors(estimates, hold(scored, ["translation_m"]), "translation_m", keys)
        named = F.col(keys[0]) if keys else F.lit("all")
        found.append(
            errors.select(
                F.lit(level).alias("level"), named.alias("name"), "probability", "total",
                (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_bound"),
            )
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def incremental_topic_audit(spark, sf):
    """The topic audit of messages that arrive in four parts and three runs, two of them repeated, with a
    compaction in between: as if audited at once."""
    inbox, output = _folder(spark, "inbox"), _folder(spark, "stored")
    messages = fixtures.arm_messages(spark, sf)
    part = F.pmod(F.hash("sequence"), F.lit(4))
    for number in range(4):
        messages.where(part == number).write.mode("append").parquet(inbox)
        if number < 2:
            incremental.audit_new_files(spark, inbox, output)
    incremental.compact(spark, output)
    incremental.absorb(messages.where(part == 1), 1, output)
    incremental.audit_new_files(spark, inbox, output)
    incremental.absorb(messages.where(part >= 2), 2, output)
    topics = incremental.stored_topics(spark, output).drop(*audit.SKETCHES, "topic_order", "arm", "stream")
    return round_all(topics)


@query
def worst_residuals(spark, sf):
    scored = _scored(spark, sf, keep=("sequence",)).where("compared")
    scored = scored.select("source_uri", "topic", "sequence", rounded("translation_m").alias("residual"))
    return accounting.worst_residuals(scored, "residual", ["topic"], 5, ["source_uri", "sequence"])


# --- frames --------------------------------------------------------------------------------------


@query
def frame_masks(spark, sf):
    rows = augment.frame_masks(fixtures.frames(spark, sf))
    return round_all(rows.select("source_uri", "source_row", "valid_mask", "invalid_input_mask"))


@query
def frame_mask_bit_counts(spark, sf):
    return augment.mask_bit_counts(augment.augment_frames(fixtures.frames(spark, sf)))


@query
def frame_sidecar_poses(spark, sf):
    rows = augment.augment_frames(fixtures.frames(spark, sf))
    parts = ("x", "y", "z", "qw", "qx", "qy", "qz")
    for limb in C.LIMBS:  # rounding is bulky code, so each limb's seven values get their own span
        rows = rows.select(
            "*", *(rounded(F.get(limb.pose, F.lit(i))).alias(f"{limb.pose}_{part}") for i, part in enumerate(parts))
        ).drop(limb.pose)
        rows = end_of_span(rows, "timestamp")
    masks = ("valid_mask", "invalid_input_mask", "derivation_failure_mask")
    return rows.select(
        *(c for c in rows.columns if c not in ("source_sha256", *masks)),
        *(F.col(m).cast("bigint").alias(m) for m in masks),
    )


def _keyed_frames(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys of the frames, of their sidecar, and of a sidecar with lost, repeated, changed and moved keys."""
    keys = ["source_uri", "source_row", *C.FRAME_KEYS]
    source = fixtures.frames(spark, sf).select(*keys)
    sidecar = augment.augment_frames(fixtures.frames(spark, sf)).select(*keys)
    row = F.col("source_row")
    broken = (
        sidecar.where(row % 101 != 0)
        .withColumn("copies", F.when(row % 103 == 0, 2).otherwise(1))
        .withColumn("frame_index", F.when(row % 107 == 0, F.col("frame_index") + 1).otherwise(F.col("frame_index")))
        .withColumn("source_row", F.when(row % 109 == 0, -row - 1).otherwise(row))
        .select(*keys, F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy"))
        .drop("copy")
    )
    return source, sidecar, broken


@query
def sidecar_key_integrity(spark, sf):
    source, sidecar, broken = _keyed_frames(spark, sf)
    clean = tag(augment.key_integrity(source, sidecar), "clean")
    return clean.unionByName(tag(augment.key_integrity(source, broken), "broken"))


@query
def sidecar_integrity_by_difference(spark, sf):
    """The same by difference: only ranges that differ are looked into, and only rows that may differ compared."""
    source, sidecar, broken = _keyed_frames(spark, sf)
    values = list(C.FRAME_KEYS)
    clean, _ = difference.integrity_by_difference(source, sidecar, values, range_rows=4096)
    faulty, _ = difference.integrity_by_difference(source, broken, values, range_rows=4096)
    return tag(clean, "clean").unionByName(tag(faulty, "broken"))


@query
def frame_key_violations(spark, sf):
    rows = fixtures.frames(spark, sf)
    broken = rows.withColumns(
        {
            "episode_index": F.expr("IF(source_row % 41 = 0, NULL, episode_index)"),
            "index": F.expr("IF(source_row % 43 = 0, NULL, index)"),
            "timestamp": F.expr(
                "CASE WHEN source_row % 47 = 0 THEN double('NaN') WHEN source_row % 53 = 0 THEN"
                " double('-Infinity') WHEN source_row % 59 = 0 THEN NULL ELSE timestamp END"
            ),
        }
    )
    clean = tag(augment.key_violations(rows), "clean")
    return clean.unionByName(tag(augment.key_violations(broken), "broken"))


# --- inventory and identity ----------------------------------------------------------------------


@query
def inventory_samples_join(spark, sf):
    listing, samples = fixtures.inventory(spark, sf), fixtures.samples(spark, sf)
    number = episode_number("path")
    sample_number = episode_number("filepath")
    doubled = listing.withColumn("n", F.when(number == 2, 2).otherwise(1)).select(
        *listing.columns, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    )
    lost = samples.where(sample_number != 1)
    moved = lost.withColumns(
        {
            "split": F.when(sample_number == 3, "train").otherwise(F.col("split")),
            "filepath": F.when(sample_number == 4, F.lit("data/val/task_99/episode_99/other.mcap")).otherwise(F.col("filepath")),
        }
    )
    clean = tag(inventory.match_samples(listing, samples), "clean")
    return clean.unionByName(tag(inventory.match_samples(doubled.drop("copy"), moved), "broken"))


@query
def inventory_fingerprint(spark, sf):
    return inventory.inventory_fingerprint(fixtures.inventory(spark, sf))


@query
def inventory_tree_digest(spark, sf):
    return inventory.inventory_tree_digest(fixtures.inventory(spark, sf), fanout=64)


@query
def inventory_file_identity(spark, sf):
    listing = fixtures.inventory(spark, sf)
    number = episode_number("path")
    seen = listing.where(number != 9).select(
        "path",
        F.when(number == 7, F.col("size") + 1).otherwise(F.col("size")).alias("size_bytes"),
        F.when(number == 8, F.concat(F.lit("sha256:"), F.upper("lfs_oid")))
        .when(number == 6, F.reverse("lfs_oid"))
        .otherwise(F.col("lfs_oid"))
        .alias("sha256"),
    )
    return inventory.file_identity(listing, seen)


@query
def inventory_gates(spark, sf):
    from posefold.sources.inventory import normalise_inventory

    listing = fixtures.inventory(spark, sf)
    number = episode_number("path")
    entries = listing.select(
        F.lit("file").alias("type"), "path", "size", "oid",
        F.struct(F.col("lfs_oid").alias("oid"), F.col("lfs_size").alias("size")).alias("lfs"),
    )
    broken = entries.select(
        F.when(number == 1, "directory").otherwise(F.col("type")).alias("type"),
        F.when(number == 2, F.expr(fixtures.file_path("3"))).otherwise(F.col("path")).alias("path"),
        F.when(number == 5, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
        F.when(number == 6, F.lit("xyz")).otherwise(F.upper("oid")).alias("oid"),
        F.struct(F.concat(F.lit("sha256:"), F.col("lfs.oid")).alias("oid"), F.col("lfs.size").alias("size")).alias("lfs"),
    )
    clean = tag(inventory.inventory_gate_facts(normalise_inventory(entries)), "clean")
    return clean.unionByName(tag(inventory.inventory_gate_facts(normalise_inventory(broken)), "broken"))


@query
def source_identity(spark, sf):
    observed = fixtures.source_table(spark, sf)
    number = episode_number("path")
    expected = observed.select(
        "source_uri",
        F.when(number % 4 == 0, F.lit(None)).when(number == 7, F.reverse("sha256")).otherwise(F.upper("sha256")).alias("expected_sha256"),
        F.when(number == 3, F.col("size_bytes") + 1).when(number % 4 >= 2, F.col("size_bytes")).alias("expected_size_bytes"),
    )
    return inventory.source_identity(expected, observed).select("source_uri", "size_bytes", "status")


@query
def source_deduplication(spark, sf):
    sources = fixtures.source_table(spark, sf)
    number = episode_number("path")
    again = sources.where(number % 3 == 0)
    other = sources.where(number == 6).withColumn("size_bytes", F.col("size_bytes") + 5)
    unique = inventory.deduplicate_sources(sources.unionByName(again).unionByName(other))
    return unique.select("path", "copies", "conflict")


@query
def canonical_uris(spark, sf):
    rows = fixtures.samples(spark, sf)
    number = episode_number("filepath")
    uri = X.pinned_uri(DATASET, REVISION, "filepath")
    rows = rows.select(
        F.col("filepath").alias("path"),
        uri.alias("uri"),
        X.resolve_url("https://files.example.org", DATASET, REVISION, "filepath").alias("url"),
        F.when(number % 2 == 1, F.replace(uri, F.lit("_"), F.lit("%5F"))).otherwise(uri).alias("given"),
        F.when(number == 3, "other_task").otherwise(F.col("task")).alias("task"),
        F.when(number % 4 == 0, F.regexp_replace("episode_id", "^episode_", "")).otherwise(F.col("episode_id")).alias("episode"),
    )
    return rows.select("path", "uri", "url", "task", "episode", X.uri_names_episode("given", "task", "episode").alias("consistent"))


@query
def channel_summary_reconcile(spark, sf):
    topics = _topics(spark, sf)
    channels = fixtures.channel_counts(spark, sf)
    number = episode_number("path")
    broken = channels.withColumn(
        "n", F.when((number == 1) & (F.col("topic") == "/left-arm-state"), F.col("n") + 1).otherwise(F.col("n"))
    )

    def report(table: DataFrame) -> DataFrame:
        compared = reconcile.decoded_vs_declared(topics, _by_uri(table))
        return compared.join(_by_uri(inventory.channel_summary(table)).drop("path"), "source_uri", "left")

    return tag(report(channels), "clean").unionByName(tag(report(broken), "broken"))


# --- reconciliation ------------------------------------------------------------------------------


@query
def field_length_hist(spark, sf):
    profile = reconcile.field_profile(fixtures.arm_messages(spark, sf))
    return round_all(reconcile.length_histogram(profile, ["source_uri"]))


@query
def field_length_hist_corpus(spark, sf):
    profile = reconcile.field_profile(fixtures.arm_messages(spark, sf))
    return round_all(reconcile.length_histogram(profile))


def _variants(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Repeat the rows of clean files under every variant and of faulty files under ``all`` only."""
    present = F.when(is_clean(), F.array(*map(F.lit, names))).otherwise(F.array(F.lit("all")))
    return df.withColumn("variant", F.explode(present))


@query
def cross_check(spark, sf):
    names = ("all", "clean", "tampered")
    profile = _variants(reconcile.field_profile(fixtures.arm_messages(spark, sf)), names)
    files = _variants(_files(spark, sf), names)
    digests = _variants(
        fixtures.source_table(spark, sf).select("source_uri", F.col("sha256").alias("primary_sha256"), "sha256"), names
    )
    changed = (F.col("variant") == "tampered") & (episode_number() == 1)
    digests = digests.withColumn("sha256", F.when(changed, F.reverse("sha256")).otherwise(F.col("sha256")))
    return reconcile.cross_check(profile, files, digests, ["variant"])


#: One planted violation for each invariant, in file number 1; ``all`` also holds the faulty files.
BROKEN = (
    "lost_file", "wrong_size", "wrong_digest", "changed_source", "foreign_uri", "extra_message", "miscounted_topic",
    "unclassified", "offset_mismatch", "decode_error", "missing_topic",
)


@query
def invariants(spark, sf):
    names = ("all", "clean", *BROKEN)
    variant = F.col("variant")
    one = episode_number() == 1

    def planted(name: str, column: str, changed: Column) -> Column:
        return F.when((variant == name) & one, changed).otherwise(F.col(column))

    def moved(df: DataFrame) -> DataFrame:
        return df.withColumn("source_uri", planted("foreign_uri", "source_uri", F.concat(F.lit("other:"), "source_uri")))

    files = _variants(_files(spark, sf), names).withColumns(
        {
            "unclassified_topics": planted("unclassified", "unclassified_topics", F.lit(1)),
            "offset_mismatch_topics": planted("offset_mismatch", "offset_mismatch_topics", F.lit(1)),
            "decode_errors": planted("decode_error", "decode_errors", F.col("decode_errors") + 1),
            "missing_topic_count": planted("missing_topic", "missing_topic_count", F.col("missing_topic_count") + 1),
        }
    )
    listing = _variants(_by_uri(fixtures.inventory(spark, sf)), names)
    observed = listing.select(
        "variant",
        "path",
        planted("wrong_size", "size", F.col("size") + 1).alias("size_bytes"),
        planted("wrong_digest", "lfs_oid", F.reverse("lfs_oid")).alias("sha256"),
        one.alias("one"),
    )
    after = observed.withColumn(
        "sha256", F.when((variant == "changed_source") & F.col("one"), F.reverse("sha256")).otherwise(F.col("sha256"))
    )
    topic = F.col("topic")
    channels = _variants(_by_uri(fixtures.channel_counts(spark, sf)), names)
    channels = channels.withColumn(
        "n",
        F.col("n")
        + F.when((variant == "extra_message") & one & (topic == "/camera/top"), 1).otherwise(0)
        + F.when((variant == "miscounted_topic") & one & (topic == "/camera/top"), -1)
        .when((variant == "miscounted_topic") & one & (topic == "/left-arm-state"), 1)
        .otherwise(0),
    )
    evidence = corpus_evidence(
        moved(files),
        moved(_variants(_topics(spark, sf), names)),
        moved(listing.where(~((variant == "lost_file") & one))),
        moved(_variants(_by_uri(fixtures.samples(spark, sf), "filepath"), names)),
        moved(channels),
        observed.drop("one"),
        after.drop("one"),
        keep=["variant"],
    )
    expected = fixtures.inventory(spark, sf).where(episode_number("path") % 5 != 4).count()
    return corpus.corpus_invariants(evidence, expected, "fx://data/val/", ["variant"])


# --- publication ---------------------------------------------------------------------------------


@query
def file_fingerprints_of_tables(spark, sf):
    found = file_fingerprints(spark, sf, glob="*.parquet")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "size_bytes", "sha256")


@query
def content_fingerprints(spark, sf):
    """Digest and git object id of every document and page, as of a file with that content."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.concat(F.lit("document "), "doc_id").alias("name"), F.encode("text", "utf-8").alias("content")
    )
    pages = spark.read.parquet(f"{sf}/pages.parquet").select(
        F.concat(F.lit("page "), "page_id").alias("name"), F.encode("html", "utf-8").alias("content")
    )
    both = rows.unionByName(pages)
    return both.select(
        "name",
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
        X.git_blob_oid().alias("git_oid"),
    )


@query
def reused_uris(spark, sf):
    """URIs that several paths claim: every fifth file takes its neighbour's."""
    sources = fixtures.source_table(spark, sf)
    number = episode_number("path")
    taken = F.expr(fixtures.source_uri_of(fixtures.file_path(f"({number_text('path')} - 1)")))
    shared = sources.withColumn("source_uri", F.when(number % 5 == 1, taken).otherwise(F.col("source_uri")))
    unique = inventory.deduplicate_sources(shared)
    return inventory.reused_uris(unique)


@query
def publish_and_verify(spark, sf):
    """Publish the frame sidecar, accept it through its manifest and count it by mask."""
    import uuid

    rows = augment.augment_frames(fixtures.frames(spark, sf))
    published = sinks.describe_columns(rows, C.SIDECAR_COLUMNS, sinks.model_facts(ChainKinematics()))
    output = f"{checkpoint_root(spark)}/publication-{uuid.uuid4().hex}"
    expected = fixtures.frames(spark, sf).count()
    sinks.publish(published, output, C.SIDECAR_SCHEMA_VERSION, expected, {"query": "publish_and_verify"})
    accepted = sinks.read_published(spark, output)
    return accepted.groupBy(F.col("`geometry.valid_mask`").cast("bigint").alias("valid_mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("`action.right_arm.pose.arm_local`") == 7).alias("right_action_poses"),
    )


@query
def planted_canaries(spark, sf):
    return accounting.canary_report(accounting.plant_canaries(fixtures.arm_messages(spark, sf)))


@query
def content_digest_stable(spark, sf):
    """Digests of statuses and derived poses: derived twice under different partitionings they agree, and one
    joint moved a little, which changes no status, makes another digest."""

    def digest(messages: DataFrame, variant: str) -> DataFrame:
        rows = recovery.with_statuses(recovery.target_messages(messages))
        poses = [rounded(f"fk_{name}").alias(f"fk_{name}") for name in ("x", "y", "z", "qw", "qx", "qy", "qz")]
        kept = rows.select("source_uri", "topic", "sequence", *recovery.STATUSES, "status_mask", *poses)
        return tag(gates.content_digest(kept), variant)

    messages = fixtures.arm_messages(spark, sf)
    here = F.col("sequence") == F.lit(_last_clean_sequence(messages))
    changed = messages.withColumn(
        "position", F.when(here, F.transform("position", lambda q: q + 0.001)).otherwise(F.col("position"))
    )
    several = (
        digest(messages, "first")
        .unionByName(digest(messages.repartition("sequence"), "again"))
        .unionByName(digest(changed, "changed"))
    )
    wide = several.groupBy("rows").pivot("variant", ["first", "again", "changed"]).agg(F.min("digest"))
    return wide.select(
        "rows", (F.col("first") == F.col("again")).alias("stable"), (F.col("first") != F.col("changed")).alias("sees_a_change")
    )


def _last_clean_sequence(messages: DataFrame) -> int:
    rows = K.pose_status_only(recovery.target_messages(messages).where(is_clean()))
    return rows.where("pose_status = 'intact'").agg(F.max("sequence")).first()[0]


@query
def tangled_identities(spark, sf):
    """Groups of sources that hang together: every fifth file takes its neighbour's URI, and of nine in a row
    two have the digest of the one before; files with names of their own are in none."""
    sources = fixtures.source_table(spark, sf)
    number = episode_number("path")
    taken = F.expr(fixtures.source_uri_of(fixtures.file_path(f"({number_text('path')} - 1)")))
    digest = F.when((number % 9).isin(2, 3), F.sha2(F.expr(f"cast({number_text('path')} DIV 9 AS string)"), 256))
    mixed = sources.withColumns(
        {
            "source_uri": F.when(number % 5 == 1, taken).otherwise(F.col("source_uri")),
            "sha256": F.coalesce(digest, F.when(number % 9 == 1, F.sha2(F.expr(f"cast({number_text('path')} DIV 9 AS string)"), 256)), "sha256"),
        }
    )
    groups = identities.tangled_groups(mixed)
    return identities.group_facts(groups)


@query
def linked_rig_cohorts(spark, sf):
    """Rigs of files whose mean offsets lie on both sides of a cell's edge, beside the cohorts they round to."""
    offsets = cohorts.observed_right_offsets(_topics(spark, sf))
    side = F.when(episode_number() % 2 == 0, 0.0051).otherwise(0.0049)
    moved = offsets.withColumn("offset_mean_y", F.col("offset_mean_y") + side)
    rigs = cohorts.linked_cohorts(cohorts.assign_cohorts(moved))
    return round_all(rigs.select("rig", "cohorts", "files", "pose_records", "least_y", "most_y"))


# --- jobs ----------------------------------------------------------------------------------------


def _folder(spark, name: str) -> str:
    import uuid

    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _scanned_messages(spark, sf, clean_only: bool = True) -> tuple[DataFrame, str]:
    """The messages as another pipeline's table on disk, read back through the scan."""
    folder = _folder(spark, "messages")
    raw = fixtures.arm_messages(spark, sf, clean_only).withColumnsRenamed({"pose": "matrix", "position": "joints"})
    raw.write.parquet(folder)
    renamed = normalise_messages(spark.read.parquet(folder), {"matrix": "pose", "joints": "position"})
    stored = _folder(spark, "decoded")
    renamed.write.parquet(stored)
    return read_arm_messages(spark, stored), stored


def _refusal(spark, job) -> DataFrame:
    """The names of the gates that refuse the job, a row each; no row if nothing does."""
    try:
        job()
        names = []
    except gates.Refused as refused:
        names = [part.split(":")[0] for part in str(refused).split("; ")]
    except FrameSchemaError as refused:
        names = [re.sub(r"^\S+: ", "", str(refused)).split(":")[0]]
        names = [re.sub(r" and \d+ more$", "", name) for name in names]
    except ValueError as refused:
        names = [str(refused).split(" has ")[0]]
    return spark.createDataFrame([(name,) for name in names], "gate string")


def _job_rows(published: DataFrame, refusal: DataFrame) -> DataFrame:
    return published.withColumn("gate", F.lit(None).cast("string")).unionByName(refusal, allowMissingColumns=True)


@query
def job_recovery(spark, sf):
    """The recovery sidecar through scan, job, manifest and verified read; refused on a wrong digest."""
    messages, stored = _scanned_messages(spark, sf)
    sources = fixtures.source_table(spark, sf).where(is_clean())
    sources = sources.withColumn("expected_sha256", F.upper("sha256"))
    output = _folder(spark, "recovery")
    jobs.run_recovery(messages, sources, output, sessions=_sessions(spark, sf), source_files=[stored])
    rows = sinks.read_published(spark, output)
    counted = rows.groupBy(
        F.col("`provenance.source_uri`").alias("source_uri"),
        F.col("`provenance.episode`").alias("episode"),
        F.col("`geometry.recovery_status`").alias("recovery_status"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("`provenance.source_message_index`").cast("bigint").alias("first_ordinal"),
        F.max("`provenance.source_message_index`").cast("bigint").alias("last_ordinal"),
        F.count_if(F.size("`geometry.pose.arm_local`") == 7).alias("poses"),
    )
    wrong = sources.withColumn("expected_sha256", F.reverse("sha256"))
    refusal = _refusal(spark, lambda: jobs.run_recovery(messages, wrong, _folder(spark, "refused")))
    return _job_rows(counted, refusal)


@query
def job_recovery_in_place(spark, sf):
    """The recovery sidecar from a bucketed store, numbered and derived where the payload lies. Its digest
    is that of the job over the plain table."""
    messages, _ = _scanned_messages(spark, sf)
    sources = fixtures.source_table(spark, sf).where(is_clean())
    path = _folder(spark, "store")
    name = f"store_{path[-32:]}"
    stored = store.store_messages(messages, name, path, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))), slab_ns=3_600_000_000_000)
    outputs = {rows: _folder(spark, "recovery") for rows in ("in_place", "moved")}
    digests = {
        rows: jobs.run_recovery(table, sources, outputs[rows], sessions=_sessions(spark, sf))["content_digest"]
        for rows, table in (("in_place", stored), ("moved", messages))
    }
    rows = sinks.read_published(spark, outputs["in_place"])
    return rows.groupBy(
        F.col("`provenance.source_uri`").alias("source_uri"), F.col("`provenance.episode`").alias("episode")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("`provenance.source_message_index`").cast("bigint").alias("first_ordinal"),
        F.max("`provenance.source_message_index`").cast("bigint").alias("last_ordinal"),
        F.count_distinct("`provenance.source_message_index`").alias("ordinals"),
        F.lit(digests["in_place"] == digests["moved"]).alias("same_digest"),
    )


@query
def job_release(spark, sf):
    """The release of the fully missing files; refused where a file is mixed, and on a stale audit."""
    messages, stored = _scanned_messages(spark, sf)
    files = cut_lineage(audit.file_audit(audit.topic_audit(audit.score_messages(messages))), "files")
    sources = fixtures.source_table(spark, sf)
    output = _folder(spark, "release")
    jobs.run_release(messages, files, sources, output, source_files=[stored])
    rows = sinks.read_published(spark, output)
    counted = rows.groupBy(
        F.col("`provenance.source_uri`").alias("source_uri"), F.col("`geometry.recovery_status`").alias("recovery_status")
    ).agg(F.count(F.lit(1)).alias("n"))
    stale = files.withColumns({name: F.col(name) + 1 for name in ("messages", "invalid_pose", "missing_pose", "recoverable_invalid_pose")})
    stale = stale.where("intact_pose = 0")
    refused = _refusal(spark, lambda: jobs.run_release(messages, stale, sources, _folder(spark, "stale")))
    mixed, _ = _scanned_messages(spark, sf, clean_only=False)
    mixed_files = audit.file_audit(audit.topic_audit(audit.score_messages(mixed)))
    also = _refusal(spark, lambda: jobs.run_release(mixed, mixed_files, sources, _folder(spark, "mixed")))
    return _job_rows(counted, refused.unionByName(also))


@query
def job_augmentation(spark, sf):
    """The pose sidecar of a dataset folder through frame scan, job and verified read; refused on bad keys."""
    root = _folder(spark, "frames")
    frames = fixtures.frames(spark, sf).select(
        *C.FRAME_KEYS, *(F.col(alias).alias(name) for name, alias in C.FRAME_INPUT_COLUMNS.items())
    )
    frames.write.parquet(f"{root}/data")
    spark.range(1).write.parquet(f"{root}/meta")  # another schema, which must not be taken for frames
    output = _folder(spark, "augmented")
    jobs.run_augmentation(spark, [root], output)
    rows = sinks.read_published(spark, output)
    counted = rows.groupBy(F.col("`geometry.valid_mask`").cast("bigint").alias("valid_mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("index").alias("frames"),
        F.count_if(F.length("`provenance.source_sha256`") == 64).alias("hashed"),
    )
    broken = _folder(spark, "broken")
    frames.withColumn("frame_index", F.when(F.col("index") % 50 != 0, F.col("frame_index"))).write.parquet(broken)
    refusal = _refusal(spark, lambda: jobs.run_augmentation(spark, [broken], _folder(spark, "refused")))
    return _job_rows(counted, refusal)


@query
def job_corpus_audit(spark, sf):
    """The corpus audit through scan, job and committed read; refused on another inventory."""
    messages, _ = _scanned_messages(spark, sf, clean_only=False)
    listing, samples = fixtures.inventory(spark, sf), fixtures.samples(spark, sf)
    observed = listing.select("path", F.col("size").alias("size_bytes"), F.col("lfs_oid").alias("sha256"))
    inputs = (DATASET, REVISION, listing, samples, fixtures.channel_counts(spark, sf), observed, observed)
    output = _folder(spark, "audit")
    jobs.run_corpus_audit(messages, output, *inputs, uri_prefix="fx://")
    facts = sinks.read_audit(spark, output, "invariants").unionByName(sinks.read_audit(spark, output, "cross_check"))
    verdict = sinks.read_audit(spark, output, "corpus_audit").select(
        F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("passed")) for n in ("integrity_passed", "reconciled", "passed"))))
    )
    totals = sinks.read_audit(spark, output, "corpus_totals").select(
        F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in ("files", "bytes", "messages", "issues"))))
    )
    rows = facts.unionByName(verdict).unionByName(totals, allowMissingColumns=True)
    refusal = _refusal(
        spark,
        lambda: jobs.run_corpus_audit(
            messages, _folder(spark, "refused"), *inputs, uri_prefix="fx://", expected_fingerprint="0" * 64
        ),
    )
    return _job_rows(rows, refusal)


def _as_json_files(rows: DataFrame, path: str, wrap: str | None = None, files: int = 16) -> None:
    """Several JSON documents, each one list (or an object with that list under ``wrap``), a file each."""
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    listed = F.collect_list(F.struct(*rows.columns))
    document = F.to_json(listed if wrap is None else F.struct(listed.alias(wrap)))
    rows.groupBy(bucket.alias("bucket")).agg(document.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)


def _tree(listing: DataFrame) -> DataFrame:
    """An inventory as a tree listing has it, with an entry that is no episode file."""
    entries = listing.select(
        F.lit("file").alias("type"), "path", "size", "oid", F.struct(F.col("lfs_oid").alias("oid"), F.col("lfs_size").alias("size")).alias("lfs")
    )
    other = entries.limit(1).withColumn("path", F.lit("README.md"))
    return entries.unionByName(other)


@query
def job_audit_from_json(spark, sf):
    """The corpus audit from a raw tree listing and a samples file, with snapshots from before and after:
    clean, with a source that changed during the audit, and refused for a malformed entry and a bad tolerance."""
    messages, _ = _scanned_messages(spark, sf, clean_only=False)
    tree, broken, listed = _folder(spark, "tree"), _folder(spark, "tree"), _folder(spark, "samples")
    entries = fixtures.inventory(spark, sf)
    _as_json_files(_tree(entries), tree)
    _as_json_files(_tree(entries.withColumn("oid", F.when(episode_number("path") % 7 != 3, F.col("oid")).otherwise("xyz"))), broken)
    _as_json_files(fixtures.samples(spark, sf), listed, "samples")
    listing = inventory_source.normalise_inventory(inventory_source.read_inventory(spark, tree))
    samples = inventory_source.read_samples(spark, listed)
    before = entries.select("path", F.col("size").alias("size_bytes"), F.col("lfs_oid").alias("sha256"))
    changed = before.withColumn("sha256", F.when(episode_number("path") % 7 == 3, F.reverse("sha256")).otherwise(F.col("sha256")))
    channels = fixtures.channel_counts(spark, sf)
    found = None
    for variant, after in (("clean", before), ("changed", changed)):
        output = _folder(spark, "audit")
        jobs.run_corpus_audit(messages, output, DATASET, REVISION, listing, samples, channels, before, after, uri_prefix="fx://")
        facts = sinks.read_audit(spark, output, "invariants").unionByName(sinks.read_audit(spark, output, "cross_check"))
        row = sinks.read_audit(spark, output, "corpus_audit")
        named = F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("passed")) for n in ("integrity_passed", "passed")))
        rows = tag(facts.unionByName(row.select(F.inline(named))), variant)
        found = rows if found is None else found.unionByName(rows)

    def audit_of(entries_path: str, **options) -> None:
        malformed = inventory_source.normalise_inventory(inventory_source.read_inventory(spark, entries_path))
        jobs.run_corpus_audit(
            messages, _folder(spark, "refused"), DATASET, REVISION, malformed, samples, channels, before, before, uri_prefix="fx://", **options
        )

    refusal = _refusal(spark, lambda: audit_of(broken))
    bad = _refusal(spark, lambda: audit_of(tree, translation_tolerance_m=-1.0))
    return _job_rows(found, refusal.unionByName(bad))


@query
def job_recovery_from_lists(spark, sf):
    """Recovery of sources named by lists that go together by position; refused where one list is shorter."""
    messages, _ = _scanned_messages(spark, sf)
    rows = fixtures.source_table(spark, sf).where(is_clean()).orderBy("path").collect()  # lists, as a caller has them
    lists = {name: [r[name] for r in rows] for name in ("sha256", "size_bytes")}
    uris, paths = [r["source_uri"] for r in rows], [r["path"] for r in rows]
    episodes = [f"given_{i}" if i % 2 else None for i in range(len(rows))]
    sources = inventory.align_sources(spark, uris, paths, episode=episodes, expected_sha256=lists["sha256"], **lists)
    output = _folder(spark, "recovery")
    jobs.run_recovery(messages, sources, output)
    kept = sinks.read_beside(spark, output, "provenance")
    found = kept.select("source_uri", "identity_status", "episode_from", F.col("target_messages").alias("n"))
    short = _refusal(spark, lambda: inventory.align_sources(spark, uris, paths, sha256=lists["sha256"][1:]))
    return _job_rows(found, short)


@query
def job_augmentation_from_dataset(spark, sf):
    """Frames of two folders against a feature description, with the columns' own descriptions read back;
    refused on a description with other names, on a file without a vector and on one with strings in it."""
    frames = fixtures.frames(spark, sf).select(
        *C.FRAME_KEYS, *(F.col(alias).alias(name) for name, alias in C.FRAME_INPUT_COLUMNS.items())
    )
    roots = [_folder(spark, "frames") for _ in range(2)]
    for i, root in enumerate(roots):
        frames.where(F.col("index") % 2 == i).write.parquet(f"{root}/data")

    def describe(names: dict) -> str:
        features = {column: {"shape": [C.VECTOR_LENGTH], "names": list(own)} for column, own in names.items()}
        info = _folder(spark, "info")
        text = json.dumps({"codebase_version": "v3.0", "features": features})
        spark.createDataFrame([(text,)], "value string").write.text(info)
        return info

    output = _folder(spark, "augmented")
    manifest = jobs.run_augmentation(spark, roots, output, info_path=describe(C.FEATURE_NAMES))
    rows = sinks.read_published(spark, output)
    layouts = [f.metadata.get("layout") == json.dumps(C.POSE_LAYOUT) for f in rows.schema if f.name.endswith("arm_local")]
    contract = json.loads(manifest["details"])["feature_contract"]["status"]
    counted = rows.groupBy(F.col("`geometry.valid_mask`").cast("bigint").alias("valid_mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(contract).alias("contract"),
        F.lit(all(layouts) and len(layouts) == len(C.LIMBS)).alias("described"),
    )
    swapped = {column: tuple(reversed(names)) for column, names in C.FEATURE_NAMES.items()}
    refused = _refusal(spark, lambda: jobs.run_augmentation(spark, roots, _folder(spark, "refused"), info_path=describe(swapped)))
    for change in ({"drop": "action"}, {"text": "observation.state"}):
        odd = frames.where(F.col("index") % 10 == 3)
        odd = odd.drop("action") if "drop" in change else odd.withColumn(change["text"], F.col(f"`{change['text']}`").cast("array<string>"))
        root = _folder(spark, "frames")
        frames.where(F.col("index") % 10 != 3).write.parquet(f"{root}/data/good")
        odd.write.parquet(f"{root}/data/odd")
        refused = refused.unionByName(_refusal(spark, lambda at=root: jobs.run_augmentation(spark, [at], _folder(spark, "refused"))))
    return _job_rows(counted, refused)


@query
def frame_faults_by_file(spark, sf):
    """Rows of a folder's files by what their own footers lack: most are sound, some have no ``action``, some
    hold text, some have a fractional key."""
    frames = fixtures.frames(spark, sf).select(
        *C.FRAME_KEYS, *(F.col(alias).alias(name) for name, alias in C.FRAME_INPUT_COLUMNS.items())
    )
    root, kind = _folder(spark, "frames"), F.col("index") % 8
    frames.where(kind < 5).write.parquet(f"{root}/sound")
    frames.where(kind == 5).drop("action").write.parquet(f"{root}/bare")
    frames.where(kind == 6).withColumn("action", F.col("action").cast("array<string>")).write.parquet(f"{root}/text")
    frames.where(kind == 7).withColumn("index", F.col("index").cast("double")).write.parquet(f"{root}/fraction")
    faults = frame_source.frame_file_faults(spark, root)
    return faults.groupBy("fault").agg(F.sum("rows").alias("rows"))


@query
def file_skipping(spark, sf):
    """Messages of each topic, and of one half of the time, from the files that hold any: rows found, files that
    were opened in vain, and whether any was left closed. The last files are indexed in a second run."""
    folder, index = _folder(spark, "messages"), _folder(spark, "index")
    messages = fixtures.arm_messages(spark, sf, clean_only=True)
    stays = F.col("sequence") % 10 != 0
    for part in (messages.where(stays), messages.where(~stays)):
        part.repartitionByRange(8, "topic", "log_time_ns").write.mode("append").parquet(folder)
        skipping.index_files(spark, folder, index)
    files = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file")).distinct().count()
    times = messages.agg(F.min("log_time_ns").alias("low"), F.max("log_time_ns").alias("high")).first()
    middle = (int(times["low"]) + int(times["high"])) // 2
    found = None
    for topic in C.ARM_TOPICS:
        for half, options in (("all", {}), ("first", {"until_ns": middle}), ("second", {"since_ns": middle})):
            rows = skipping.read_needed(spark, folder, index, (topic,), **options)
            opened = len(rows.inputFiles())
            named = rows.select(F.input_file_name().alias("file"))
            useful = named.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))
            line = useful.select(
                F.lit(topic).alias("topic"), F.lit(half).alias("half"), "n", (F.lit(opened) - F.col("files")).alias("in_vain"),
                F.lit(opened < files).alias("some_stay_closed"),
            )
            found = line if found is None else found.unionByName(line)
    return found


@query
def audit_of_record_files(spark, sf):
    """The file audit over raw record files: undecodable messages are records whose payload does not check out."""
    folder = _folder(spark, "records")
    records.write_records(fixtures.arm_messages(spark, sf), folder)
    messages = records.read_records(spark, folder, split_bytes=1 << 20)
    return audit.file_audit(audit.topic_audit(audit.score_messages(messages)))
