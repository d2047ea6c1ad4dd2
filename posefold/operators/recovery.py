"""One repaired row per target message: classes, masks, provenance and the arm-local pose."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from posefold import contracts as C
from posefold.functions import classify as K
from posefold.functions import text as X
from posefold.functions.kinematics import ChainKinematics, ChainModel, joint_limit_flags
from posefold.functions.rotation import pose_vector
from posefold.operators.audit import with_topic_roles
from posefold.operators.scale import lookup_join, ordinal_within
from posefold.sources.store import LAYOUT, SLAB

READER_ORDER = ("log_time_ns", "topic", "sequence")
STATUSES = ("pose_status", "joint_status", "fk_status", "recovery_status")
# The words of each status.
STATUS_WORDS = {
    "pose_status": C.POSE_STATES,
    "joint_status": C.POSE_STATES,
    "fk_status": ("derived", "failure", "not_attempted_invalid_joints"),
    "recovery_status": (
        "source_pose_intact", "recovered", "source_pose_intact_fk_failure", "unrecoverable_fk_failure",
        "source_pose_intact_invalid_joints", "unrecoverable_invalid_joints",
    ),
}


def target_messages(messages: DataFrame) -> DataFrame:
    """Decodable rows on the four target topics, with ``arm`` and ``stream``."""
    return with_topic_roles(messages).where(F.col("role") == "target").drop("role")


def with_ordinals(targets: DataFrame, stored: bool | None = None) -> DataFrame:
    """Fill ``message_ordinal``: 0-based per source over target topics.

    Ordinals stored at ingestion are kept and cost nothing. Otherwise rows are numbered by log time,
    topic and sequence. ``stored`` says which, if the caller knows.
    """
    if stored is None:
        stored = targets.where(F.col("message_ordinal").isNull()).limit(1).count() == 0
    if stored:
        return targets
    rows = targets.drop("message_ordinal")
    return ordinal_within(rows, ["source_uri"], list(READER_ORDER), "message_ordinal")


def with_statuses(targets: DataFrame, kinematics=None, limits: ChainModel | None = None) -> DataFrame:
    """Add the four statuses, the mask, ``recovered`` and ``fk_x .. fk_qz``.

    ``limits`` names a model whose declared joint ranges are held: joints outside count as malformed,
    so no pose is derived from them.
    """
    kinematics = kinematics or ChainKinematics()
    if kinematics.frame != "arm_local":
        raise ValueError("recovery emits arm-local poses only; the adapter reports another frame")
    base = [c for c in targets.columns if c not in ("pose", "position")]
    rows = K.pose_status_only(targets)
    rows = K.with_joint_status(rows, "q").drop("pose", "position")
    joints = [f"q{i}" for i in range(C.JOINT_COUNT)]
    if limits is not None:
        inside = reduce(Column.__and__, joint_limit_flags(joints, limits))
        intact = F.col("joint_status") == "intact"
        rows = rows.withColumn("joint_status", F.when(intact & ~inside, "malformed").otherwise(F.col("joint_status")))
    rows = kinematics.attach_vector(rows, joints, "fk_", "joint_status = 'intact'", "arm").drop(*joints)
    rows = rows.withColumn("fk_status", K.fk_status())
    return rows.select(
        *base,
        "pose_status",
        "joint_status",
        "fk_status",
        K.recovery_status().alias("recovery_status"),
        K.recovery_mask().alias("status_mask"),
        F.expr("pose_status <> 'intact' AND fk_status = 'derived'").alias("recovered"),
        *(f"fk_{name}" for name in ("x", "y", "z", "qw", "qx", "qy", "qz")),
    )


def recovery_rows(
    messages: DataFrame,
    sources: DataFrame,
    kinematics=None,
    numbered: DataFrame | None = None,
    ordered: bool = False,
    limits: ChainModel | None = None,
) -> DataFrame:
    """The recovery table under internal names.

    ``sources`` has one row per file: ``source_uri, source_sha256, task, episode``. Where FK was
    refused the pose is seven NaNs, never null; statuses and mask are authoritative. With ``ordered``
    the rows lie in sidecar order, by source and ordinal, however the lookups were made: they are put
    in order after the last of them, and the derivation that follows is row by row. So is FK, which no
    shuffle and no sampling of one repeats.
    """
    targets = numbered if numbered is not None else with_ordinals(target_messages(messages))
    rows = lookup_join(
        targets, sources.select("source_uri", "source_sha256", "task", "episode"), ["source_uri"]
    )
    if ordered:
        order = ("source_uri", "message_ordinal")
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return _derived(rows, kinematics, limits)


def recovery_rows_in_place(stored: DataFrame, sources: DataFrame, kinematics=None, limits: ChainModel | None = None) -> DataFrame:
    """The recovery table over a store (``sources.store``): only narrow lines are shuffled, no pose or position.

    Each source and slab is counted where it lies; running sums of those counts give every slab its first
    ordinal, and the provenance of its source rides along. The two meet the payload in its buckets, which are
    sorted in reader order, so every written file is in sidecar order. Rows that tie are numbered as they lie; rows
    without a source get no ordinal.
    """
    targets = target_messages(stored.drop("message_ordinal"))
    counts = targets.groupBy(*LAYOUT).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("source_uri").orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    # One line per source and slab: the window never sees more lines of a source than it has slabs.
    starts = counts.select(*LAYOUT, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    known = sources.select("source_uri", "source_sha256", "task", "episode")
    starts = starts.join(known, "source_uri", "left")
    place = F.row_number().over(Window.partitionBy(*LAYOUT).orderBy(*READER_ORDER))
    rows = targets.withColumn("_place", place).join(starts, list(LAYOUT), "left")
    rows = rows.withColumn("message_ordinal", (F.col("_start") + F.col("_place") - 1).cast("bigint"))
    return _derived(rows.drop("_start", "_place", SLAB), kinematics, limits)


def _derived(rows: DataFrame, kinematics, limits: ChainModel | None) -> DataFrame:
    """Statuses, mask and pose of numbered rows with provenance, under internal names."""
    rows = with_statuses(rows, kinematics, limits)
    nothing = F.array(*(F.lit(float("nan")) for _ in C.POSE_LAYOUT))
    pose = F.when(F.col("fk_status") == "derived", pose_vector("fk_")).otherwise(nothing)
    rows = rows.withColumn("pose_arm_local", pose)
    return rows.select(
        *(
            F.col(name).cast(C.RECOVERY_TYPES[name]).alias(name) if name in C.RECOVERY_TYPES else name
            for name in C.RECOVERY_COLUMNS
        )
    )


def status_histogram(rows: DataFrame) -> DataFrame:
    """Counts of every status value per source and in total (``source_uri`` null), in long form.

    The four status columns are grouped together first; unpivoting happens on those few groups.
    """
    grouped = rows.groupBy("source_uri", *STATUSES).agg(F.count(F.lit(1)).alias("n"))
    long = grouped.select(
        "source_uri",
        "n",
        F.explode(
            F.array(*(F.struct(F.lit(s).alias("field"), F.col(s).alias("status")) for s in STATUSES))
        ).alias("e"),
    ).select("source_uri", "e.field", "e.status", "n")
    return long.groupingSets(
        [["field", "status", "source_uri"], ["field", "status"]], "field", "status", "source_uri"
    ).agg(F.sum("n").alias("n"))


def status_measures(names: Mapping[str, str]) -> dict[str, Column]:
    """Counts of every status word, as ``field|word`` aggregates to observe; ``names`` gives the columns' names."""
    return {
        f"{field}|{word}": F.count_if(F.col(f"`{names[field]}`") == word)
        for field, words in STATUS_WORDS.items()
        for word in words
    }


def measured_counts(measured: Mapping[str, int]) -> list[tuple[str, str, int]]:
    """``field, status, n`` of the words that occur, from observed :func:`status_measures`."""
    found = ((*name.split("|"), n) for name, n in measured.items() if "|" in name)
    return [(field, word, n) for field, word, n in found if n]


def message_facts(messages: DataFrame) -> DataFrame:
    """Everything a run must know about each source before deriving: one narrow pass, no payload read.

    Target rows, undecodable and unusable rows, target rows without a stored ordinal, and target rows
    whose times or sequence are absent or outside their unsigned range.
    """
    rows = with_topic_roles(messages)

    def target(condition: Column) -> Column:
        return F.count_if((F.col("role") == "target") & condition)

    def bad(name: str, top: int) -> Column:
        limit = F.lit(str(top)).cast("decimal(20,0)")
        inside = F.col(name).cast("decimal(20,0)").between(F.lit(0), limit)
        return target(~F.coalesce(inside, F.lit(False))).alias(f"bad_{name}")

    return rows.groupBy("source_uri").agg(
        target(F.lit(True)).alias("rows"),
        F.count_if(F.col("role") == "decode_error").alias("decode_errors"),
        F.count_if(F.col("role") == "record_error").alias("record_errors"),
        target(F.col("message_ordinal").isNull()).alias("unnumbered"),
        bad("log_time_ns", C.UINT64_MAX),
        bad("publish_time_ns", C.UINT64_MAX),
        bad("sequence", C.UINT32_MAX),
    )


def resolve_sources(
    sources: DataFrame, sessions: DataFrame | None = None
) -> DataFrame:
    """Resolve task and episode of each source file.

    ``sources`` has ``source_uri, path`` and optional ``task, episode``. Task: supplied, else from the
    path. Episode: supplied, else the session uuid, else the path. ``conflict`` marks several session
    uuids where no episode was supplied; such a run must be refused.
    """
    rows = sources
    for name in ("task", "episode"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    rows = rows.withColumnsRenamed({"task": "given_task", "episode": "given_episode"})
    if sessions is None:
        rows = rows.withColumn("session_uuid", F.lit(None).cast("string")).withColumn(
            "conflicting", F.lit(None).cast("boolean")
        )
    else:
        rows = rows.join(sessions, "source_uri", "left")
    given = X.blank_to_null("given_episode")
    return rows.select(
        *(
            c
            for c in rows.columns
            if c not in ("given_task", "given_episode", "session_uuid", "conflicting", "copies", "conflict")
        ),
        F.coalesce(X.blank_to_null("given_task"), X.task_from_path("path")).alias("task"),
        F.coalesce(given, X.episode_from_session("session_uuid"), X.episode_from_path("path")).alias("episode"),
        F.when(given.isNotNull(), "supplied")
        .when(F.col("session_uuid").isNotNull(), "session")
        .otherwise("path")
        .alias("episode_from"),
        (given.isNull() & F.coalesce("conflicting", F.lit(False))).alias("conflict"),
        (X.is_blank_value("given_task") | X.is_blank_value("given_episode")).alias("blank_identity"),
    )
