"""The jobs: corpus audit, raw recovery (and its release form) and frame augmentation.

Each job checks parameters and identities first, does its heavy pass once, verifies what it wrote and
publishes a manifest last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions.kinematics import ChainKinematics, ChainModel
from posefold.operators import audit, augment, cohorts, corpus, gates, identities, inventory, reconcile, recovery
from posefold.operators.scale import cut_lineage, tidy
from posefold.sources import frames as frame_source
from posefold.sources import sinks, store
from posefold.sources.files import file_fingerprints


AUDIT_TABLES = (
    "topic_audit", "file_audit", "issues", "cohorts", "cohort_tasks", "corpus_rollup", "corpus_totals",
    "conclusion_facts", "inventory_facts", "sample_matches", "invariants", "cross_check", "corpus_audit",
)


def run_corpus_audit(
    messages: DataFrame,
    output: str,
    dataset_id: str,
    revision: str,
    listing: DataFrame,
    samples: DataFrame,
    channels: DataFrame,
    observed: DataFrame,
    observed_after: DataFrame,
    expected_files: int | None = None,
    expected_fingerprint: str | None = None,
    samples_oid: tuple[str, str] | None = None,
    issue_limit: int = C.ISSUE_SAMPLE_LIMIT,
    uri_prefix: str = "",
    **options,
) -> dict[str, DataFrame]:
    """Audit a corpus and write the tables of ``AUDIT_TABLES`` under ``output``, all of them or none.

    ``listing`` (path, size, lfs_oid ...), ``samples``, ``channels`` (path, topic, n) and both snapshots
    ``observed`` and ``observed_after`` (path, size_bytes, sha256, from before and after the audit) have
    one row per file or channel; ``uri_prefix`` turns a path into its source URI. The inventory gates
    come first: distinct, well-formed entries, a sample for each and no other, and, where given, the
    expected count, the pinned fingerprint and the samples file's ``(expected, found)`` object id. Only
    the topic audit reads messages in full (once more for the issue sample and for the independent
    profile); every later table starts from the small stored one.
    """
    spark = messages.sparkSession
    audit.check_tolerances(
        options.get("translation_tolerance_m", C.TRANSLATION_TOLERANCE_M),
        options.get("rotation_tolerance_deg", C.ROTATION_TOLERANCE_DEG),
        issue_limit,
    )
    run = sinks.AuditRun(spark, output)
    entries = listing if "entry_ok" in listing.columns else listing.withColumn("entry_ok", F.lit(True))
    facts = inventory.inventory_gate_facts(entries)
    if expected_fingerprint is not None:
        found = inventory.inventory_fingerprint(listing).select("fingerprint")
        facts = facts.join(F.broadcast(found))  # one row each
    run.write({"inventory_facts": facts, "sample_matches": inventory.match_samples(listing, samples)})
    gates.require(
        inventory_gates(run.read("inventory_facts"), run.read("sample_matches"), expected_files, expected_fingerprint, samples_oid)
    )

    scored = audit.score_messages(messages, **options)
    run.write({"topic_audit": audit.topic_audit(scored)})
    topics = run.read("topic_audit")
    run.write({"file_audit": audit.file_audit(topics)})
    files = run.read("file_audit")

    detailed = audit.score_messages(messages, details=True, keep=("sequence",), **options)
    issue_rows = audit.issue_sample(audit.issues(detailed), files, issue_limit)
    by_uri = lambda df, path="path": df.withColumn("source_uri", F.concat(F.lit(uri_prefix), F.col(path)))
    listed, sampled, declared = by_uri(listing), by_uri(samples, "filepath"), by_uri(channels)
    assigned = cohorts.assign_cohorts(cohorts.observed_right_offsets(topics)).join(
        sampled.select("source_uri", "task"), "source_uri", "left"
    )
    run.write({"cohorts": cohorts.rig_cohorts(assigned)})
    evidence = corpus_evidence(files, topics, listed, sampled, declared, observed, observed_after)
    # Without a pinned count, each listed file must have been audited.
    expected = expected_files if expected_files is not None else listing.count()
    digests = by_uri(listing).join(observed, "path", "left").select(
        "source_uri", F.col("lfs_oid").alias("primary_sha256"), "sha256"
    )
    run.write(
        {
            "issues": issue_rows,
            "cohort_tasks": cohorts.cohort_tasks(assigned),
            "corpus_rollup": corpus.corpus_rollup(topics),
            "corpus_totals": corpus.corpus_totals(
                files,
                listed.withColumnRenamed("size", "size_bytes"),
                sampled,
                by_uri(inventory.channel_summary(channels)),
            ),
            "conclusion_facts": corpus.conclusion_facts(files, run.read("cohorts")),
            "invariants": corpus.corpus_invariants(evidence, expected, uri_prefix),
            "cross_check": reconcile.cross_check(reconcile.field_profile(messages), files, digests),
        }
    )
    run.write(
        {
            "corpus_audit": corpus.corpus_audit_row(
                files, run.read("invariants"), run.read("cross_check"), dataset_id, revision
            )
        }
    )
    run.commit()
    return {name: sinks.read_audit(spark, output, name) for name in AUDIT_TABLES}


def inventory_gates(
    facts: DataFrame,
    matches: DataFrame,
    expected_files: int | None = None,
    expected_fingerprint: str | None = None,
    samples_oid: tuple[str, str] | None = None,
) -> DataFrame:
    """Gate rows of an inventory: its facts, its samples and what was pinned."""
    unmatched = ~F.coalesce(F.col("path_ok") & (F.col("status") == "matched"), F.lit(False))
    found = [
        gates.no_rows_where(facts, "inventory_paths_are_distinct", F.col("duplicate_paths") > 0),
        gates.no_rows_where(facts, "inventory_entries_are_well_formed", F.col("refused_entries") > 0),
        gates.no_rows_where(matches, "every_file_has_its_sample", unmatched),
    ]
    if expected_files is not None:
        found.append(gates.no_rows_where(facts, "inventory_count_is_pinned", F.col("entries") != expected_files))
    if expected_fingerprint is not None:
        differs = ~F.coalesce(F.col("fingerprint") == expected_fingerprint, F.lit(False))
        found.append(gates.no_rows_where(facts, "inventory_fingerprint_is_pinned", differs))
    if samples_oid is not None:
        found.append(gates.no_rows_where(facts, "samples_oid_is_pinned", F.lit(samples_oid[0] != samples_oid[1])))
    return gates.all_gates(*found)


def corpus_evidence(
    files: DataFrame,
    topics: DataFrame,
    listing: DataFrame,
    samples: DataFrame,
    channels: DataFrame,
    observed: DataFrame,
    observed_after: DataFrame,
    keep: list[str] = (),
) -> DataFrame:
    """One evidence row per file that is listed, audited or both, ready for the corpus invariants.

    ``listing``, ``samples`` and ``channels`` carry ``source_uri``; the audit's own URIs come from
    ``files``. ``keep`` names extra grouping columns present in every input.
    """
    keep = list(keep)
    key = [*keep, "source_uri"]
    checked = inventory.file_identity(listing.select(*keep, "path", "size", "lfs_oid"), observed, keep)
    still = inventory.unchanged(observed, observed_after, keep)
    listed = (
        listing.select(*key, "path")
        .join(checked, [*keep, "path"], "left")
        .join(still, [*keep, "path"], "left")
        .withColumn("listed", F.lit(True))
    )
    plot = F.endswith("topic", F.lit(C.PLOT_SUFFIX))
    summaries = channels.groupBy(*key).agg(
        F.sum("n").alias("all_messages"),
        F.coalesce(F.sum(F.when(plot, F.col("n"))), F.lit(0)).alias("plot_messages"),
    )
    declared = channels.where(F.col("topic").isin(*C.ARM_TOPICS)).groupBy(*key, "topic").agg(
        F.sum("n").alias("declared")
    )
    counts = (
        topics.select(*key, "topic", "messages")
        .join(declared, [*key, "topic"], "full_outer")
        .groupBy(*key)
        .agg(F.every(F.coalesce("messages", F.lit(0)) == F.coalesce("declared", F.lit(0))).alias("counts_match"))
    )
    both = files.withColumn("audited", F.lit(True)).join(listed, key, "full_outer")
    return (
        both.withColumns({name: F.coalesce(name, F.lit(False)) for name in ("listed", "audited")})
        .join(samples.select(*key, "n_messages"), key, "left")
        .join(summaries, key, "left")
        .join(counts, key, "left")
    )


def run_recovery(
    messages: DataFrame,
    sources: DataFrame,
    output: str,
    kinematics=None,
    sessions: DataFrame | None = None,
    require_recovery_only: bool = False,
    dataset_id: str | None = None,
    revision: str | None = None,
    source_files: list[str] = (),
    overwrite: bool = False,
    audited: DataFrame | None = None,
    limits: ChainModel | None = None,
    per_source_counts: bool = True,
    require_untangled: bool = False,
) -> dict:
    """Write the keyed recovery sidecar.

    ``messages`` from ``sources.store`` are numbered and derived in their buckets, without a shuffle of the
    payload; each file written is then in order of source and ordinal. Others are put in that order by a range
    shuffle. ``sources`` has one row per file: ``source_uri, path, sha256, size_bytes`` (observed) and optional
    ``task, episode, expected_sha256, expected_size_bytes``. ``source_files`` are the Parquet files or
    folders behind ``messages``; they are fingerprinted before and after. ``audited`` (``source_uri,
    messages``) holds every source to the rows an audit counted in it. ``limits`` names a model outside
    whose declared joint ranges no pose is derived. Total status counts are observed by the write; with
    ``per_source_counts`` the source and status columns, and they alone, are read back for those of each source.
    With ``require_untangled`` paths and URIs that are used twice refuse the run by whole groups.
    """
    spark = messages.sparkSession
    with tidy(spark):
        return _recover(
            spark, messages, sources, output, kinematics, sessions, require_recovery_only, dataset_id, revision,
            source_files, overwrite, audited, limits, per_source_counts, require_untangled,
        )


def _recover(
    spark, messages, sources, output, kinematics, sessions, require_recovery_only, dataset_id, revision,
    source_files, overwrite, audited, limits, per_source_counts, require_untangled,
) -> dict:
    kinematics = kinematics or ChainKinematics()
    sinks.check_output(output, list(source_files))
    for name in ("expected_sha256", "expected_size_bytes"):
        if name not in sources.columns:
            kind = "string" if name == "expected_sha256" else "bigint"
            sources = sources.withColumn(name, F.lit(None).cast(kind))
    unique = inventory.deduplicate_sources(sources)
    resolved = recovery.resolve_sources(unique, sessions)
    identity = inventory.source_identity(
        unique.select("source_uri", "expected_sha256", "expected_size_bytes"), unique
    )
    if require_untangled:
        identities.require_untangled(sources)
    facts = cut_lineage(recovery.message_facts(messages), "facts")
    strangers = facts.join(unique.select("source_uri"), "source_uri", "left_anti")
    promised = audited if audited is not None else facts.select("source_uri", F.col("rows").alias("messages"))
    counted = facts.select("source_uri", "rows").join(promised, "source_uri", "full_outer")
    gates.require(
        gates.all_gates(
            gates.no_rows_where(
                counted, "rows_are_as_audited", ~F.coalesce(F.col("rows") == F.col("messages"), F.lit(False))
            ),
            gates.no_rows_where(unique, "source_identity_is_unique", F.col("conflict")),
            gates.no_rows_where(inventory.reused_uris(unique), "source_uri_is_unique", F.lit(True)),
            gates.no_rows_where(identity, "expected_identity_holds", F.col("status") == "mismatch"),
            gates.no_rows_where(resolved, "one_session_per_source", F.col("conflict")),
            gates.no_rows_where(resolved, "identity_is_not_blank", F.col("blank_identity")),
            gates.no_rows_where(strangers, "every_source_is_listed", F.lit(True)),
            gates.no_rows_where(facts, "no_decode_error", F.expr("decode_errors + record_errors > 0")),
            gates.no_rows_where(
                facts, "envelope_in_range", F.expr("bad_log_time_ns + bad_publish_time_ns + bad_sequence > 0")
            ),
        )
    )
    before = file_fingerprints(spark, *source_files, glob="*.parquet") if source_files else None
    if before is not None:
        before = cut_lineage(before, "fingerprints")

    totals = facts.agg(F.sum("rows").alias("rows"), F.sum("unnumbered").alias("unnumbered")).first()
    expected, stored = totals["rows"] or 0, totals["unnumbered"] == 0
    table = resolved.withColumn("source_sha256", F.col("sha256"))
    if store.is_store(messages):
        rows = recovery.recovery_rows_in_place(messages, table, kinematics, limits)
    else:
        numbered = recovery.with_ordinals(recovery.target_messages(messages), stored)
        rows = recovery.recovery_rows(messages, table, kinematics, numbered, ordered=True, limits=limits)
    published = sinks.describe_columns(rows, C.RECOVERY_COLUMNS, sinks.model_facts(kinematics))

    pose, status = "`geometry.pose.arm_local`", C.RECOVERY_COLUMNS["recovery_status"]
    measures = {
        **recovery.status_measures(C.RECOVERY_COLUMNS),
        "poses_of_another_length": F.count_if(~F.expr(f"{pose} IS NOT NULL AND size({pose}) = 7")),
        "not_recovered": F.count_if(~F.coalesce(F.col(f"`{status}`") == "recovered", F.lit(False))),
    }

    def checks(measured: dict) -> list[str]:
        failed = []
        if measured["poses_of_another_length"]:
            failed.append(f"pose_has_seven_values: {measured['poses_of_another_length']} violations")
        if require_recovery_only and measured["not_recovered"]:
            failed.append(f"every_row_recovered: {measured['not_recovered']} violations")
        for field, words in recovery.STATUS_WORDS.items():
            if sum(measured[f"{field}|{word}"] for word in words) != expected:
                failed.append(f"every_{field}_is_known: other words occur")
        return failed

    def tables(measured: dict, staged: DataFrame) -> dict[str, DataFrame]:
        counts = spark.createDataFrame(recovery.measured_counts(measured), "field string, status string, n bigint")
        counts = counts.withColumn("source_uri", F.lit(None).cast("string"))
        if per_source_counts:
            narrow = staged.select(
                *(F.col(f"`{C.RECOVERY_COLUMNS[name]}`").alias(name) for name in ("source_uri", *recovery.STATUSES))
            )
            each = recovery.status_histogram(narrow).where("source_uri IS NOT NULL")
            counts = counts.unionByName(each)
        identities = resolved.join(identity.select("source_uri", "status"), "source_uri", "left")
        provenance = identities.withColumnRenamed("status", "identity_status").join(
            facts.select("source_uri", F.col("rows").alias("target_messages")), "source_uri", "left"
        )
        return {"status_counts": counts, "provenance": provenance}

    def sources_unchanged() -> None:
        if before is not None:
            after = file_fingerprints(spark, *source_files, glob="*.parquet")
            gates.require(
                gates.no_rows_where(inventory.unchanged(before, after), "sources_unchanged", ~F.col("unchanged"))
            )

    details = {
        "dataset_id": dataset_id,
        "dataset_revision": revision,
        **sinks.model_facts(kinematics),
        "frame": "arm_local",
        "pose_layout": list(C.POSE_LAYOUT),
        "status_mask_bits": dict(C.RECOVERY_BITS),
        "invalid_pose_encoding": "seven NaN values; statuses and mask are authoritative",
        "shared_bimanual_transform_emitted": False,
        "source_modified": False,
        "require_recovery_only": require_recovery_only,
    }
    return sinks.publish(
        published, output, C.RECOVERY_SCHEMA_VERSION, expected, details, overwrite, measures, checks, tables, sources_unchanged
    )


def run_release(
    messages: DataFrame, files: DataFrame, sources: DataFrame, output: str, **options
) -> dict:
    """Recover exactly the fully missing, fully recoverable files of an audit; refuse a mixed corpus.

    The audit says how many rows each file has and that each is recovered; a corpus that has changed
    since is refused.
    """
    with tidy(messages.sparkSession):
        # Counted once: the gate, the choice and what recovery is held to would each audit all messages again.
        facts = cut_lineage(gates.release_facts(files), "release")
        gates.require(gates.release_gate(facts))
        chosen = gates.select_release(messages, facts)
        promised = facts.where("decision = 'selected'").select("source_uri", "messages")
        return run_recovery(chosen, sources, output, require_recovery_only=True, audited=promised, **options)


def run_augmentation(
    spark: SparkSession,
    inputs: list[str],
    output: str,
    kinematics=None,
    info_path: str | None = None,
    info_uri: str | None = None,
    dataset_id: str | None = None,
    revision: str | None = None,
    hash_sources: bool = True,
    overwrite: bool = False,
) -> dict:
    """Write the pose sidecar of one or more frame tables. One map stage from scan to sink."""
    with tidy(spark):
        return _augment(
            spark, inputs, output, kinematics, info_path, info_uri, dataset_id, revision, hash_sources, overwrite
        )


def _augment(
    spark, inputs, output, kinematics, info_path, info_uri, dataset_id, revision, hash_sources, overwrite
) -> dict:
    kinematics = kinematics or ChainKinematics()
    contract = frame_source.feature_contract(spark, info_path, info_uri)
    sinks.check_output(output, list(inputs))
    rows = frame_source.read_frames(spark, *inputs)
    facts = cut_lineage(augment.key_violations(rows), "facts")
    gates.require(
        gates.no_rows_where(
            facts,
            "frame_keys_are_valid",
            F.expr("null_episode_index + null_frame_index + null_index + bad_timestamp > 0"),
        )
    )
    before = None
    if hash_sources:
        roots = [frame_source.dataset_root(spark, p) if not p.endswith(".parquet") else p for p in inputs]
        before = cut_lineage(file_fingerprints(spark, *roots, glob="*.parquet"), "fingerprints")
    sources = None
    if before is not None:
        sources = before.select(_same_uri("path").alias("source_uri"), F.col("sha256").alias("source_sha256"))
    expected = facts.agg(F.sum("rows")).first()[0] or 0
    derived = augment.augment_frames(rows.withColumn("source_uri", _same_uri("source_uri")), sources, kinematics)
    published = sinks.describe_columns(derived, C.SIDECAR_COLUMNS, sinks.model_facts(kinematics))

    def unchanged() -> None:
        if before is not None:
            after = file_fingerprints(spark, *roots, glob="*.parquet")
            gates.require(
                gates.no_rows_where(inventory.unchanged(before, after), "sources_unchanged", ~F.col("unchanged"))
            )

    details = {
        "dataset_id": dataset_id,
        "dataset_revision": revision,
        "feature_contract": contract,
        **sinks.model_facts(kinematics),
        "pose_layout": list(C.POSE_LAYOUT),
        "mask_bits": dict(C.LIMB_BITS),
        "source_vector_layout": {
            limb.name: {"column": limb.vector, "indices": list(range(limb.start, limb.start + 6)), "units": "radians"}
            for limb in C.LIMBS
        },
        "excluded_frames": {"shared_bimanual": "not emitted: the right base is not cohort-verified"},
        "source_modified": False,
    }
    measures = augment.mask_measures({name: C.SIDECAR_COLUMNS[column] for name, column in augment.MASKS.items()})

    def tables(measured: dict, staged: DataFrame) -> dict[str, DataFrame]:
        counts = spark.createDataFrame(
            augment.measured_masks(measured), "limb string, valid bigint, invalid_input bigint, derivation_failure bigint"
        )
        provenance = facts.select(_same_uri("source_uri").alias("source_uri"), "rows")
        if sources is not None:
            provenance = provenance.join(sources, "source_uri", "left")
        return {"mask_counts": counts, "provenance": provenance}

    return sinks.publish(
        published, output, C.SIDECAR_SCHEMA_VERSION, expected, details, overwrite, measures, None, tables, unchanged
    )


def _same_uri(column: str):
    """Spark reports local files as ``file:/x`` in one place and ``file:///x`` in another."""
    return F.regexp_replace(F.col(column), "^file:/+", "file:///")
