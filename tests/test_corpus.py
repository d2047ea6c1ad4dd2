import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from build import JOINTS, message, messages, recorded
from posefold import contracts as C
from posefold.functions import text as X
from posefold.operators import audit, gates, inventory, reconcile
from posefold.plans import jobs
from posefold.sources import files as source_files
from posefold.sources import sinks
from posefold.sources.inventory import normalise_inventory, read_inventory, read_inventory_tsv, read_samples
from posefold.sources.messages import normalise_messages, read_arm_messages, session_episodes


def path_of(n):
    return f"data/val/task_{n}/episode_{n}/episode.fo.mcap"


def entry(n, **changes):
    digest = hashlib.sha256(path_of(n).encode()).hexdigest()
    return {"type": "file", "path": path_of(n), "size": 10 + n, "oid": "a" * 40, "lfs": {"oid": digest, "size": 10 + n}} | changes


def write_json(path, value):
    path.write_text(json.dumps(value))
    return str(path)


@pytest.mark.parametrize("path, ok", [
    (path_of(1), True), ("data/val/t/episode_/episode.fo.mcap", True), ("/" + path_of(1), False),
    ("data/val/../episode_1/episode.fo.mcap", False), ("data/train/t/episode_1/episode.fo.mcap", False),
    ("data/val/t/ep_1/episode.fo.mcap", False), ("data/val/t/episode_1/x.mcap", False),
    ("data/val//episode_1/episode.fo.mcap", False), ("data/val/t/u/episode_1/episode.fo.mcap", False), (None, False),
])
def test_path_contract(spark, path, ok):
    assert spark.createDataFrame([(path,)], "p string").select(X.is_episode_path("p")).first()[0] is ok


@pytest.mark.parametrize("path, task, episode", [
    ("/d/pour/episode_7/episode.fo.mcap", "pour", "episode_7"), ("/d/pour/run.fo.mcap", "pour", "run"), ("/d/pour/run.mcap", "pour", "run"),
])
def test_task_and_episode_from_path(spark, path, task, episode):
    row = spark.createDataFrame([(path,)], "p string").select(X.task_from_path("p"), X.episode_from_path("p")).first()
    assert tuple(row) == (task, episode)


def test_hex_and_rounding(spark):
    df = spark.createDataFrame([("sha256:" + "A" * 64, -0.004, -0.805), ("a" * 63, 0.125, -0.61)], "h string, x double, y double")
    rows = df.select(X.hex_digest("h", 64).alias("h"), X.cohort_coordinate("x").alias("x"), X.cohort_coordinate("y").alias("y")).collect()
    assert rows[0]["h"] == "a" * 64 and rows[1]["h"] is None
    assert str(rows[0]["x"]) == "0.0" and rows[1]["x"] == 0.12 and rows[1]["y"] == -0.61


def test_git_oid_and_fingerprints(spark, tmp_path):
    small, large = tmp_path / "small.bin", tmp_path / "large.bin"
    small.write_bytes(b"hello\n")
    large.write_bytes(b"x" * 5000)
    oid = source_files.git_oids(spark, str(small)).first()["oid"]
    assert oid == "ce013625030ba8dba906f756967f9e9ca394464a"
    found = source_files.file_fingerprints(spark, str(tmp_path), glob="*.bin", native_limit=100).collect()
    assert {r["size_bytes"]: r["sha256"] for r in found} == {
        p.stat().st_size: hashlib.sha256(p.read_bytes()).hexdigest() for p in (small, large)
    }


def test_fingerprint_equals_canonical_json(spark, tmp_path):
    entries = [entry(n) for n in (3, 1, 2)] + [entry(4, path="data/val/café/episode_4/episode.fo.mcap")]
    listing = read_inventory(spark, write_json(tmp_path / "tree.json", entries + [{"type": "file", "path": "samples.json", "size": 1, "oid": "b" * 40}]))
    table = normalise_inventory(listing)
    canonical = [
        {"path": e["path"], "size": e["size"], "oid": e["oid"], "lfs": e["lfs"]} for e in sorted(entries, key=lambda e: e["path"])
    ]
    expected = hashlib.sha256(json.dumps(canonical, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    row = inventory.inventory_fingerprint(table).first()
    assert (row["entries"], row["fingerprint"]) == (4, expected)
    assert inventory.inventory_fingerprint(table.limit(0)).first()["fingerprint"] == hashlib.sha256(b"[]").hexdigest()


@pytest.mark.parametrize("changes, ok", [
    ({}, True), ({"type": "directory"}, False), ({"size": 99}, False), ({"oid": "zz"}, False), ({"lfs": None}, False), ({"size": 0}, False),
])
def test_entry_rules(spark, tmp_path, changes, ok):
    listing = read_inventory(spark, write_json(tmp_path / "tree.json", [entry(1, **changes)]))
    assert normalise_inventory(listing).first()["entry_ok"] is ok


def test_tsv_and_samples(spark, tmp_path):
    line = [path_of(1), "11", "a" * 40, "b" * 64, "11"]
    (tmp_path / "s.tsv").write_text("path\tsize_bytes\tgit_blob_oid\tlfs_sha256\tlfs_size_bytes\n" + "\t".join(line) + "\n")
    assert normalise_inventory(read_inventory_tsv(spark, str(tmp_path / "s.tsv"))).first()["entry_ok"]
    samples = {"samples": [{"filepath": path_of(n), "split": "val", "task": f"task_{n}", "episode_id": f"episode_{n}", "n_messages": 4} for n in (1, 1, 3)]}
    table = read_samples(spark, write_json(tmp_path / "samples.json", samples))
    listing = normalise_inventory(read_inventory(spark, write_json(tmp_path / "tree.json", [entry(1), entry(2)])))
    found = {r["path"]: r["status"] for r in inventory.match_samples(listing, table).collect()}
    assert found == {path_of(1): "duplicate_sample", path_of(2): "no_sample", path_of(3): "not_in_inventory"}


def test_snapshots_and_identity(spark):
    a = spark.createDataFrame([("p", 1, "x"), ("q", 1, "x")], "path string, size_bytes long, sha256 string")
    b = spark.createDataFrame([("p", 1, "x"), ("q", 2, "x"), ("r", 1, "x")], "path string, size_bytes long, sha256 string")
    assert {r["path"]: r["unchanged"] for r in inventory.unchanged(a, b).collect()} == {"p": True, "q": False, "r": False}
    sources = spark.createDataFrame([("p", "u"), ("p", "u"), ("q", "u"), ("r", "v"), ("r", "w")], "path string, source_uri string")
    unique = inventory.deduplicate_sources(sources)
    assert {r["path"]: (r["copies"], r["conflict"]) for r in unique.collect()} == {"p": (2, False), "q": (1, False), "r": (2, True)}
    assert [r["source_uri"] for r in inventory.reused_uris(unique).collect()] == ["u"]


def test_alignment_is_all_or_nothing(spark):
    rows = inventory.align_sources(spark, ["u", "v"], ["p", "q"], task=["s", "t"], episode=[]).collect()
    assert [tuple(r) for r in rows] == [("u", "p", "s"), ("v", "q", "t")]
    with pytest.raises(ValueError):
        inventory.align_sources(spark, ["u"], ["p", "q"])


def test_sessions(spark):
    rows = [("a", "session-metadata", {"session-uuid": " u "}), ("a", "session-metadata", {"session-uuid": "u"}),
            ("b", "session-metadata", {"session-uuid": "u"}), ("b", "session-metadata", {"session-uuid": "w"}),
            ("c", "other", {"session-uuid": "u"}), ("d", "session-metadata", {"session-uuid": " "})]
    found = session_episodes(spark.createDataFrame(rows, "source_uri string, name string, metadata map<string,string>"))
    assert {r["source_uri"]: (r["session_uuid"], r["conflicting"]) for r in found.collect()} == {"a": ("u", False), "b": ("u", True)}


def test_message_shapes(spark):
    raw = spark.createDataFrame(
        [("a", "/left-arm-state", [[1.0, 2.0], [3.0, 4.0]], ["1", "2.5"]), ("a", "/left-arm-state", None, ["x"])],
        "uri string, channel string, T array<array<double>>, q array<string>",
    )
    rows = normalise_messages(raw, {"uri": "source_uri", "channel": "topic", "T": "pose", "q": "position"}).collect()
    assert rows[0]["pose"] == [1, 2, 3, 4] and rows[0]["position"] == [1, 2.5] and rows[0]["decode_error"] is None
    assert rows[1]["decode_error"] == "position is not numeric"
    with pytest.raises(ValueError):
        normalise_messages(raw)


def test_topic_filter_reaches_the_scan(spark, tmp_path):
    messages(spark, [message("/camera/top"), message("/left-arm-state.plot", n=1), message(n=2)]).write.parquet(str(tmp_path / "m"))
    rows = read_arm_messages(spark, str(tmp_path / "m"))
    assert [r["sequence"] for r in rows.collect()] == [2]
    assert "In(topic" in rows._jdf.queryExecution().executedPlan().toString()


def clean(n, pose=True):
    uri = "hf://" + path_of(n)
    return [
        message(t, recorded(arm=arm) if pose else [], JOINTS, n=i, source=uri, ordinal=i)
        for i, (t, (arm, _)) in enumerate(C.ARM_TOPICS.items())
    ]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Three files: two intact, one with every pose missing; stored as a message table."""
    root = tmp_path_factory.mktemp("corpus")
    rows = clean(1) + clean(2) + clean(3, pose=False)
    messages(spark, rows).write.parquet(str(root / "messages"))
    listing = normalise_inventory(read_inventory(spark, write_json(root / "tree.json", [entry(n) for n in (1, 2, 3)])))
    samples = spark.createDataFrame(
        [(path_of(n), "val", f"task_{n}", f"episode_{n}", 4) for n in (1, 2, 3)],
        "filepath string, split string, task string, episode_id string, n_messages long",
    )
    channels = spark.createDataFrame(
        [(path_of(n), t + s, 1) for n in (1, 2, 3) for t in C.ARM_TOPICS for s in ("", ".plot")], "path string, topic string, n long"
    )
    observed = listing.select("path", F.col("size").alias("size_bytes"), F.col("lfs_oid").alias("sha256"))
    return root, spark.read.parquet(str(root / "messages")), listing, samples, channels, observed


def run_audit(corpus, name, **changes):
    root, rows, listing, samples, channels, observed = corpus
    inputs = {"listing": listing, "samples": samples, "channels": channels, "observed": observed, "observed_after": observed} | changes
    return jobs.run_corpus_audit(rows, str(root / name), "lab/x", "r1", uri_prefix="hf://", **inputs)


def test_corpus_job_separates_accounting_from_quality(spark, corpus):
    tables = run_audit(corpus, "audit")
    assert all(r["passed"] for r in tables["invariants"].collect())
    assert tables["invariants"].count() == 11
    summary = tables["corpus_audit"].first()
    assert (summary["files"], summary["integrity_passed"], summary["passed"]) == (3, True, False)
    assert tables["issues"].count() == 4
    assert [(r["cohort_y"], r["files"]) for r in tables["cohorts"].orderBy("cohort_y").collect()] == [(None, 1), (-0.61, 2)]
    assert tables["corpus_rollup"].where("topic IS NULL").first()["missing_pose"] == 4
    assert json.loads(sinks.as_json_lines(tables["file_audit"].orderBy("source_uri")).first()["json"])["messages"] == 4


def test_one_extra_declared_message_breaks_only_that_check(spark, corpus):
    extra = corpus[4].withColumn("n", F.when((F.col("path") == path_of(1)) & (F.col("topic") == "/left-arm-state.plot"), 2).otherwise(F.col("n")))
    declared = corpus[3].withColumn("n_messages", F.when(F.col("filepath") == path_of(1), 5).otherwise(4))
    failed = {r["name"] for r in run_audit(corpus, "extra", samples=declared)["invariants"].collect() if not r["passed"]}
    assert failed == {"declared_plus_plot_equals_summary"}
    assert extra.count() == 24


def test_changed_source_breaks_the_unchanged_check(spark, corpus):
    after = corpus[5].withColumn("sha256", F.when(F.col("path") == path_of(2), F.lit("0" * 64)).otherwise(F.col("sha256")))
    failed = {r["name"] for r in run_audit(corpus, "changed", observed_after=after)["invariants"].collect() if not r["passed"]}
    assert failed == {"sources_unchanged_by_audit"}


def test_nan_statistics_are_refused_and_stay_unreadable(spark, tmp_path):
    sinks.write_audit({"t": spark.sql("SELECT 1D AS v")}, str(tmp_path))
    with pytest.raises(gates.Refused, match="u_is_finite"):
        sinks.write_audit({"t": spark.sql("SELECT 2D AS v"), "u": spark.sql("SELECT double('NaN') AS v")}, str(tmp_path))
    assert sinks.read_audit(spark, str(tmp_path), "t").first()["v"] == 1
    with pytest.raises(gates.Refused, match="no committed audit table"):
        sinks.read_audit(spark, str(tmp_path), "u")


def test_a_broken_run_is_not_read(spark, tmp_path):
    run = sinks.AuditRun(spark, str(tmp_path))
    run.write({"t": spark.sql("SELECT 1 AS v")})
    with pytest.raises(gates.Refused):
        sinks.read_audit(spark, str(tmp_path), "t")
    run.commit()
    assert sinks.read_audit(spark, str(tmp_path), "t").count() == 1


def test_other_schema_version_is_refused(spark, tmp_path):
    run = sinks.AuditRun(spark, str(tmp_path))
    run.write({"t": spark.sql("SELECT 1 AS v")})
    run.commit()
    stored = f"{tmp_path}/audit-{run.run_id}/t"
    spark.sql("SELECT 1 AS v, 'other' AS schema_version").write.mode("append").parquet(stored)
    with pytest.raises(gates.Refused, match="audit_schema_version"):
        sinks.read_audit(spark, str(tmp_path), "t")


@pytest.mark.parametrize("changes, gate", [
    ({"expected_files": 4}, "inventory_count_is_pinned"),
    ({"expected_fingerprint": "0" * 64}, "inventory_fingerprint_is_pinned"),
    ({"samples_oid": ("a", "b")}, "samples_oid_is_pinned"),
])
def test_audit_refuses_another_inventory(spark, corpus, changes, gate):
    with pytest.raises(gates.Refused, match=gate):
        run_audit(corpus, f"refused-{gate}", **changes)
    with pytest.raises(gates.Refused):
        sinks.read_audit(spark, str(corpus[0] / f"refused-{gate}"), "inventory_facts")


def test_audit_refuses_a_file_without_sample(spark, corpus):
    with pytest.raises(gates.Refused, match="every_file_has_its_sample"):
        run_audit(corpus, "lost", samples=corpus[3].where(F.col("filepath") != path_of(1)))


def source_rows(spark, **changes):
    rows = [{"source_uri": "hf://" + path_of(n), "path": path_of(n), "sha256": entry(n)["lfs"]["oid"], "size_bytes": 10 + n} for n in (1, 2, 3)]
    table = spark.createDataFrame(rows, "source_uri string, path string, sha256 string, size_bytes long")
    return table.withColumns({name: F.expr(text) for name, text in changes.items()})


def test_recovery_job(spark, corpus, tmp_path):
    root, rows, *_ = corpus
    out = str(tmp_path / "out")
    expected = source_rows(spark, expected_sha256="upper(sha256)", expected_size_bytes="size_bytes")
    manifest = jobs.run_recovery(rows, expected, out, source_files=[str(root / "messages")])
    table = sinks.read_published(spark, out)
    assert table.columns == list(C.RECOVERY_COLUMNS.values()) and table.count() == manifest["rows"] == 12
    assert json.loads(table.schema["geometry.status_mask"].metadata["bits"])["recovered"] == 3
    provenance = spark.read.parquet(f"{out}/provenance-{manifest['run_id']}")
    assert {r["identity_status"] for r in provenance.collect()} == {"verified"}
    counts = spark.read.parquet(f"{out}/status_counts-{manifest['run_id']}").where("source_uri IS NULL AND field = 'recovery_status'")
    assert {r["status"]: r["n"] for r in counts.collect()} == {"source_pose_intact": 8, "recovered": 4}
    again = jobs.run_recovery(rows, expected, str(tmp_path / "again"))
    assert again["content_digest"] == manifest["content_digest"]


@pytest.mark.parametrize("changes, gate", [
    ({"expected_size_bytes": "size_bytes + 1"}, "expected_identity_holds"),
    ({"expected_sha256": "repeat('0', 64)"}, "expected_identity_holds"),
    ({"expected_sha256": "'xyz'"}, "expected_identity_holds"),
    ({"source_uri": "'hf://same'"}, "source_uri_is_unique"),
    ({"source_uri": "concat(source_uri, 'x')"}, "every_source_is_listed"),
    ({"task": "'  '"}, "identity_is_not_blank"),
])
def test_recovery_refuses_bad_identity(spark, corpus, tmp_path, changes, gate):
    with pytest.raises(gates.Refused, match=gate):
        jobs.run_recovery(corpus[1], source_rows(spark, **changes), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_recovery_aborts_on_decode_errors(spark, tmp_path):
    rows = messages(spark, clean(1) + [message("/left-arm-state", error="broken", n=9, source="hf://" + path_of(1))])
    with pytest.raises(gates.Refused, match="no_decode_error"):
        jobs.run_recovery(rows, source_rows(spark), str(tmp_path / "out"))


def test_release_job(spark, corpus, tmp_path):
    rows = corpus[1]
    files = audit.audit_messages(rows)[1]
    manifest = jobs.run_release(rows, files, source_rows(spark), str(tmp_path / "out"))
    table = sinks.read_published(spark, str(tmp_path / "out"))
    assert manifest["rows"] == 4 and {r[0] for r in table.select("`geometry.recovery_status`").collect()} == {"recovered"}
    mixed = rows.unionByName(messages(spark, [message(pose=[], position=JOINTS, n=9, source="hf://" + path_of(1), ordinal=4)]))
    with pytest.raises(gates.Refused, match="refused_file"):
        jobs.run_release(mixed, audit.audit_messages(mixed)[1], source_rows(spark), str(tmp_path / "mixed"))
    with pytest.raises(gates.Refused, match="every_row_recovered"):
        jobs.run_recovery(rows, source_rows(spark), str(tmp_path / "only"), require_recovery_only=True)
    assert not list(Path(tmp_path / "only").glob("manifest*"))


def test_profile_is_independent_of_classes(spark):
    df = messages(spark, [message(pose=recorded()[:14] + [float("nan")], position=JOINTS), message(position=JOINTS, n=1)])
    found = {(r["field"], r["length"]): (r["n"], r["nonfinite"]) for r in reconcile.length_histogram(reconcile.field_profile(df)).collect()}
    assert found == {("pose", 15): (1, 1), ("pose", 0): (1, 0), ("position", 6): (2, 0)}


def test_determinism(spark, corpus):
    scored = audit.score_messages(corpus[1]).drop("log_time_ns")
    assert gates.same_content(scored, scored.repartition(3))
    assert not gates.same_content(scored, scored.limit(5))


def test_live_counters_equal_batch(spark, corpus, tmp_path):
    from posefold.streaming.live import live_topic_counters

    root, rows, *_ = corpus
    stream = spark.readStream.schema(C.ARM_MESSAGES).parquet(str(root / "messages"))
    query = live_topic_counters(stream).writeStream.outputMode("complete").format("memory").queryName("live").option(
        "checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    live = {(r["source_uri"], r["topic"]): (r["messages"], r["missing_pose"], r["fk_compared"]) for r in spark.table("live").collect()}
    batch = {(r["source_uri"], r["topic"]): (r["messages"], r["missing_pose"], r["fk_compared"]) for r in audit.topic_audit(audit.score_messages(rows)).collect()}
    assert live == batch


def test_tree_digest_sees_every_entry_and_no_order(spark):
    rows = [(f"data/{i:03}", i, f"{i:040x}", f"{i:064x}", i) for i in range(70)]
    schema = "path string, size long, oid string, lfs_oid string, lfs_size long"
    table = spark.createDataFrame(rows, schema)
    first = inventory.inventory_tree_digest(table, fanout=4).first()
    again = inventory.inventory_tree_digest(spark.createDataFrame(rows[::-1], schema).repartition(5), fanout=4).first()
    assert first == again and first["entries"] == 70
    changed = [(p, s + (p == "data/069"), *rest) for p, s, *rest in rows]
    assert inventory.inventory_tree_digest(spark.createDataFrame(changed, schema), fanout=4).first()["digest"] != first["digest"]
    assert inventory.inventory_tree_digest(table.limit(0)).count() == 0


def test_release_refuses_a_stale_audit(spark, corpus, tmp_path):
    rows = corpus[1]
    files = audit.audit_messages(rows)[1]
    late = rows.unionByName(messages(spark, [message(pose=[], position=JOINTS, n=50, source="hf://" + path_of(2), ordinal=50)]))
    chosen = gates.release_facts(files).where("decision = 'selected'").first()["source_uri"]
    late = late.withColumn("source_uri", F.when(F.col("sequence") == 50, chosen).otherwise(F.col("source_uri")))
    with pytest.raises(gates.Refused, match="rows_are_as_audited"):
        jobs.run_release(late, files, source_rows(spark), str(tmp_path / "stale"))


def test_release_audits_once(spark, monkeypatch):
    """The audit behind the files is run once for the gate, the choice and the promise."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked_at(n):
        seen.add(1)
        return n

    row = ("fx://a", 4, 4, 4, 0, 4, 0)
    names = ("messages", "invalid_pose", "missing_pose", "intact_pose", "recoverable_invalid_pose", "unrecoverable_invalid_pose")
    files = spark.createDataFrame([row], "source_uri string, " + ", ".join(f"{n} bigint" for n in names))
    files = files.withColumn("messages", looked_at("messages"))
    monkeypatch.setattr(jobs, "run_recovery", lambda chosen, sources, output, audited, **_: audited.collect())
    empty = spark.createDataFrame([], "source_uri string, topic string")
    assert [tuple(r) for r in jobs.run_release(empty, files, None, "")] == [("fx://a", 4)]
    assert seen.value == 1
