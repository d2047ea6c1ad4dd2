"""Telemetry-shaped tables that Spark derives from the ``events`` and ``embeddings`` tables.

The event stream becomes decoded arm messages and 14-value frames; every ``user_id`` is an episode file.
All events, users and vectors take part, so the work grows with both tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions.kinematics import with_chain_pose
from posefold.operators.scale import hold, lookup_join, spread_small_scan

NUMBER_WIDTH = 8
TOPIC_OF_EVENT = {
    "view": "/left-arm-state",
    "click": "/right-arm-state",
    "purchase": "/left-arm-action",
    "signup": "/right-arm-action",
    "error": "/camera/top",
}
_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "embeddings")
        .withColumn("e", F.transform(F.slice("embedding", 1, 28), lambda v: v.cast("double") * 3))
        .select("vec_id", "e")
    )


def _vector_count(spark: SparkSession, sf_dir: str) -> int:
    """Vectors that events are dealt over: one more than the largest number."""
    top = _table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0]
    return (top or 0) + 1


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    rows = spread_small_scan(rows)
    return rows.withColumn("vec_id", F.expr(f"event_id % {_vector_count(spark, sf_dir)}"))


def _file_columns(ep: str = "ep") -> dict[str, str]:
    number = episode_text(ep)
    return {
        "task": f"concat('task_', {number})",
        "episode_id": f"concat('episode_', {number})",
        "path": f"concat('data/val/task_', {number}, '/episode_', {number}, '/episode.fo.mcap')",
    }


def episode_text(ep: str = "ep") -> str:
    """The number with leading zeros; a longer one keeps all its digits."""
    return f"lpad(cast({ep} AS string), greatest({NUMBER_WIDTH}, length(cast({ep} AS string))), '0')"


def file_path(ep: str = "ep") -> str:
    return _file_columns(ep)["path"]


def source_uri_of(path: str) -> str:
    return f"concat('fx://', {path})"


def arm_messages(spark: SparkSession, sf_dir: str, clean_only: bool = False) -> DataFrame:
    """Decoded messages with planted faults; ``clean_only`` leaves out the eight faulty files."""
    events = _events(spark, sf_dir).selectExpr(
        "vec_id",
        "event_id AS sequence",
        f"cast({_MICROS} * 1000 AS decimal(20, 0)) AS log_time_ns",
        f"cast({_MICROS} * 1000 - 10000 AS decimal(20, 0)) AS publish_time_ns",
        f"CASE event_type "
        + " ".join(f"WHEN '{kind}' THEN '{topic}'" for kind, topic in TOPIC_OF_EVENT.items())
        + " END AS plain_topic",
        "user_id AS ep",
        "event_id % 20 AS h",
        "event_id DIV 20 % 10 AS g",
    )
    if clean_only:
        events = events.where("ep % 5 <> 4")
    # The clean pose depends on the vector alone, so it is derived on those rows before the join.
    angles = _vectors(spark, sf_dir).select("vec_id", F.slice("e", 17, 6).alias("q"))
    posed = with_chain_pose(angles, [f"get(q, {i})" for i in range(6)], "k_")
    rows = lookup_join(events, posed, ["vec_id"], how="inner")

    rows = rows.selectExpr(
        "*",
        f"{source_uri_of(_file_columns()['path'])} AS source_uri",
        "IF(ep = 9 AND plain_topic = '/right-arm-action', '/camera/top', plain_topic) AS topic",
        "ep % 5 = 4 AS dirty",
        "ep % 5 = 4 AND sequence % 97 = 0 AS undecodable",
    )
    rows = rows.selectExpr(
        "*",
        "k_y + CASE WHEN topic NOT LIKE '/right-arm-%' THEN 0D"
        " WHEN ep % 16 = 3 THEN -0.8D ELSE -0.61D END AS y",
    )

    def matrix(scale: str = "", first: str = "", x: str = "k_x") -> str:
        entries = []
        for i, translation in enumerate((x, "y", "k_z")):
            entries += [f"{first}k_r{i}0{scale}", f"k_r{i}1{scale}", f"k_r{i}2{scale}", translation]
        return f"array({', '.join(entries)}, 0D, 0D, 0D, 1D)"

    def with_slot(slot: int, value: str) -> str:
        return f"transform({matrix()}, (v, i) -> IF(i = {slot - 1}, {value}, v))"

    faults = {
        0: "cast(array() AS array<double>)",
        1: "cast(NULL AS array<double>)",
        2: f"slice({matrix()}, 1, 15)",
        3: f"concat({matrix()}, array(1D))",
        4: with_slot(1, "double('NaN')"),
        5: with_slot(1, "double('Infinity')"),
        6: with_slot(1, "cast(NULL AS double)"),
        7: with_slot(13, "0.5D"),
        8: matrix(scale=" * 1.01D"),
        9: matrix(first="-"),
        10: with_slot(13, "5e-6D"),
        11: matrix(x="k_x + 0.02D"),
    }
    joint_faults = {
        0: "slice(q, 1, 5)",
        1: "cast(array() AS array<double>)",
        2: "cast(NULL AS array<double>)",
        3: "transform(q, (v, i) -> IF(i = 0, double('NaN'), v))",
        4: "transform(q, (v, i) -> IF(i = 0, cast(NULL AS double), v))",
    }
    rows = rows.selectExpr(
        "source_uri",
        "topic",
        "log_time_ns",
        "publish_time_ns",
        "sequence",
        "cast(NULL AS bigint) AS message_ordinal",
        f"CASE WHEN undecodable THEN NULL WHEN ep % 5 = 0 THEN {faults[0]} "
        + " ".join(f"WHEN dirty AND h = {h} THEN {text}" for h, text in faults.items())
        + f" ELSE {matrix()} END AS pose",
        "CASE WHEN undecodable THEN NULL "
        + " ".join(f"WHEN dirty AND g = {g} THEN {text}" for g, text in joint_faults.items())
        + " ELSE q END AS position",
        "IF(undecodable, 'payload', NULL) AS decode_error",
    )
    # As with a stored table, filters on the payload end here instead of in the making of it.
    return hold(rows, ["pose", "position"])


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with planted faults in the 14-value vectors."""
    events = _events(spark, sf_dir).selectExpr(
        "vec_id", "event_id", "user_id", f"{_MICROS} / 1e6D AS timestamp", "event_id % 11 AS kind"
    )
    vectors = _vectors(spark, sf_dir).select(
        "vec_id", F.slice("e", 1, 14).alias("s"), F.slice("e", 15, 14).alias("a")
    )
    rows = lookup_join(events, vectors, ["vec_id"], how="inner")
    return rows.selectExpr(
        "'fx://frames/events.parquet' AS source_uri",
        "event_id AS source_row",
        "user_id AS episode_index",
        "event_id AS frame_index",
        "event_id AS index",
        "timestamp",
        "CASE kind WHEN 1 THEN transform(s, (v, i) -> IF(i = 6, double('NaN'), v))"
        " WHEN 2 THEN slice(s, 1, 13)"
        " WHEN 4 THEN transform(s, (v, i) -> IF(i = 0, cast(NULL AS double), v)) ELSE s END AS state",
        "CASE kind WHEN 0 THEN transform(a, (v, i) -> IF(i = 9, double('NaN'), v))"
        " WHEN 3 THEN NULL ELSE a END AS action",
    )


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("ep"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum("event_id").alias("mark"),
            (F.sum(F.octet_length("props")) + 1000).alias("size"),
        )
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed file per episode: ``path, size, oid, lfs_oid, lfs_size``; sizes and digests follow from
    the file's events."""
    return _episodes(spark, sf_dir).selectExpr(
        f"{_file_columns()['path']} AS path", "size", "mark"
    ).selectExpr(
        "path",
        "size",
        "substring(sha2(concat('git', path, ':', mark), 256), 1, 40) AS oid",
        "sha2(concat(path, ':', mark), 256) AS lfs_oid",
        "size AS lfs_size",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample row per episode file."""
    columns = _file_columns()
    return _episodes(spark, sf_dir).selectExpr(
        f"{columns['path']} AS filepath",
        "'val' AS split",
        f"{columns['task']} AS task",
        f"{columns['episode_id']} AS episode_id",
        "n_events AS n_messages",
    )


def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared message counts per file and topic, with one generated duplicate per arm topic."""
    counts = (
        _table(spark, sf_dir, "events")
        .selectExpr(
            "user_id AS ep",
            "CASE event_type "
            + " ".join(f"WHEN '{kind}' THEN '{topic}'" for kind, topic in TOPIC_OF_EVENT.items())
            + " END AS t",
        )
        .selectExpr("ep", "IF(ep = 9 AND t = '/right-arm-action', '/camera/top', t) AS topic")
        .groupBy("ep", "topic")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(f"{_file_columns()['path']} AS path", "topic", "n")
    )
    plot = F.when(F.col("topic").isin(*C.ARM_TOPICS), F.concat("topic", F.lit(C.PLOT_SUFFIX)))
    return counts.select(
        "path", F.explode(F.array_compact(F.array(F.col("topic"), plot))).alias("topic"), "n"
    )


def session_metadata(spark: SparkSession, sf_dir: str, conflicting: bool = False) -> DataFrame:
    """Session records: one uuid for even episodes; ``conflicting`` adds a second one to episode 2."""
    rows = _episodes(spark, sf_dir).selectExpr(
        f"{source_uri_of(_file_columns()['path'])} AS source_uri",
        "'session-metadata' AS name",
        f"IF(ep % 2 = 0, map('session-uuid', concat('s', {episode_text()})), map('operator', 'none')) AS metadata",
        "ep",
    )
    base = rows.drop("ep")
    if not conflicting:
        return base
    second = rows.where("ep = 2").selectExpr(
        "source_uri", "name", "map('session-uuid', 'other') AS metadata"
    )
    return base.unionByName(second)


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source file: uri, path, digest and size as expected and as observed."""
    return inventory(spark, sf_dir).selectExpr(
        f"{source_uri_of('path')} AS source_uri",
        "path",
        "lfs_oid AS sha256",
        "size AS size_bytes",
    )
