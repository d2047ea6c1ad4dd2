"""Inventory joins, identity checks and the inventory fingerprint."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.functions import text as X
from posefold.operators.scale import cut_lineage, key_counts, ordinal_within


def match_samples(inventory: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per path seen on either side: ``n_inventory, n_samples`` and a status.

    ``inventory`` has ``path``; ``samples`` has ``filepath, split, task, episode_id``. Consistency of
    the sample with its path is checked for paths that match one to one.
    """
    left = inventory.select("path")
    right = samples.select(F.col("filepath").alias("path"), "split", "task", "episode_id", "n_messages")
    right = right.withColumn(
        "consistent",
        F.coalesce(
            (F.col("split") == "val")
            & (F.col("task") == X.path_part("path", 3))
            & (F.col("episode_id") == X.path_part("path", 4))
            & (F.col("n_messages") >= 0),
            F.lit(False),
        ),
    )
    stacked = left.select("path", F.lit(1).alias("i"), F.lit(0).alias("s"), F.lit(None).cast("boolean").alias("consistent")).unionByName(
        right.select("path", F.lit(0).alias("i"), F.lit(1).alias("s"), "consistent")
    )
    per_path = stacked.groupBy("path").agg(
        F.sum("i").alias("n_inventory"), F.sum("s").alias("n_samples"), F.every("consistent").alias("consistent")
    )
    return per_path.select(
        "path",
        "n_inventory",
        "n_samples",
        X.is_episode_path("path").alias("path_ok"),
        F.expr(
            "CASE WHEN n_inventory > 1 THEN 'duplicate_inventory' WHEN n_samples > 1 THEN 'duplicate_sample'"
            " WHEN n_samples = 0 THEN 'no_sample' WHEN n_inventory = 0 THEN 'not_in_inventory'"
            " WHEN NOT consistent THEN 'inconsistent' ELSE 'matched' END"
        ).alias("status"),
    )


def canonical_entry() -> Column:
    """One entry as JSON with sorted keys and no blanks, as the fingerprint needs it."""
    def quoted(name: str) -> Column:
        # to_json escapes quotes, backslashes and control characters of a single string.
        return F.regexp_extract(F.to_json(F.struct(F.col(name).alias("v"))), r'^\{"v":(.*)\}$', 1)

    return F.concat(
        F.lit('{"lfs":{"oid":'), quoted("lfs_oid"), F.lit(',"size":'), F.col("lfs_size").cast("string"),
        F.lit('},"oid":'), quoted("oid"), F.lit(',"path":'), quoted("path"),
        F.lit(',"size":'), F.col("size").cast("string"), F.lit("}"),
    )


def inventory_fingerprint(inventory: DataFrame) -> DataFrame:
    """SHA-256 of the JSON list of all entries ordered by path, plus the number of entries.

    This flat form is for checking a pinned listing: one digest over an ordered text is sequential by
    definition, so one task sorts and digests a short line per file, a batch at a time. A listing of any
    length has :func:`inventory_tree_digest`.
    """
    lines = inventory.select("path", canonical_entry().alias("line"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, entries = hashlib.sha256(b"["), 0
        for batch in batches:
            for line in batch["line"].dropna():
                # JSON escapes everything outside ASCII; Spark writes it as it is.
                plain = line if line.isascii() else "".join(
                    c if c.isascii() else json.dumps(c)[1:-1] for c in line
                )
                state.update((b"," if entries else b"") + plain.encode())
                entries += 1
        state.update(b"]")
        yield pd.DataFrame({"entries": [entries], "fingerprint": [state.hexdigest()]})

    # A null line makes sure that an empty inventory is digested too, as an empty list.
    start = lines.sparkSession.range(1).selectExpr("string(NULL) AS path", "string(NULL) AS line")
    one = lines.unionByName(start).repartition(1).sortWithinPartitions("path").select("line")
    return one.mapInPandas(digest, "entries bigint, fingerprint string")


def inventory_tree_digest(inventory: DataFrame, fanout: int = 1000) -> DataFrame:
    """One digest of a listing of any length, plus the number of entries, with no sequential pass.

    Entries are digested one by one and numbered by path; the digests of ``fanout`` successive entries
    make the digest of a block, blocks make blocks in turn, until one is left. A task sees one block
    at a time. An empty listing has no digest.
    """
    lines = inventory.select("path", X.sha256_of_text(canonical_entry()).alias("digest"))
    level = ordinal_within(lines, [], ["path"], "number").select("number", "digest")
    entries = None
    while True:
        blocks = level.groupBy(F.floor(F.col("number") / fanout).alias("number")).agg(
            F.array_sort(F.collect_list(F.struct("number", "digest"))).alias("parts"), F.count(F.lit(1)).alias("n")
        )
        joined = F.array_join(F.transform("parts", lambda part: part["digest"]), "")
        level = cut_lineage(blocks.select("number", X.sha256_of_text(joined).alias("digest"), "n"), "digests")
        entries = level.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if entries is None else entries
        if level.limit(2).count() < 2:
            return level.select(F.lit(entries).cast("bigint").alias("entries"), "digest")
        level = level.select("number", "digest")


def file_identity(inventory: DataFrame, observed: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Per listed path: do the observed size and digest equal the listed ones?

    ``observed`` has ``path, size_bytes, sha256``. A listed file that was not observed matches nothing.
    ``keep`` names extra key columns of both.
    """
    joined = inventory.join(observed, [*keep, "path"], "left")
    return joined.select(
        *keep,
        "path",
        F.coalesce(F.col("size") == F.col("size_bytes"), F.lit(False)).alias("size_matches"),
        F.coalesce(X.hex_digest("sha256", 64) == F.col("lfs_oid"), F.lit(False)).alias("sha256_matches"),
    )


def source_identity(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Check optional expectations per source: ``verified``, ``mismatch`` or ``not_supplied``.

    ``expected`` has ``source_uri, expected_sha256, expected_size_bytes`` (each may be null).
    """
    joined = expected.join(observed.select("source_uri", "sha256", "size_bytes"), "source_uri", "left")
    digest = X.hex_digest("expected_sha256", 64)
    malformed = F.col("expected_sha256").isNotNull() & (
        digest.isNull() | F.startswith("expected_sha256", F.lit("sha256:"))
    )
    agrees = (
        ~malformed
        & (digest.isNull() | F.coalesce(digest == F.col("sha256"), F.lit(False)))
        & (
            F.col("expected_size_bytes").isNull()
            | F.coalesce(F.col("expected_size_bytes") == F.col("size_bytes"), F.lit(False))
        )
    )
    none = F.col("expected_sha256").isNull() & F.col("expected_size_bytes").isNull()
    return joined.select(
        "source_uri",
        "sha256",
        "size_bytes",
        F.when(none, "not_supplied").when(agrees, "verified").otherwise("mismatch").alias("status"),
    )


def deduplicate_sources(sources: DataFrame) -> DataFrame:
    """Collapse repeated sources: one row per path with ``conflict`` when its identity varies.

    Smallest and largest identity struct tell one identity from several without collecting a set.
    """
    identity = F.struct(*(c for c in sources.columns if c != "path"))
    per_path = sources.groupBy("path").agg(
        F.count(F.lit(1)).alias("copies"), F.min(identity).alias("low"), F.max(identity).alias("high")
    )
    return per_path.select("path", "copies", (~F.col("low").eqNullSafe(F.col("high"))).alias("conflict"), "low.*")


def reused_uris(deduplicated: DataFrame) -> DataFrame:
    """URIs claimed by more than one path."""
    return (
        deduplicated.groupBy("source_uri")
        .agg(F.count(F.lit(1)).alias("paths"))
        .where(F.col("paths") > 1)
    )


def unchanged(before: DataFrame, after: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Compare two fingerprint snapshots (``path, size_bytes, sha256``) path by path."""
    counts = key_counts(before, after, [*keep, "path"], ["size_bytes", "sha256"])
    return counts.select(
        *keep,
        "path",
        F.expr("n_left = 1 AND n_right = 1 AND l_min <=> r_min").alias("unchanged"),
    )


def align_sources(
    spark, uris: list[str], paths: list[str], **optional: list
) -> DataFrame:
    """Pair per-source lists by position. Every optional list is absent or has one entry per path."""
    columns = {"source_uri": uris, "path": paths}
    columns |= {name: values for name, values in optional.items() if values}
    for name, values in columns.items():
        if len(values) != len(paths):
            raise ValueError(f"{name} has {len(values)} entries for {len(paths)} paths")
    kinds = {int: "bigint", float: "double", bool: "boolean"}
    fields = (f"{n} {kinds.get(type(next((v for v in vs if v is not None), '')), 'string')}" for n, vs in columns.items())
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(fields))


def channel_summary(channels: DataFrame) -> DataFrame:
    """Per path: all messages and generated duplicates declared by the channel counts."""
    plot = F.endswith("topic", F.lit(".plot"))
    return channels.groupBy("path").agg(
        F.sum("n").alias("all_messages"),
        F.coalesce(F.sum(F.when(plot, F.col("n"))), F.lit(0)).alias("plot_messages"),
    )


def inventory_gate_facts(entries: DataFrame) -> DataFrame:
    """Counts a gate compares: entries, distinct paths, refused entries."""
    per_path = entries.groupBy("path").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(~F.col("entry_ok")).alias("bad")
    )
    return per_path.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("entries"),
        F.count(F.lit(1)).alias("paths"),
        F.count_if(F.col("copies") > 1).alias("duplicate_paths"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("refused_entries"),
    )
