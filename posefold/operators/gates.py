"""Gates: named checks that must hold before anything is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Refused(RuntimeError):
    """A gate did not hold; nothing was published."""


def gate(df: DataFrame, name: str, passed: Column, detail: Column | None = None) -> DataFrame:
    """One gate row from an aggregate over ``df``. A gate over no rows fails unless ``passed`` says so."""
    text = detail if detail is not None else F.lit(None).cast("string")
    return df.agg(
        F.lit(name).alias("gate"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        text.cast("string").alias("detail"),
    )


def require(gates: DataFrame) -> None:
    """Raise :class:`Refused` naming the gates that failed. A table of gates has a row for each gate."""
    failed = gates.where(~F.col("passed")).collect()
    if failed:
        raise Refused("; ".join(f"{r['gate']}: {r['detail'] or 'failed'}" for r in failed))


def all_gates(*gates: DataFrame) -> DataFrame:
    table = gates[0]
    for other in gates[1:]:
        table = table.unionByName(other)
    return table


def no_rows_where(df: DataFrame, name: str, violation: Column) -> DataFrame:
    """Gate that holds when no row violates; over an empty table it holds."""
    count = F.count_if(violation)
    return gate(df, name, count == 0, F.concat(count.cast("string"), F.lit(" violations")))


def release_facts(files: DataFrame) -> DataFrame:
    """Classify every audited file for a repair-only release.

    ``selected``: every target pose is literally missing and all can be derived. ``intact``: nothing
    to repair. Any other file refuses the whole release, and the reason says why.
    """
    reason = (
        "CASE WHEN invalid_pose = 0 THEN NULL"
        " WHEN invalid_pose <> messages THEN 'mixed_intact_and_invalid'"
        " WHEN recoverable_invalid_pose <> invalid_pose OR unrecoverable_invalid_pose <> 0"
        " THEN 'not_all_recoverable'"
        " WHEN missing_pose <> messages THEN 'not_literally_missing' END"
    )
    return files.select(
        "source_uri",
        "messages",
        F.expr(f"CASE WHEN invalid_pose = 0 THEN 'intact' WHEN ({reason}) IS NULL THEN 'selected'"
               " ELSE 'refused' END").alias("decision"),
        F.expr(reason).alias("reason"),
    )


def release_gate(facts: DataFrame) -> DataFrame:
    """Gate rows of a release: no refused file, and at least one selected."""
    selected = F.count_if(F.col("decision") == "selected")
    return all_gates(
        no_rows_where(facts, "release_has_no_refused_file", F.col("decision") == "refused"),
        gate(facts, "release_selects_a_file", selected > 0, selected),
    )


def select_release(messages: DataFrame, facts: DataFrame) -> DataFrame:
    """Messages of the selected files."""
    from posefold.operators.scale import lookup_join

    chosen = facts.where(F.col("decision") == "selected").select("source_uri")
    return lookup_join(messages, chosen, ["source_uri"], how="inner", derived=True)


def recovery_only(rows: DataFrame) -> DataFrame:
    """Gate: every row of every source was recovered."""
    return no_rows_where(
        rows, "every_row_recovered", ~F.coalesce(F.col("recovery_status") == "recovered", F.lit(False))
    )


def row_count_gate(df: DataFrame, expected: int, name: str = "row_count") -> DataFrame:
    found = F.count(F.lit(1))
    return gate(df, name, found == expected, F.concat(found.cast("string"), F.lit(f" rows, expected {expected}")))


def content_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-insensitive digest of a table: row count and the sum of per-row 64-bit hashes.

    Two runs that give equal keyed values give equal digests whatever their partitioning.
    """
    return df.agg(*digest_columns(df, columns))


def digest_columns(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """``rows`` and ``digest`` as aggregates over ``df``, for :func:`content_digest` or to observe a write."""
    names = columns or sorted(df.columns)
    row = F.xxhash64(*(F.col(f"`{name}`") for name in names)).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("digest"),
    ]


def same_content(left: DataFrame, right: DataFrame) -> bool:
    return content_digest(left).first() == content_digest(right, sorted(left.columns)).first()


def audit_schema_gate(table: DataFrame, version: str) -> DataFrame:
    """Gate on the ``schema_version`` column of a stored audit result."""
    return no_rows_where(
        table, "audit_schema_version", ~F.coalesce(F.col("schema_version") == version, F.lit(False))
    )


