"""Scan of decoded arm messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions.classify import is_target_topic
from posefold.functions.text import stripped


def read_arm_messages(spark: SparkSession, *paths: str) -> DataFrame:
    """Target-topic rows of a decoded message table; the topic filter reaches the Parquet scan.

    Rows that could not be decoded are kept, since they must be counted.
    """
    messages = normalise_messages(spark.read.parquet(*paths))
    return messages.where(
        is_target_topic() | F.col("topic").isNull() | F.col("decode_error").isNotNull()
    )


def normalise_messages(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Bring another pipeline's record shape to the ``arm_messages`` columns.

    ``rename`` maps source names to contract names. A 4x4 pose given as nested rows is flattened,
    optional columns are added as nulls, and a payload whose elements are not numbers becomes a
    ``decode_error`` instead of stopping the scan.
    """
    df = df.withColumnsRenamed(rename or {})
    present = dict(df.dtypes)
    errors = [F.col("decode_error")] if "decode_error" in present else []
    columns = []
    for field in C.ARM_MESSAGES:
        name, wanted = field.name, field.dataType
        if name == "decode_error":
            continue
        if name not in present:
            if name in ("source_uri", "topic", "pose", "position"):
                raise ValueError(f"message table has no column {name!r}")
            columns.append(F.lit(None).cast(wanted).alias(name))
            continue
        value = F.col(name)
        if present[name].startswith("array<array<"):
            value = F.flatten(value)
        cast = value.try_cast(wanted)
        if name in ("pose", "position"):
            errors.append(_cast_error(name, value, cast, present[name]))
        columns.append(cast.alias(name))
    text = F.coalesce(*errors, F.lit(None).cast("string"))
    return df.select(*columns, text.alias("decode_error"))


def _cast_error(name: str, value, cast, dtype: str):
    """A value lost by the cast (an element present before, null after) is a decode error."""
    if not dtype.endswith("string>") and "string" not in dtype:
        return F.lit(None).cast("string")
    lost = (F.size(F.filter(value, lambda v: v.isNull())) < F.size(
        F.filter(cast, lambda v: v.isNull())
    )) | (value.isNotNull() & cast.isNull())
    return F.when(lost, F.lit(f"{name} is not numeric"))


def session_episodes(metadata: DataFrame) -> DataFrame:
    """Per source: the session uuids found in ``session-metadata`` records.

    Input columns ``source_uri, name, metadata``; output ``source_uri, n_uuids, session_uuid``. The
    smallest and largest uuid are enough to tell one from several, so nothing is collected.
    """
    uuid = stripped(F.try_element_at("metadata", F.lit("session-uuid")))
    return (
        metadata.where(F.col("name") == "session-metadata")
        .select("source_uri", F.nullif(uuid, F.lit("")).alias("uuid"))
        .where(F.col("uuid").isNotNull())
        .groupBy("source_uri")
        .agg(F.min("uuid").alias("session_uuid"), F.max("uuid").alias("other_uuid"))
        .select(
            "source_uri",
            "session_uuid",
            (F.col("session_uuid") != F.col("other_uuid")).alias("conflicting"),
        )
    )
