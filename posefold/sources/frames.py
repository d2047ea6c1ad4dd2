"""Scan of 14-value frame tables and the checks made before any row is read."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posefold import contracts as C
from posefold.sources.files import arrow_uri

_INTEGER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_INTEGER, T.FloatType, T.DoubleType, T.DecimalType)


class FrameSchemaError(ValueError):
    """The table or its feature description does not meet the frame contract."""


def check_frame_schema(schema: T.StructType) -> None:
    """Refuse a table by column name and type family; no data is read."""
    types = {field.name: field.dataType for field in schema}
    needed = (*C.FRAME_KEYS, *C.FRAME_INPUT_COLUMNS)
    absent = [name for name in needed if name not in types]
    if absent:
        raise FrameSchemaError(f"missing required columns: {', '.join(absent)}")
    for name in ("episode_index", "frame_index", "index"):
        # An unsigned 64-bit column reads as decimal(20, 0); it is still an integer type.
        wide = isinstance(types[name], T.DecimalType) and types[name].scale == 0
        if not (isinstance(types[name], _INTEGER) or wide):
            raise FrameSchemaError(f"{name} must be an integer, found {types[name].simpleString()}")
    if not isinstance(types["timestamp"], _NUMERIC):
        raise FrameSchemaError("timestamp must be numeric")
    for name in C.FRAME_INPUT_COLUMNS:
        if not isinstance(types[name], T.ArrayType):
            raise FrameSchemaError(f"{name} must be a list")
        if not isinstance(types[name].elementType, _NUMERIC):
            raise FrameSchemaError(f"{name} must hold numbers")


def _file_fault(schema) -> str | None:
    """What keeps an Arrow schema, that of one file's footer, from the frame contract."""
    import pyarrow.types as A

    def numeric(kind) -> bool:
        return A.is_integer(kind) or A.is_floating(kind) or A.is_decimal(kind)

    types = {field.name: field.type for field in schema}
    absent = [name for name in (*C.FRAME_KEYS, *C.FRAME_INPUT_COLUMNS) if name not in types]
    if absent:
        return f"missing required columns: {', '.join(absent)}"
    for name in ("episode_index", "frame_index", "index"):
        kind = types[name]
        if not (A.is_integer(kind) or A.is_decimal(kind) and kind.scale == 0):
            return f"{name} must be an integer, found {kind}"
    if not numeric(types["timestamp"]):
        return "timestamp must be numeric"
    for name in C.FRAME_INPUT_COLUMNS:
        kind = types[name]
        if not (A.is_list(kind) or A.is_large_list(kind) or A.is_fixed_size_list(kind)):
            return f"{name} must be a list"
        if not numeric(kind.value_type):
            return f"{name} must hold numbers"
    return None


def frame_file_faults(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, rows, fault`` of every Parquet file: its own footer against the frame contract, ``fault`` null
    where it holds. Footers are read by many tasks; no row is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch["path"]:
                system, inner = fs.FileSystem.from_uri(arrow_uri(path))
                try:
                    with system.open_input_file(inner) as file:
                        footer = pq.ParquetFile(file)
                        found.append((footer.metadata.num_rows, _file_fault(footer.schema_arrow)))
                except pa.ArrowInvalid:
                    found.append((None, "not a Parquet file"))
            rows = pd.array([n for n, _ in found], dtype="Int64")
            yield batch.assign(rows=rows, fault=[fault for _, fault in found])

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    names = reader.load(list(paths)).select("path").repartition("path")
    return names.mapInPandas(run, "path string, rows bigint, fault string")


def check_frame_files(spark: SparkSession, *paths: str) -> None:
    """Refuse a set of files of which any does not meet the contract, by name. The scan would take one file's
    schema for all of them, and read what others lack as nulls."""
    faulty = frame_file_faults(spark, *paths).where(F.col("fault").isNotNull())
    row = faulty.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("path", "fault")).alias("first")).first()
    if row["n"]:
        more = f" and {row['n'] - 1} more" if row["n"] > 1 else ""
        raise FrameSchemaError(f"{row['first']['path']}: {row['first']['fault']}{more}")


def dataset_root(spark: SparkSession, root: str) -> str:
    """``<root>/data`` when it exists, so that tables under ``meta/`` are never taken for frames."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    data = jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/data")
    return data.toString() if data.getFileSystem(conf).exists(data) else root


def read_frames(spark: SparkSession, *sources: str) -> DataFrame:
    """Frame rows with ``source_uri`` and the 0-based ``source_row`` inside each file.

    Each source is a Parquet file or a folder searched recursively; every file meets the frame contract, or
    all are refused. Only keys and the two vectors are read. A file reached through two sources is read once.
    """
    if not sources:
        raise ValueError("at least one source is required")
    paths = list(dict.fromkeys(_source_path(spark, source) for source in sources))
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    folders = [p for p in paths if not p.endswith(".parquet")]
    inner = [p for p in paths if not any(p != f and p.startswith(f.rstrip("/") + "/") for f in folders)]
    check_frame_files(spark, *inner)
    table = reader.parquet(*inner)
    check_frame_schema(table.schema)
    vectors = [
        F.col(f"`{name}`").cast("array<double>").alias(alias)
        for name, alias in C.FRAME_INPUT_COLUMNS.items()
    ]
    return table.select(
        F.col("_metadata.file_path").alias("source_uri"),
        F.col("_metadata.row_index").alias("source_row"),
        *(F.col(name).cast("bigint").alias(name) for name in C.FRAME_KEYS[:3]),
        F.col("timestamp").cast("double").alias("timestamp"),
        *vectors,
    )


def _source_path(spark: SparkSession, source: str) -> str:
    if source.endswith(".parquet"):
        return source
    if source.endswith((".json", ".csv", ".txt")):
        raise FrameSchemaError(f"source is not a .parquet file: {source}")
    return dataset_root(spark, source)


def feature_contract(spark: SparkSession, info_path: str | None, info_uri: str | None = None) -> dict:
    """Check shape and ordered names of both vectors in ``info.json`` before any derivation.

    Without a file the layout is assumed, and said to be so. The file is one small JSON object; only
    its verdict reaches the driver.
    """
    expected = {column: list(names) for column, names in C.FEATURE_NAMES.items()}
    if info_path is None:
        if info_uri is not None:
            raise ValueError("an info URI needs an info path")
        return {"status": "assumed_layout", "expected_names": expected}
    text = spark.read.text(info_path, wholetext=True)
    checks = []
    for column, names in expected.items():
        feature = f"$.features['{column}']"
        shape = F.from_json(F.get_json_object("value", f"{feature}.shape"), "array<bigint>")
        found = F.from_json(F.get_json_object("value", f"{feature}.names"), "array<string>")
        wanted = F.array(*(F.lit(name) for name in names))
        checks.append(shape.eqNullSafe(F.array(F.lit(C.VECTOR_LENGTH).cast("bigint"))).alias(f"{column}|shape"))
        checks.append(found.eqNullSafe(wanted).alias(f"{column}|names"))
    row = text.select(
        *checks,
        F.get_json_object("value", "$.codebase_version").alias("version"),
        F.sha2(F.col("value"), 256).alias("sha256"),
        F.col("_metadata.file_path").alias("uri"),
    ).first()
    if row is None:
        raise FrameSchemaError(f"{info_path} is empty")
    bad = [name for name in row.asDict() if "|" in name and not row[name]]
    if bad:
        raise FrameSchemaError(f"{info_path}: feature contract differs: {', '.join(bad)}")
    return {
        "status": "verified_info_json",
        "uri": info_uri or row["uri"],
        "sha256": row["sha256"],
        "codebase_version": row["version"],
        "expected_names": expected,
    }


def contract_json(contract: dict) -> str:
    return json.dumps(contract, sort_keys=True)
