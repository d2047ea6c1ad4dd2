"""Sinks: self-describing sidecars, audit tables and the manifest that is written last.

A publication is a folder: ``data-<run>/`` holds the rows, ``parts-<run>/`` the digest of every data
file, further tables of the run lie beside them, and ``manifest/`` has one JSON line per run. That line
carries the counts and names the tables; it is written after everything else, so a crash before it
leaves files no reader will accept, and one after it leaves nothing undone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from posefold import __version__
from posefold import contracts as C
from posefold.operators.gates import (
    Refused,
    digest_columns,
    gate,
    require,
)
from posefold.operators.scale import key_counts
from posefold.sources.files import RANGE_BYTES, digest_tree, folded, proof_of, range_digests, tree_root

MANIFEST = (
    "run_id string, schema_version string, created_at string, data_uri string, parts_uri string,"
    " rows bigint, content_digest string, part_files bigint, details string"
)


def describe_columns(df: DataFrame, columns: Mapping[str, str], model: Mapping[str, str | None]) -> DataFrame:
    """Rename to contract names and attach layout, frame, units and mask bits as column metadata."""
    described = []
    for name, published in columns.items():
        facts: dict[str, str] = {}
        if published.endswith("arm_local"):
            facts = {
                "layout": json.dumps(C.POSE_LAYOUT),
                "frame": "arm_local",
                "site": "grasp_site",
                "units": "metres, unit quaternion",
                "quaternion": "Hamilton scalar-first (wxyz)",
                "shared_bimanual_transform_emitted": "false",
                **{key: value or "" for key, value in model.items()},
            }
        elif published == "geometry.status_mask":
            facts = {"bits": json.dumps(dict(C.RECOVERY_BITS), sort_keys=True)}
        elif published.endswith("_mask"):
            facts = {"bits": json.dumps(dict(C.LIMB_BITS), sort_keys=True)}
        elif published.endswith("_ns"):
            facts = {"units": "nanoseconds", "range": f"0..{C.UINT64_MAX}"}
        described.append(F.col(name).alias(published, metadata=facts))
    return df.select(*described)


def model_facts(kinematics) -> dict[str, str | None]:
    return {
        "kinematics_model": kinematics.model_name,
        "kinematics_model_sha256": kinematics.model_digest,
        "kinematics_model_revision": kinematics.model_revision,
    }


def check_output(output: str, inputs: list[str]) -> None:
    """Refuse an output inside, equal to or above an input."""
    def plain(path: str) -> str:
        return path.removeprefix("file://").rstrip("/") + "/"

    for source in inputs:
        a, b = plain(output), plain(source)
        if a.startswith(b) or b.startswith(a):
            raise ValueError(f"output {output} overlaps input {source}")


def publish(
    rows: DataFrame,
    output: str,
    schema_version: str,
    expected_rows: int,
    details: Mapping,
    overwrite: bool = False,
    measures: Mapping[str, Column] | None = None,
    checks: Callable[[dict], list[str]] | None = None,
    tables: Callable[[dict, DataFrame], Mapping[str, DataFrame]] | None = None,
    before_manifest: Callable[[], None] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> dict:
    """Write ``rows``, prove what was written, and only then write the manifest line.

    Row count, content digest and ``measures`` (aggregates over ``rows``) are observed by the write itself;
    the written files are read once more, to hash them. ``checks(measured)`` names what does not hold.
    ``tables(measured, staged)`` are written beside the data; the manifest names them, so whoever finds its
    line finds them too. ``before_manifest()`` runs last of all, e.g. to prove that the sources did not
    change. Whatever raises :class:`Refused` leaves rows that :func:`read_published` does not see.
    """
    spark = rows.sparkSession
    previous = read_manifests(spark, output)
    if previous is not None and not overwrite:
        raise FileExistsError(f"{output} already holds a publication; pass overwrite=True")
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    root = output.rstrip("/")
    data, parts = f"{root}/data-{run_id}", f"{root}/parts-{run_id}"
    seen = Observation()
    observed = rows.observe(seen, *digest_columns(rows), *(c.alias(n) for n, c in (measures or {}).items()))
    observed.write.option("compression", "zstd").parquet(data)
    measured = seen.get

    staged = spark.read.parquet(data)
    if [(f.name, f.dataType, f.metadata) for f in staged.schema] != [(f.name, f.dataType, f.metadata) for f in rows.schema]:
        raise Refused("staged schema differs from the contract")
    if measured["rows"] != expected_rows:
        raise Refused(f"staged_row_count: {measured['rows']} rows, expected {expected_rows}")
    if failed := checks(measured) if checks is not None else []:
        raise Refused("; ".join(failed))

    beside = dict(tables(measured, staged)) if tables is not None else {}
    for name, table in beside.items():
        table.write.parquet(f"{root}/{name}-{run_id}")
    relative_parts(range_digests(spark, data, glob="*.parquet", range_bytes=range_bytes)).write.parquet(parts)
    recorded = spark.read.parquet(parts)
    part_files = recorded.select("part").distinct().count()
    root_digest = tree_root(digest_tree(recorded, list(PART_ORDER)))
    if before_manifest is not None:
        before_manifest()
    manifest = {
        "run_id": run_id,
        "schema_version": schema_version,
        "created_at": datetime.now(timezone.utc).isoformat(),
        "data_uri": data,
        "parts_uri": parts,
        "rows": expected_rows,
        "content_digest": measured["digest"],
        "part_files": part_files,
        "details": json.dumps(
            {
                "generator": f"posefold/{__version__}",
                "counts": {name: measured[name] for name in measures or {}},
                "tables": {name: f"{root}/{name}-{run_id}" for name in beside},
                "parts_root": root_digest,
                "range_bytes": range_bytes,
                **details,
            },
            sort_keys=True,
        ),
    }
    line = spark.createDataFrame([manifest], MANIFEST)
    line.coalesce(1).write.mode("append").json(f"{root}/manifest")
    return manifest


def read_beside(spark: SparkSession, output: str, name: str) -> DataFrame:
    """A table that the newest manifest names."""
    tables = json.loads(latest_manifest(spark, output)["details"])["tables"]
    if name not in tables:
        raise Refused(f"the newest publication in {output} has no table {name}")
    return spark.read.parquet(tables[name])


PART_ORDER = ("part", "range_no")


def relative_parts(ranges: DataFrame) -> DataFrame:
    """Key part files by name, so a moved publication still verifies."""
    return ranges.select(
        F.element_at(F.split("path", "/"), -1).alias("part"), "range_no", "size_bytes", "sha256"
    )


def read_manifests(spark: SparkSession, output: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{output.rstrip('/')}/manifest")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def latest_manifest(spark: SparkSession, output: str) -> dict:
    manifests = read_manifests(spark, output)
    newest = manifests.orderBy(F.desc("run_id")).first() if manifests is not None else None
    if newest is None:
        raise Refused(f"{output} has no manifest: the publication is incomplete")
    return newest.asDict()


def _range_bytes(manifest: dict) -> int:
    return json.loads(manifest["details"])["range_bytes"]


def differing_ranges(spark: SparkSession, manifest: dict) -> DataFrame:
    """``part, range_no, first_byte`` of every range whose bytes are not those recorded, missing and foreign ones too."""
    width = _range_bytes(manifest)
    found = relative_parts(range_digests(spark, manifest["data_uri"], glob="*.parquet", range_bytes=width))
    counts = key_counts(spark.read.parquet(manifest["parts_uri"]), found, list(PART_ORDER), ["size_bytes", "sha256"])
    bad = ~F.coalesce(F.expr("n_left = 1 AND n_right = 1 AND l_min = r_min"), F.lit(False))
    return counts.where(bad).select(*PART_ORDER, (F.col("range_no") * width).alias("first_byte"))


def verify_parts(spark: SparkSession, manifest: dict) -> DataFrame:
    """One gate row: ranges of the part files on disk against the digests recorded beside the data, and those
    against the root in the manifest. The detail names where the first difference begins."""
    recorded = tree_root(digest_tree(spark.read.parquet(manifest["parts_uri"]), list(PART_ORDER)))
    bad = differing_ranges(spark, manifest)
    where = F.min(F.struct(*PART_ORDER, "first_byte"))
    text = F.concat(
        F.count_distinct("part").cast("string"), F.lit(" part files differ, first "), where["part"], F.lit(" from byte "),
        where["first_byte"].cast("string"),
    )
    whole = gate(bad, "parts_match_manifest", F.count(F.lit(1)) == 0, text)
    same = recorded == json.loads(manifest["details"])["parts_root"]
    return whole.unionByName(gate(bad, "part_digests_match_root", F.lit(same), F.lit("recorded digests lead to another root")))


def part_proof(spark: SparkSession, output: str, part: str, range_no: int = 0) -> tuple[str, list]:
    """The recorded digest of one range and its proof towards the newest manifest's root."""
    levels = digest_tree(spark.read.parquet(latest_manifest(spark, output)["parts_uri"]), list(PART_ORDER))
    row = levels[0].where((F.col("part") == part) & (F.col("range_no") == range_no)).first()
    if row is None:
        raise Refused(f"the newest publication in {output} has no range {range_no} of {part}")
    return row["sha256"], proof_of(levels, row["pos"])


def verify_part(spark: SparkSession, output: str, part: str, proofs: list[tuple[str, list]]) -> bool:
    """Whether one part file is as published, given the proofs of its ranges: no other file is read, only its
    bytes and the manifest's line."""
    manifest = latest_manifest(spark, output)
    found = range_digests(spark, f"{manifest['data_uri']}/{part}", range_bytes=_range_bytes(manifest))
    digests = [r["sha256"] for r in found.orderBy("range_no").select("sha256").collect()]
    root = json.loads(manifest["details"])["parts_root"]
    return len(digests) == len(proofs) and all(folded(d, path) == root for d, (_, path) in zip(digests, proofs))


def read_published(spark: SparkSession, output: str) -> DataFrame:
    """The newest published rows, after every part file's digests were found equal to the record."""
    manifest = latest_manifest(spark, output)
    require(verify_parts(spark, manifest))
    return spark.read.parquet(manifest["data_uri"])


AUDIT_MANIFEST = "run_id string, schema_version string, created_at string, tables array<string>"


class AuditRun:
    """Audit tables of one run. They lie in the run's own folder and are read by others only after
    ``commit`` has written the manifest line; a refused or broken run leaves nothing readable."""

    def __init__(self, spark: SparkSession, output: str):
        self._spark, self._root = spark, output.rstrip("/")
        self.run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self._names: list[str] = []

    def _path(self, name: str) -> str:
        return f"{self._root}/audit-{self.run_id}/{name}"

    def write(self, tables: Mapping[str, DataFrame]) -> None:
        """Write the tables; a statistic that is NaN or infinite refuses the run."""
        for name, table in tables.items():
            table.withColumn("schema_version", F.lit(C.AUDIT_SCHEMA_VERSION)).write.parquet(self._path(name))
            numbers = [f.name for f in table.schema if f.dataType.simpleString() == "double"]
            if numbers:
                bad = F.lit(False)
                for number in numbers:
                    value = F.col(number)
                    bad = bad | F.coalesce(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit(False))
                require(gate(self._spark.read.parquet(self._path(name)), f"{name}_is_finite", F.count_if(bad) == 0))
            self._names.append(name)

    def read(self, name: str) -> DataFrame:
        """A table of this run, before or after its commit."""
        return self._spark.read.parquet(self._path(name)).drop("schema_version")

    def commit(self) -> None:
        line = {
            "run_id": self.run_id,
            "schema_version": C.AUDIT_SCHEMA_VERSION,
            "created_at": datetime.now(timezone.utc).isoformat(),
            "tables": self._names,
        }
        frame = self._spark.createDataFrame([line], AUDIT_MANIFEST)
        frame.coalesce(1).write.mode("append").json(f"{self._root}/audit-manifest")


def write_audit(tables: Mapping[str, DataFrame], output: str) -> None:
    """Write audit tables as one run: all of them become readable, or none."""
    spark = next(iter(tables.values())).sparkSession
    run = AuditRun(spark, output)
    run.write(tables)
    run.commit()


def read_audit(spark: SparkSession, output: str, name: str) -> DataFrame:
    """A table of the newest committed run that has it, refused when another schema version wrote any of
    its rows."""
    from posefold.operators.gates import audit_schema_gate

    root = output.rstrip("/")
    try:
        runs = spark.read.schema(AUDIT_MANIFEST).json(f"{root}/audit-manifest")
        newest = runs.where(F.array_contains("tables", name)).orderBy(F.desc("run_id")).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        newest = None
    if newest is None:
        raise Refused(f"{output} has no committed audit table {name}")
    table = spark.read.parquet(f"{root}/audit-{newest['run_id']}/{name}")
    require(audit_schema_gate(table, C.AUDIT_SCHEMA_VERSION))
    return table.drop("schema_version")


def as_json_lines(table: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return table.select(F.to_json(F.struct("*")).alias("json"))
