import json
import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from build import derive
from posefold import contracts as C
from posefold.functions.kinematics import FunctionKinematics
from posefold.operators import augment, gates
from posefold.plans import jobs
from posefold.sources import frames as source
from posefold.sources import sinks

STATE = [round(0.05 * i, 3) for i in range(14)]
ACTION = [round(-0.04 * i, 3) for i in range(14)]
SCHEMA = (
    "source_uri string, source_row long, episode_index long, frame_index long, index long,"
    " timestamp double, state array<double>, action array<double>"
)


def table(spark, pairs):
    return spark.createDataFrame([("f", i, 1, i, i, i / 30, s, a) for i, (s, a) in enumerate(pairs)], SCHEMA)


def at(vector, index, value):
    return vector[:index] + [value] + vector[index + 1 :]


@pytest.mark.parametrize("state, action, valid, invalid", [
    (STATE, ACTION, 0b1111, 0),
    (STATE, at(ACTION, 9, math.nan), 0b0111, 0b1000),
    (at(STATE, 6, math.nan), at(ACTION, 13, math.inf), 0b1111, 0),
    (STATE[:13], ACTION, 0b1100, 0b0011),
    (STATE, None, 0b0011, 0b1100),
    (at(STATE, 0, None), ACTION, 0b1110, 0b0001),
    ([], STATE + [0.0], 0, 0b1111),
])
def test_masks(spark, state, action, valid, invalid):
    df = table(spark, [(state, action)])
    row = augment.augment_frames(df).first()
    assert (row["valid_mask"], row["invalid_input_mask"], row["derivation_failure_mask"]) == (valid, invalid, 0)
    cheap = augment.frame_masks(df).first()
    assert (cheap["valid_mask"], cheap["invalid_input_mask"]) == (valid, invalid)
    for limb in C.LIMBS:
        assert (row[limb.pose] is not None) == bool(valid >> limb.bit & 1)
    if valid & 8:
        expected = derive(ACTION[7:13])
        assert row["action_right_arm_pose"][:3] == pytest.approx([expected[3], expected[7], expected[11]], abs=1e-14)


def test_failing_right_arm(spark):
    def left_only(joints, arms):
        import numpy as np

        if (arms == "right").any():
            raise RuntimeError("right base unknown")
        return np.array([[0, 0, 0, 1.0, 0, 0, 0]] * len(joints))

    row = augment.augment_frames(table(spark, [(STATE, ACTION)]), kinematics=FunctionKinematics(left_only)).first()
    assert (row["valid_mask"], row["derivation_failure_mask"]) == (0b0101, 0b1010)
    counts = {r["limb"]: r["derivation_failure"] for r in augment.mask_bit_counts(
        augment.augment_frames(table(spark, [(STATE, ACTION)] * 3), kinematics=FunctionKinematics(left_only))).collect()}
    assert counts == {"observation.left_arm": 0, "observation.right_arm": 3, "action.left_arm": 0, "action.right_arm": 3}


def test_key_violations(spark):
    df = table(spark, [(STATE, ACTION)] * 4).withColumns({
        "index": F.expr("IF(source_row = 0, NULL, index)"),
        "timestamp": F.expr("IF(source_row = 1, double('NaN'), timestamp)"),
    })
    row = augment.key_violations(df).first()
    assert (row["rows"], row["null_index"], row["null_episode_index"], row["bad_timestamp"]) == (4, 1, 0, 1)


def test_key_integrity_counts_each_fault(spark):
    df = table(spark, [(STATE, ACTION)] * 6)
    keys = df.select("source_uri", "source_row", *C.FRAME_KEYS)
    same = augment.key_integrity(keys, keys).first()
    assert tuple(same)[1:] == (6, 6, 0, 0, 0, 0)
    faulty = keys.where("source_row > 0").unionByName(keys.where("source_row = 2")).withColumns({
        "frame_index": F.expr("IF(source_row = 3, 99, frame_index)"),
        "source_row": F.expr("IF(source_row = 4, 44, source_row)"),
    })
    row = augment.key_integrity(keys, faulty).first()
    assert (row["duplicate_keys"], row["orphan_keys"], row["missing_keys"], row["reordered_keys"]) == (1, 1, 2, 1)


def write_frames(path, rows=4, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    vector = pa.list_(pa.float32(), 14)
    data = {
        "episode_index": pa.array([1] * rows, pa.int64()),
        "frame_index": pa.array(range(rows), pa.int64()),
        "index": pa.array(range(rows), pa.int64()),
        "timestamp": pa.array([i / 30 for i in range(rows)], pa.float32()),
        "observation.state": pa.array([STATE] * rows, vector),
        "action": pa.array([ACTION] * rows, vector),
        "unrelated": pa.array(["x"] * rows),
    } | columns
    pq.write_table(pa.table({k: v for k, v in data.items() if v is not None}), path)


def info_json(path, **changes):
    features = {name: {"shape": [14], "names": list(names)} for name, names in C.FEATURE_NAMES.items()}
    features["action"] |= changes
    path.write_text(json.dumps({"codebase_version": "v3.0", "features": features}))
    return str(path)


@pytest.mark.parametrize("columns, message", [
    ({"action": None}, "missing"),
    ({"index": pa.array([0.5] * 4)}, "integer"),
    ({"timestamp": pa.array(["0"] * 4)}, "numeric"),
    ({"action": pa.array([["a"]] * 4)}, "numbers"),
    ({"action": pa.array([1.0] * 4)}, "list"),
])
def test_schema_refusals(spark, tmp_path, columns, message):
    write_frames(tmp_path / "a.parquet", **columns)
    with pytest.raises(source.FrameSchemaError, match=message):
        source.read_frames(spark, str(tmp_path / "a.parquet"))


def test_feature_contract(spark, tmp_path):
    assert source.feature_contract(spark, None)["status"] == "assumed_layout"
    good = source.feature_contract(spark, info_json(tmp_path / "info.json"), "hf://x/info.json")
    assert (good["status"], good["uri"], good["codebase_version"]) == ("verified_info_json", "hf://x/info.json", "v3.0")
    import hashlib

    assert good["sha256"] == hashlib.sha256((tmp_path / "info.json").read_bytes()).hexdigest()
    names = list(C.FEATURE_NAMES["action"])
    for changes in ({"shape": [13]}, {"names": names[::-1]}, {"names": None}):
        with pytest.raises(source.FrameSchemaError):
            source.feature_contract(spark, info_json(tmp_path / "bad.json", **changes))
    with pytest.raises(ValueError):
        source.feature_contract(spark, None, "hf://x")


def test_dataset_root_skips_meta_and_numbers_rows_per_file(spark, tmp_path):
    write_frames(tmp_path / "ds/data/chunk-000/file-000.parquet")
    write_frames(tmp_path / "ds/data/chunk-000/file-001.parquet", rows=2)
    (tmp_path / "ds/meta").mkdir()
    pq.write_table(pa.table({"other": [1]}), tmp_path / "ds/meta/episodes.parquet")
    twice = source.read_frames(spark, str(tmp_path / "ds"), str(tmp_path / "ds/data/chunk-000/file-000.parquet"))
    rows = twice.groupBy("source_uri").agg(F.sort_array(F.collect_list("source_row")).alias("r")).collect()
    assert sorted(r["r"] for r in rows) == [[0, 1], [0, 1, 2, 3]]


def test_augmentation_job(spark, tmp_path):
    write_frames(tmp_path / "ds/data/a.parquet", rows=5)
    out = str(tmp_path / "out")
    manifest = jobs.run_augmentation(spark, [str(tmp_path / "ds")], out, info_path=info_json(tmp_path / "info.json"))
    rows = sinks.read_published(spark, out)
    assert rows.columns == list(C.SIDECAR_COLUMNS.values()) and rows.count() == manifest["rows"] == 5
    row = rows.first()
    import hashlib

    digest = hashlib.sha256((tmp_path / "ds/data/a.parquet").read_bytes()).hexdigest()
    assert row["provenance.source_sha256"] == digest
    facts = rows.schema["action.left_arm.pose.arm_local"].metadata
    assert facts["frame"] == "arm_local" and json.loads(facts["layout"]) == list(C.POSE_LAYOUT)
    assert json.loads(manifest["details"])["feature_contract"]["status"] == "verified_info_json"
    with pytest.raises(FileExistsError):
        jobs.run_augmentation(spark, [str(tmp_path / "ds")], out)
    jobs.run_augmentation(spark, [str(tmp_path / "ds")], out, overwrite=True)
    with pytest.raises(ValueError):
        jobs.run_augmentation(spark, [str(tmp_path / "ds")], str(tmp_path / "ds/out"))


def test_null_key_refuses_and_publishes_nothing(spark, tmp_path):
    write_frames(tmp_path / "a.parquet", index=pa.array([0, None, 2, 3], pa.int64()))
    with pytest.raises(gates.Refused, match="frame_keys"):
        jobs.run_augmentation(spark, [str(tmp_path / "a.parquet")], str(tmp_path / "out"))
    with pytest.raises(gates.Refused, match="no manifest"):
        sinks.read_published(spark, str(tmp_path / "out"))


def test_tampered_part_is_refused(spark, tmp_path):
    write_frames(tmp_path / "a.parquet")
    out = str(tmp_path / "out")
    manifest = jobs.run_augmentation(spark, [str(tmp_path / "a.parquet")], out)
    from pathlib import Path

    data = Path(manifest["data_uri"].removeprefix("file:"))
    write_frames(data / "part-extra.parquet")
    with pytest.raises(gates.Refused, match="part files differ"):
        sinks.read_published(spark, out)


def test_source_changed_during_the_run_is_refused(spark, tmp_path, monkeypatch):
    write_frames(tmp_path / "a.parquet")
    original = sinks.publish

    def meddle(*args, **kwargs):
        write_frames(tmp_path / "a.parquet", unrelated=pa.array(["changed"] * 4))
        return original(*args, **kwargs)

    monkeypatch.setattr(sinks, "publish", meddle)
    with pytest.raises(gates.Refused, match="sources_unchanged"):
        jobs.run_augmentation(spark, [str(tmp_path / "a.parquet")], str(tmp_path / "out"))
    with pytest.raises(gates.Refused, match="no manifest"):
        sinks.read_published(spark, str(tmp_path / "out"))


@pytest.mark.parametrize("odd, fault", [
    ({"drop": ["action"]}, "missing required columns: action"),
    ({"text": "observation.state"}, "observation.state must hold numbers"),
    ({"float": "episode_index"}, "episode_index must be an integer"),
])
def test_every_file_of_a_folder_is_checked(spark, tmp_path, odd, fault):
    """One of several files does not meet the contract: all are refused and that one is named, whichever Spark looks at."""
    folder = tmp_path / "ds/data"
    for i in range(6):
        write_frames(folder / f"file-{i}.parquet")
    path = folder / "file-3.parquet"
    table = pq.read_table(path)
    if "drop" in odd:
        table = table.drop_columns(odd["drop"])
    for name, kind in ((odd.get("text"), pa.list_(pa.string())), (odd.get("float"), pa.float64())):
        if name:
            at = table.schema.get_field_index(name)
            column = table.column(name)
            values = [[str(v) for v in row] if row is not None else None for row in column.to_pylist()] if "text" in odd else column.to_pylist()
            table = table.set_column(at, name, pa.array(values, kind))
    pq.write_table(table, path)
    with pytest.raises(source.FrameSchemaError, match=f"file-3.parquet: {fault}"):
        source.read_frames(spark, str(tmp_path / "ds"))
    with pytest.raises(source.FrameSchemaError, match="file-3.parquet"):
        jobs.run_augmentation(spark, [str(tmp_path / "ds")], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    (folder / "file-5.parquet").write_bytes(b"no table")
    with pytest.raises(source.FrameSchemaError, match="and 1 more"):
        source.read_frames(spark, str(tmp_path / "ds"))
