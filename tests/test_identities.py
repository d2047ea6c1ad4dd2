"""Linked identities and linked cohorts against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.operators import cohorts, gates, identities
from posefold.plans import jobs
from tests.build import JOINTS, message, messages

SCHEMA = "path string, source_uri string, sha256 string"


def groups_of(rows, names=(0, 1, 2)):
    """Sets of rows that hang together through shared values, by brute force."""
    rows = sorted(set(rows), key=str)
    label = list(range(len(rows)))
    for i, a in enumerate(rows):
        for j in range(i):
            if any(a[k] is not None and a[k] == rows[j][k] for k in names):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    found = {}
    for row, x in zip(rows, label):
        found.setdefault(x, set()).add(row)
    return sorted((sorted(g, key=str) for g in found.values() if len(g) > 1), key=str)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_components_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(f"p{rng.randrange(60)}", f"u{rng.randrange(90)}", f"s{rng.randrange(200)}") for _ in range(50)]
    rows += [(None, "u1", None), (None, None, None), ("own", "own", "own"), rows[0]]
    got = {}
    for r in identities.tangled_groups(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["identity_group"], set()).add(tuple(r)[:3])
    assert sorted((sorted(g, key=str) for g in got.values()), key=str) == groups_of(rows)


def test_a_long_chain_and_a_hub(spark):
    chain = [(f"n{i:04}", f"n{i + 1:04}") for i in range(300)]
    random.Random(1).shuffle(chain)
    hub = [("zhub", f"z{i:04}") for i in range(300)]
    edges = spark.createDataFrame(chain + hub + [("x", "x"), ("n0000", "n0001")], "a string, b string")
    found = {r["node"]: r["component"] for r in identities.components(edges).collect()}
    assert len(found) == 301 + 301 and {c for n, c in found.items() if n[0] == "n"} == {"n0000"}
    assert {c for n, c in found.items() if n[0] == "z"} == {"z0000"}
    assert identities.components(edges.limit(0)).count() == 0


def test_a_refusal_names_the_whole_group(spark, tmp_path):
    rows = [(f"data/val/task_t/episode_{i}/e.mcap", f"fx://{i // 2 if i < 4 else i}", "ab" * 32, 5) for i in range(6)]
    rows[2] = (rows[2][0], "fx://0", *rows[2][2:])
    sources = spark.createDataFrame(rows, "path string, source_uri string, sha256 string, size_bytes long")
    plain = messages(spark, [message("/left-arm-state", [], JOINTS, n=i, source=f"fx://{i}") for i in (0, 1, 4, 5)])
    with pytest.raises(gates.Refused, match="3 rows hang together.*episode_0.*episode_1.*episode_2.*1 groups in all"):
        jobs.run_recovery(plain, sources, str(tmp_path / "out"), require_untangled=True)
    with pytest.raises(gates.Refused, match="source_uri_is_unique"):
        jobs.run_recovery(plain, sources, str(tmp_path / "out"))
    identities.require_untangled(sources.where("source_uri IN ('fx://4', 'fx://5')"))


def offsets(spark, means):
    rows = [(f"f{i}", 10 if m is not None else 0, *((m or (None,) * 3))) for i, m in enumerate(means)]
    schema = "source_uri string, offset_count long, offset_mean_x double, offset_mean_y double, offset_mean_z double"
    return cohorts.assign_cohorts(spark.createDataFrame(rows, schema))


def test_means_on_both_sides_of_an_edge(spark):
    means = [(0.0, -0.6049, 0.0), (0.0, -0.6051, 0.0), (0.0, -0.8, 0.0), (0.0049, -0.6051, 0.0051), (0.0, -0.614, 0.0), None, (0.0, -0.5999, 0.0)]
    assigned = offsets(spark, means)
    assert assigned.select(*cohorts.COHORT).where("cohort_y IS NOT NULL").distinct().count() == 4
    rig = {r["source_uri"]: r["rig"] for r in cohorts.with_linked_cohort(assigned).collect()}
    assert rig["f0"] == rig["f1"] == rig["f4"] == rig["f6"] != rig["f2"] and rig["f5"] is None
    assert rig["f3"] != rig["f1"]  # 5 mm away
    wide = {r["source_uri"]: r["rig"] for r in cohorts.with_linked_cohort(assigned, gap=0.006).collect()}
    assert wide["f3"] == wide["f1"]
    table = cohorts.linked_cohorts(assigned).collect()
    assert sum(r["files"] for r in table) == len(means) and max(r["cohorts"] for r in table) == 2
    with pytest.raises(ValueError):
        cohorts.with_linked_cohort(assigned, gap=1.0)
    assert C.COHORT_DECIMALS == 2 and {f"cohort_{a}" for a in "xyz"} <= set(cohorts.with_linked_cohort(assigned).columns)


def test_cells_against_brute_force(spark):
    rng = random.Random(4)
    means = [(rng.uniform(0, 0.05), rng.uniform(-0.65, -0.6), rng.uniform(0, 0.03)) for _ in range(60)]
    assigned = offsets(spark, means)
    rows = [r.asDict() for r in cohorts.with_linked_cohort(assigned).collect()]
    cells = {}
    for r in rows:
        cells.setdefault(tuple(round(r[f"cohort_{a}"] * 100) for a in "xyz"), []).append([r[f"offset_mean_{a}"] for a in "xyz"])
    names, label = list(cells), list(range(len(cells)))
    for i, a in enumerate(names):
        for j in range(i):
            b = names[j]
            gaps = [max(min(v[k] for v in cells[b]) - max(v[k] for v in cells[a]), min(v[k] for v in cells[a]) - max(v[k] for v in cells[b])) for k in range(3)]
            if max(abs(x - y) for x, y in zip(a, b)) <= 1 and max(gaps) <= cohorts.LINK_GAP_M:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    want = {}
    for name, x in zip(names, label):
        want.setdefault(x, set()).add(name)
    got = {}
    for r in rows:
        got.setdefault(r["rig"], set()).add(tuple(round(r[f"cohort_{a}"] * 100) for a in "xyz"))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 1
    assert assigned.where(F.col("cohort_x").isNull()).count() == 0
