"""The skew-safe helpers against brute force, with one group holding most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from posefold.operators import accounting, scale


def skewed(n=3000, seed=5):
    rng = random.Random(seed)
    return [(rng.choice("aaaaaabc"), rng.randrange(200), i) for i in range(n)]


@pytest.mark.parametrize("limit", [scale.BROADCAST_ROW_LIMIT, 0])
def test_ordinals_match_sorting(spark, monkeypatch, limit):
    monkeypatch.setattr(scale, "lookup_join", _with_limit(scale.lookup_join, limit))
    rows = skewed() + [(None, 4, -1), (None, 2, -2)]
    df = spark.createDataFrame(rows, "g string, t int, s int").repartition(7)
    found = {r["s"]: r["o"] for r in scale.ordinal_within(df, ["g"], ["t", "s"], "o").collect()}
    expected = {}
    for group in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))
        expected |= {r[2]: i for i, r in enumerate(members)}
    assert found == expected


def _with_limit(function, limit):
    def call(*args, **kwargs):
        return function(*args, **(kwargs | {"limit": limit}))

    return call


def test_ordinals_of_identical_rows_are_distinct(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 1)] * 3, "g string, t int").repartition(5)
    rows = scale.ordinal_within(df, ["g"], ["t"], "o").groupBy("g").agg(F.sort_array(F.collect_list("o")).alias("o"))
    assert {r["g"]: r["o"] for r in rows.collect()} == {"a": list(range(500)), "b": [0, 1, 2]}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [100, 0])
@pytest.mark.parametrize("derived", [False, True])
def test_lookup_join_both_ways(spark, how, limit, derived):
    fact = spark.createDataFrame(skewed(), "g string, t int, s int").repartition(3)
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "g string, v int")
    rows = scale.lookup_join(fact, dim, ["g"], how, limit=limit, salts=4, derived=derived).collect()
    expected = {s: {"a": 1, "b": 2}.get(g) for g, _, s in skewed() if how == "left" or g != "c"}
    assert {r["s"]: r["v"] for r in rows} == expected and len(rows) == len(expected)


@pytest.mark.parametrize("k", [1, 5])
def test_first_rows_per_key(spark, k):
    df = spark.createDataFrame(skewed(), "g string, t int, s int").repartition(6)
    found = sorted(map(tuple, scale.first_rows_per_key(df, ["g"], ["t", "s"], k, salts=3).select("g", "t", "s").collect()))
    expected = []
    for group in "abc":
        expected += sorted((r for r in skewed() if r[0] == group), key=lambda r: (r[1], r[2]))[:k]
    assert found == sorted(expected)


def test_key_counts_never_multiply(spark):
    left = spark.createDataFrame([("k", 1)] * 1000 + [("l", 2)], "k string, v int")
    right = spark.createDataFrame([("k", 1)] * 1000 + [("r", 3), ("k", 9)], "k string, v int")
    rows = {r["k"]: r for r in scale.key_counts(left, right, ["k"], ["v"]).collect()}
    assert (rows["k"]["n_left"], rows["k"]["n_right"]) == (1000, 1001)
    assert (rows["k"]["l_max"]["v"], rows["k"]["r_max"]["v"]) == (1, 9)
    assert (rows["l"]["n_right"], rows["r"]["n_left"]) == (0, 0)


def test_quantiles_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaaab"), round(rng.random(), 2)) for _ in range(2000)]
    df = spark.createDataFrame(rows + [("a", None)], "g string, v double").repartition(5)
    found = accounting.residual_quantiles(df, "v", ["g"], (0.0, 0.5, 0.99, 1.0)).collect()
    for row in found:
        values = sorted(v for g, v in rows if g == row["g"])
        rank = max(1, -int(-row["probability"] * len(values) // 1))
        assert row["value"] == values[rank - 1]
    assert len(found) == 8


def test_hold_keeps_values_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    held = scale.hold(df, ["v"])
    assert held.where("v IS NULL").count() == 1 and held.where("v > 0").count() == 1


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        scale.checkpoint_root(Session())
    Session.conf.get = staticmethod(lambda key, default: "/shared")
    assert scale.checkpoint_root(Session()) == "/shared"


def test_quantiles_over_many_blocks(spark):
    rows = [("a" if i % 5 else "b", float(i * 7 % 900), 1 + i % 3) for i in range(900)]
    counts = spark.createDataFrame(rows, "g string, v double, n long")
    got = accounting._running_totals(counts, ["g"], "v", block=4).collect()
    for row in got:
        assert row["before"] == sum(n for g, v, n in rows if g == row["g"] and v < row["v"])
    assert len(got) == 900


def test_tidy_removes_what_was_staged(spark):
    from pathlib import Path

    with scale.tidy(spark):
        held = scale.cut_lineage(spark.range(5), "kept")
        folder = Path(held.inputFiles()[0].removeprefix("file://")).parent
        assert held.count() == 5 and folder.exists()
    assert not folder.exists()


def test_scan_of_few_filled_splits_is_spread(spark):
    """Rows in one of many splits, as those of a single row group: no split keeps more than its share."""
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(4000, numPartitions=1).withColumn("k", F.lit(None).cast("string"))
    rows = one.unionByName(spark.range(0, numPartitions=cores).withColumn("k", F.lit("x")))
    spread = scale.spread_small_scan(rows)
    part = F.spark_partition_id()
    assert spread.groupBy(part.alias("p")).count().agg(F.max("count")).first()[0] < 2 * 4000 / cores
    assert sorted(r.id for r in spread.collect()) == list(range(4000))
    assert scale.spread_small_scan(spark.range(0)).count() == 0
