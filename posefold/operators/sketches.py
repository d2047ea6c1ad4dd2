"""Residual quantiles from the KLL sketches in stored topic rows: topic to file to corpus, no message read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.operators.audit import RESIDUALS

SKETCH_K = 800
#: The rank of an estimate is off by less than this share of the rows. For ``SKETCH_K`` the sketch's own figure
#: (99 % of estimates) is 0.0038; this is over three times that, so that no estimate of many is outside.
RANK_ERROR = 0.0133


def merged_sketches(topics: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group of ``keys``: the sketches of its topic rows merged, with map-side partial merges."""
    merged = [F.kll_merge_agg_double(f"{name}_sketch").alias(f"{name}_sketch") for name in RESIDUALS]
    return topics.groupBy(*keys).agg(*merged)


def sketch_quantiles(topics: DataFrame, residual: str, keys: list[str], probabilities: tuple[float, ...]) -> DataFrame:
    """``keys, probability, value, total`` per group that has values, like the exact quantiles."""
    name = f"{residual}_sketch"
    present = topics.where(F.col(name).isNotNull() & (F.kll_sketch_get_n_double(name) > 0))
    merged = present.groupBy(*keys).agg(F.kll_merge_agg_double(name).alias("sketch"))
    probes = F.array(*(F.lit(float(p)) for p in probabilities))
    values = F.arrays_zip(
        probes.alias("probability"), F.kll_sketch_get_quantile_double("sketch", probes).alias("value")
    )
    found = merged.select(*keys, F.kll_sketch_get_n_double("sketch").alias("total"), F.explode(values).alias("e"))
    return found.select(*keys, "e.probability", "e.value", "total")


def rank_errors(estimates: DataFrame, rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """How far the rank of each estimate is from its probability, by counting ``rows``: a check, not a path.

    An estimate that several rows equal covers all their ranks. There are few estimates per group, so
    they are put into an array beside every row and counted in one partial-aggregated pass.
    """
    wanted = estimates.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("probability", "value"))).alias("wanted"))
    present = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    same = [F.col(f"_of_{k}").eqNullSafe(F.col(k)) for k in keys]
    renamed = wanted.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    joined = present.join(F.broadcast(renamed), same, "inner") if keys else present.crossJoin(F.broadcast(renamed))
    each = joined.select(*keys, "_v", F.explode("wanted").alias("e"))
    counted = each.groupBy(*keys, F.col("e.probability").alias("probability"), F.col("e.value").alias("value")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_v") < F.col("e.value")).alias("below"),
        F.count_if(F.col("_v") <= F.col("e.value")).alias("upto"),
    )
    off = F.greatest(
        F.lit(0.0),
        F.col("below") / F.col("total") - F.col("probability"),
        F.col("probability") - F.col("upto") / F.col("total"),
    )
    return counted.select(*keys, "probability", "value", "total", off.alias("rank_error"))
