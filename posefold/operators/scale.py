"""Helpers that keep joins and ranks safe when one key holds a large share of all rows."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BROADCAST_ROW_LIMIT = 200_000
SALTS = 64
#: Rows of a scan that a task is meant to have.
TASK_ROWS = 250_000
_LOCAL_ROOTS: dict[str, str] = {}
_HELD: list[list[str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="posefold-")
    return _LOCAL_ROOTS[context.applicationId]


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later passes prune columns from it
    and a lost executor never recomputes what lies before it. :func:`tidy` removes such folders."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/posefold-{label}-{uuid.uuid4().hex}"
    for held in _HELD:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tidy(spark: SparkSession):
    """Remove what ``cut_lineage`` has written inside the block. For jobs whose results lie elsewhere."""
    held: list[str] = []
    _HELD.append(held)
    try:
        yield
    finally:
        _HELD.remove(held)
        conf = spark._jsc.hadoopConfiguration()
        for path in held:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Spread a scan whose rows lie in few of its splits, as those of one file or of few row groups do.

    Splits are cut by bytes, and a row group belongs to one of them, however many there are. So rows are counted by split.
    A scan that is dealt evenly, with no more than ``TASK_ROWS`` rows in a split, passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counted = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    rows, most = found["rows"] or 0, found["most"] or 0
    tasks = max(cores, -(-rows // TASK_ROWS))
    if most * tasks <= 2 * rows:
        return df
    return df.repartition(tasks, *df.columns)


def fits_in_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Whether ``df`` has at most ``limit`` rows; the count stops one row past the limit."""
    return df.limit(limit + 1).count() <= limit


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    limit: int = BROADCAST_ROW_LIMIT,
    salts: int = SALTS,
    null_safe: bool = False,
    derived: bool = False,
) -> DataFrame:
    """Join a large table to a per-key table without letting a hot key land in one task.

    A ``dim`` whose size is checked to be small is broadcast, so the fact side is not shuffled at
    all. Otherwise each ``dim`` row is repeated once per salt and fact rows are spread over the
    salts of their key. With ``null_safe`` a null key finds a null key. A ``derived`` dim is the
    short result of a long computation: it is written once before it is counted and joined.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner lookups keep the fact side's rows apart")
    if derived:
        dim = cut_lineage(dim, "lookup")
    if fits_in_broadcast(dim, limit):
        return _equi_join(fact, F.broadcast(dim), on, how, null_safe)
    salted_fact = fact.withColumn("_salt", F.monotonically_increasing_id() % salts)
    salted_dim = dim.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return _equi_join(salted_fact, salted_dim, [*on, "_salt"], how, null_safe).drop("_salt")


def _equi_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str, null_safe: bool
) -> DataFrame:
    if not null_safe:
        return fact.join(dim, on, how)
    renamed = dim.withColumnsRenamed({name: f"_dim_{name}" for name in on})
    same = [F.col(name).eqNullSafe(F.col(f"_dim_{name}")) for name in on]
    return fact.join(renamed, same, how).drop(*(f"_dim_{name}" for name in on))


def ordinal_within(
    df: DataFrame,
    group: list[str],
    order: list[str | Column],
    out: str,
    first: int = 0,
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Number the rows of each group in order, without gathering a group in one task.

    Rows are range-partitioned on (group, order), so a hot group is cut across many tasks. Each row
    keeps its place inside its partition; the rows of the same group in earlier partitions are then
    added from a table with one line per group and partition. Ties fall back to scan position. The
    partitioned rows are written once, so both passes see the same cut.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in (*group, *order)]
    named = [key.alias(f"_k{i}") for i, key in enumerate(keys)]
    tie = F.monotonically_increasing_id().alias("_tie")
    sort_names = [f"_k{i}" for i in range(len(keys))] + ["_tie"]
    sort_keys = [F.col(name) for name in sort_names]
    placed = (
        df.select("*", *named, tie)
        .repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("_place"),
        )
    )
    staged = cut_lineage(placed, "ordinal")
    runs = staged.groupBy(*group, "_part").agg(
        F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    # One line per (group, partition): the window below never sees more lines than partitions.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *group,
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_start") + first).alias("_shift"),
    )
    # A run is never larger than a partition, so there is no hot key to salt.
    numbered = lookup_join(
        staged, shifts, [*group, "_part"], how="inner", limit=limit, salts=1, null_safe=True, derived=True
    )
    return numbered.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(out))


def hold(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep filters on ``columns`` above this point.

    Catalyst moves a filter below a projection by writing the projected expression into it. For a
    value at the end of the kinematic stages that would unfold all of them into one huge expression.
    A column that depends on the partition id cannot be moved; the test itself costs nothing.
    """
    held = {name: F.expr(f"IF(spark_partition_id() >= 0, {name}, NULL)") for name in columns}
    return df.withColumns(held)


def first_rows_per_key(
    df: DataFrame, key: list[str], order: list[str | Column], k: int, salts: int = SALTS
) -> DataFrame:
    """The first ``k`` rows of every key, exactly.

    Each salt of a key keeps its own first ``k`` (Spark limits groups before the shuffle too), then
    at most ``salts * k`` survivors per key compete.
    """
    if k <= 0:
        return df.limit(0)
    salted = df.withColumn("_salt", F.monotonically_increasing_id() % salts)
    local = Window.partitionBy(*key, "_salt").orderBy(*order)
    survivors = salted.withColumn("_rank", F.row_number().over(local)).where(F.col("_rank") <= k)
    final = Window.partitionBy(*key).orderBy(*order)
    return (
        survivors.drop("_salt")
        .withColumn("_rank", F.row_number().over(final))
        .where(F.col("_rank") <= k)
        .drop("_rank")
    )


def key_counts(left: DataFrame, right: DataFrame, keys: list[str], carry: list[str] = ()) -> DataFrame:
    """Per key: how often each side has it, plus each side's smallest ``carry`` struct.

    Both sides are stacked and grouped once with map-side partial sums, so repeated keys never
    multiply into pairs as they would in a join.
    """
    carry = list(carry)

    def tagged(df: DataFrame, side: str) -> DataFrame:
        value = F.struct(*carry) if carry else F.lit(True)
        other = "r" if side == "l" else "l"
        return df.select(
            *keys, F.lit(side).alias("_side"), value.alias(f"{side}_value")
        ).withColumn(f"{other}_value", F.lit(None).cast(_type_of(df, carry)))

    stacked = tagged(left, "l").unionByName(tagged(right, "r"))
    return stacked.groupBy(*keys).agg(
        F.count_if(F.col("_side") == "l").alias("n_left"),
        F.count_if(F.col("_side") == "r").alias("n_right"),
        *(
            f(f"{s}_value").alias(f"{s}_{n}")
            for s in ("l", "r")
            for f, n in ((F.min, "min"), (F.max, "max"))
        ),
    )


def _type_of(df: DataFrame, carry: list[str]):
    return df.select(F.struct(*carry).alias("v")).schema["v"].dataType if carry else "boolean"
