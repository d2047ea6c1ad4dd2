"""A topic audit that grows with its corpus: new message files are scored once, old ones never again.

A file stream runs until nothing is new (``availableNow``). Each batch is audited on its own, and its topic
rows, partial states of the whole, are written to a folder named by the batch. A batch that Spark repeats
after a crash writes the same folder anew, so it changes nothing. The stored audit is the merge of
all absorbed batches: counts add up, residual and offset summaries are pooled by their counts, sketches merge.
``compact`` replaces absorbed batches by their merge, so that reading stays short.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.operators import audit, cohorts
from posefold.operators.sketches import SKETCH_K
from posefold.sources.messages import normalise_messages

KEY = ("source_uri", "topic")
_LINE = "upto bigint, folder string"


def merge_topics(partials: DataFrame) -> DataFrame:
    """Topic rows of several audits of different messages as one audit of all of them."""
    sketches = [c for c in audit.SKETCHES if c in partials.columns]
    summed = partials.groupBy(*KEY).agg(
        *(F.max(name).alias(name) for name in ("topic_order", "arm", "stream")),
        *(F.sum(name).alias(name) for name in audit.COUNTS if name != "fk_compared"),
        *cohorts.merged_residual_columns(),
        F.sum("fk_compared").alias("fk_compared"),
        *(F.kll_merge_agg_double(name).alias(name) for name in sketches),
        *(F.sum(name).alias(name) for name in ("source_ignored", "source_decode_errors")),
    )
    rows = summed.join(cohorts.merge_offsets(partials, list(KEY)), list(KEY))
    return rows.select(*partials.columns)


def absorb(batch: DataFrame, batch_id: int, output: str, sketch_k: int | None = SKETCH_K, **options) -> None:
    """Audit one batch of messages and keep its topic rows under its id. Ids a base covers are done."""
    spark, root = batch.sparkSession, output.rstrip("/")
    if batch_id <= _base(spark, root)[0]:
        return
    folder = f"{root}/state/batch={batch_id:012d}"
    topics = audit.topic_audit(audit.score_messages(batch, **options), sketch_k)
    topics.write.mode("overwrite").parquet(folder)
    line = spark.createDataFrame([(batch_id, folder)], _LINE)
    line.coalesce(1).write.mode("overwrite").json(f"{root}/absorbed/batch={batch_id:012d}")


def audit_new_files(
    spark: SparkSession,
    inbox: str,
    output: str,
    files_per_batch: int | None = None,
    sketch_k: int | None = SKETCH_K,
    **options,
) -> DataFrame:
    """Absorb every message file of ``inbox`` that was not absorbed before; the stored topic audit.

    ``inbox`` may be a glob over several folders. Files are never changed once they are there; a source
    may arrive in any number of them.
    """
    stream = spark.readStream.schema(C.ARM_MESSAGES)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    messages = normalise_messages(stream.parquet(inbox))
    running = (
        messages.writeStream.foreachBatch(lambda rows, number: absorb(rows, number, output, sketch_k, **options))
        .option("checkpointLocation", f"{output.rstrip('/')}/progress")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return stored_topics(spark, output)


def _lines(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(_LINE).json(path).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


def _base(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The last batch that a merge covers, and the merge's folder."""
    newest = max(_lines(spark, f"{root}/bases"), key=lambda r: r["upto"], default=None)
    return (newest["upto"], newest["folder"]) if newest else (-1, None)


def _partials(spark: SparkSession, output: str) -> tuple[DataFrame, int]:
    """All partial rows, and the last batch among them. One line a batch since the last merge."""
    root = output.rstrip("/")
    upto, folder = _base(spark, root)
    absorbed = [r for r in _lines(spark, f"{root}/absorbed/*") if r["upto"] > upto]
    folders = [f for f in (folder, *(r["folder"] for r in absorbed)) if f]
    if not folders:
        raise FileNotFoundError(f"{output} holds no absorbed batch")
    return spark.read.parquet(*folders), max([upto, *(r["upto"] for r in absorbed)])


def stored_topics(spark: SparkSession, output: str) -> DataFrame:
    """The topic audit of everything absorbed so far."""
    return merge_topics(_partials(spark, output)[0])


def compact(spark: SparkSession, output: str) -> None:
    """Merge what is absorbed into one base; batches it covers are ignored from then on, also if repeated."""
    partials, upto = _partials(spark, output)
    root = output.rstrip("/")
    if upto == _base(spark, root)[0]:
        return
    folder = f"{root}/state/base={upto:012d}"
    merge_topics(partials).write.mode("overwrite").parquet(folder)
    spark.createDataFrame([(upto, folder)], _LINE).coalesce(1).write.mode("append").json(f"{root}/bases")
