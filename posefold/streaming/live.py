"""Live counters over a stream of decoded messages.

Classification, FK and masks are row-local, so the batch operators run on ``readStream`` tables as
they are. Only the topic counters keep state: one line per source and topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.operators.audit import counter_columns, residual_columns, score_messages


def live_topic_counters(messages: DataFrame, **options) -> DataFrame:
    """Pose, joint, FK and residual counters per source and target topic, for update or complete mode."""
    scored = score_messages(messages, **options).where(F.col("role") == "target")
    return scored.groupBy("source_uri", "topic").agg(*counter_columns(), *residual_columns())
