"""Keeping generated code small enough to be compiled to machine code.

Spark writes a run of projections into one Java method. HotSpot leaves methods above 8,000 bytes of
bytecode interpreted, which made the kinematic stages some twenty times slower when they shared a
method with classification and quaternions. A higher-order function is evaluated outside whole-stage
code, so a projection that holds one ends the span; everything after it starts a new method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def end_of_span(df: DataFrame, column: str) -> DataFrame:
    """End the generated-code span here. ``column`` is any non-null double; its value is kept."""
    return df.withColumn(column, F.expr(f"aggregate(array({column}), 0D, (sum, v) -> sum + v)"))
