"""Schema and null profile of a batch: one aggregate, one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import col


def profile_columns(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null, row_count) for every column.

    All counts come from a single ``agg`` (one scan, partial aggregation per
    task); the one wide row is turned into one row per column afterwards.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(col(f.name)).alias(f"__c{i}") for i, f in enumerate(fields)],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"__c{i}").alias("non_null"),
            F.col("__rows").alias("row_count"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
