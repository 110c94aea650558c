"""Which reference tables are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Estimated bytes up to which a reference table is broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def estimated_bytes(table: DataFrame) -> int:
    """The planner's estimate, from the sizes of files and rows that it knows of; no job runs."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Marks a table for broadcasting if its estimated size is within the bound."""
    return F.broadcast(table) if estimated_bytes(table) <= most else table
