"""Batch operators over growing inputs: each micro-batch of a stream goes through a batch operator and is appended.

The batch operators know no event time; this only spares reading old files again. A batch is written to a folder of
its own number, so a batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_incrementally(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Start a query that processes all there is and stops: ``operator`` over each micro-batch, as Parquet below ``out``."""

    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
