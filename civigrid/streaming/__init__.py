"""Extra, beyond the batch scope: look-ups of points that arrive as a stream.

A stream is looked up batch by batch with the batch plan, since the registry and its boundaries are tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from civigrid.plans.lookup import lookup


def lookup_stream(points: DataFrame, entries: DataFrame, boundaries: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Writes the districts of streamed points (point_id, lat, lon) to Parquet; a batch that is tried again replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        lookup(batch, entries, boundaries, **options).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
