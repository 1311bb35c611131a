"""Incremental enrichment: new catalogue files become enriched files as they arrive.

The operator keeps no state, so this is the batch operator on a stream; the checkpoint remembers which files are done.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.levels import Levels
from ..operators.enrich import enrich


def enrich_stream(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, levels: Levels | None = None) -> StreamingQuery:
    """Processes what is there, and stops; call it again for what has come since."""
    stars = spark.readStream.schema(schema).parquet(source)
    writer = enrich(stars, levels).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
