"""Results that are stored once and scanned often, in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_STORED: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where it is unset, on a single machine, a local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is unset: executors elsewhere need a folder that they share with the driver")
    return "/tmp/skyshuffle-shared"


def stored(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of that name of this application, built when first asked for; build may ask for other stored tables."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _STORED:
        path = f"{shared_folder(spark)}/stored/{key[0]}-{uuid.uuid4().hex}"
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])
