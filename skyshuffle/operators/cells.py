"""Cells: the stars of one (level, node), in canonical order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.constants import STAR_BYTES
from ..functions.morton import dfs_key, shift_right
from .enrich import FIELDS

KEY = ("level", "node_id")
ORDER = ("mag_abs", "source_id", "source")


def cell_rows(enriched: DataFrame) -> DataFrame:
    """The stars that go into cells: null magnitudes are left out, nan ones stay, as the faintest."""
    return enriched.where(F.col("mag_abs").isNotNull())


def with_ordinal(rows: DataFrame) -> DataFrame:
    """Place of each star in its cell, from 0."""
    return rows.withColumn("ordinal", F.row_number().over(W.partitionBy(*KEY).orderBy(*ORDER)) - 1)


def aggregate_cells(rows: DataFrame) -> DataFrame:
    """One row a cell: star_count, and stars as an ordered array of structs. One shuffle serves render, identities, meta.

    A cell's stars are held together, as in the file that they go to.
    """
    star = F.struct(*ORDER, *(c for c in FIELDS if c in rows.columns))
    return rows.groupBy(*KEY).agg(F.count("*").alias("star_count"), F.array_sort(F.collect_list(star)).alias("stars"))


def count_cells(rows: DataFrame) -> DataFrame:
    """level, node_id, star_count and uncompressed payload_len: partial counts are merged before the shuffle."""
    return rows.groupBy(*KEY).agg(F.count("*").alias("star_count")).withColumn("payload_len", F.col("star_count") * STAR_BYTES)


def identities(cells: DataFrame) -> DataFrame:
    """level, node_id, ordinal, source, source_id from aggregated cells."""
    return cells.select(*KEY, F.posexplode("stars").alias("ordinal", "star")).select(*KEY, "ordinal", "star.source", "star.source_id")


def with_shard(cells: DataFrame, deep_from: int, prefix_bits: int) -> DataFrame:
    """prefix_bits and prefix of the intermediate shard that holds each cell; level 0 and shallow levels are not split."""
    level = F.col("level")
    deep = (level >= deep_from) & (level > 0)
    bits = F.when(deep, F.least(F.lit(prefix_bits), level * 3)).otherwise(F.lit(0))
    return cells.withColumn("prefix_bits", bits.cast("int")).withColumn("prefix", F.when(F.col("prefix_bits") > 0, shift_right(F.col("node_id"), level * 3 - F.col("prefix_bits"))).otherwise(F.lit(0)).cast("long"))


SHARD = ("level", "prefix_bits", "prefix")


def shard_offsets(cells: DataFrame, length: str = "payload_len") -> DataFrame:
    """Offset of every payload in its shard's file."""
    before = W.partitionBy(*SHARD).orderBy("node_id").rowsBetween(W.unboundedPreceding, -1)
    return cells.withColumn("payload_offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long"))


def shard_manifest(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*SHARD).agg(F.count("*").alias("record_count"))


def manifest_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shards that only one manifest has, or with different record counts. Empty: they agree."""
    joined = a.withColumnRenamed("record_count", "count_a").join(b.withColumnRenamed("record_count", "count_b"), list(SHARD), "full")
    return joined.where(~F.col("count_a").eqNullSafe(F.col("count_b")))


def order_breaches(cells: DataFrame) -> DataFrame:
    """Records of a shard whose node_id does not rise, or whose payload reaches past the next one's offset."""
    w = W.partitionBy(*SHARD).orderBy("payload_offset", "node_id")
    rows = cells.withColumns({"previous": F.lag("node_id").over(w), "next_offset": F.lead("payload_offset").over(w)})
    return rows.where((F.col("node_id") <= F.col("previous")) | (F.col("payload_offset") + F.col("payload_len") > F.col("next_offset"))).select(*SHARD, "node_id")


def preorder(cells: DataFrame) -> DataFrame:
    return cells.withColumn("dfs_key", dfs_key(F.col("node_id"), F.col("level")))
