"""Catalogue rows with Morton code, level and render fields."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import morton as M
from ..functions import render as R
from ..functions.constants import UNKNOWN_MAG, UNKNOWN_TEFF
from ..functions.levels import Levels, finite
from ..sources.catalog import DERIVED, REQUIRED, default_teff, require

#: One star: position in its cell, magnitude in hundredths, temperature code, padding.
STAR = np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("mag", "<i2"), ("teff", "u1"), ("pad", "u1")])
FIELDS = ("rel_x", "rel_y", "rel_z", "mag_centi", "teff8")
POSITION = REQUIRED[:3]


def with_level(df: DataFrame, levels: Levels) -> DataFrame:
    """Adds the level. The magnitude is named first: a term used many times in one projection is not inlined again."""
    return df.withColumn("__mag", finite(F.col("mag_abs"), UNKNOWN_MAG)).withColumn("level", levels.column(F.col("__mag"))).drop("__mag")


def with_morton(df: DataFrame, levels: Levels) -> DataFrame:
    """Adds the Morton code, one projection a round: each names its input, so the plan grows with the rounds, not by 2^rounds."""
    names = [f"__{a}" for a in R.AXES]
    df = df.withColumns({n: M.quantise(F.col(c), levels.half_size) for n, c in zip(names, POSITION, strict=True)})
    for by, mask in M.ROUNDS:
        df = df.withColumns({n: F.col(n).bitwiseOR(F.shiftleft(n, by)).bitwiseAND(F.lit(mask)) for n in names})
    code = F.col(names[0]).bitwiseOR(F.shiftleft(names[1], 1)).bitwiseOR(F.shiftleft(names[2], 2))
    return df.withColumn("morton_code", code).drop(*names)


def with_node(df: DataFrame) -> DataFrame:
    return df.withColumn("node_id", M.node_id(F.col("morton_code"), F.col("level")))


def with_render_fields(df: DataFrame, levels: Levels) -> DataFrame:
    """Adds the fields that the 16 bytes of a star hold: rel_x, rel_y, rel_z, mag_centi, teff8."""
    level = F.col("level")
    half = R.cell_half(level, levels.half_size)
    place = [M.shift_right(M.quantise(F.col(c), levels.half_size), F.lit(M.MORTON_BITS) - level) for c in POSITION]
    rel = {f"rel_{a}": R.relative(F.col(POSITION[k]), R.grid_center(place[k], level, k, levels.half_size), half) for k, a in enumerate(R.AXES)}
    mag = R.centi_magnitude(finite(F.col("mag_abs"), UNKNOWN_MAG))
    return df.withColumns(rel | {"mag_centi": mag, "teff8": R.encode_teff(finite(F.col("teff"), UNKNOWN_TEFF))})


def enrich_fields(stars: DataFrame, levels: Levels | None = None) -> DataFrame:
    """The enriched catalogue with render fields as columns: one projection, no shuffle, no Python.

    Stale derived columns are replaced; other columns pass through. A star without position belongs nowhere: its row
    makes the run fail.
    """
    levels = levels or Levels()
    df = default_teff(require(stars, REQUIRED, "The catalogue")).drop(*DERIVED)
    checked = {c: F.when(F.col(c).isNull() | F.isnan(c), F.raise_error(F.lit(f"{c} is unknown"))).otherwise(F.col(c)) for c in POSITION}
    return with_render_fields(with_node(with_level(with_morton(df.withColumns(checked), levels), levels)), levels)


def pack_stars(batch: pa.RecordBatch) -> np.ndarray:
    """Render fields of a batch as an array of STAR."""
    out = np.zeros(batch.num_rows, STAR)
    for name, field in zip(FIELDS, STAR.names, strict=False):
        out[field] = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
    return out


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = pack_stars(batch).tobytes()
        offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * STAR.itemsize
        render = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        kept = [k for k, n in enumerate(batch.schema.names) if n not in FIELDS]
        yield pa.record_batch([*(batch.column(k) for k in kept), render], [*(batch.schema.names[k] for k in kept), "render"])


def enrich(stars: DataFrame, levels: Levels | None = None) -> DataFrame:
    """stars with morton_code, level and the packed 16-byte render column; sorts nothing."""
    df = enrich_fields(stars, levels).drop("node_id")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in FIELDS), "render binary"])
    return df.mapInArrow(_packer, schema)


def sort_catalog(enriched: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partitioned by Morton code and sorted within: files then have narrow ranges that scans can skip."""
    ranged = enriched.repartitionByRange(partitions, "morton_code") if partitions else enriched.repartitionByRange("morton_code")
    return ranged.sortWithinPartitions("morton_code", "mag_abs")


def write_pixels(enriched: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Writes {path}/pixel=.../ in Morton order within files; only the pixels present are overwritten, so runs resume."""
    writer = enriched.repartitionByRange("pixel", "morton_code").sortWithinPartitions("pixel", "morton_code", "mag_abs").write
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("pixel").parquet(path)


def pending(stars: DataFrame, done: DataFrame) -> DataFrame:
    """Stars of the pixels that are not yet in done(pixel)."""
    return stars.join(done.select("pixel").distinct(), "pixel", "left_anti")
