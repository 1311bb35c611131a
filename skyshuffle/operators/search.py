"""Bounded queries: stars visible from a point, stars within a distance, nearest stars, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import render as R
from ..functions.constants import COALESCE_GAP_BYTES, DEFAULT_MAG_VIS, WORLD_HALF_SIZE_PC
from ..functions.levels import Levels
from ..functions.morton import dfs_key, morton_code, node_id
from ..plans.prefix import previous_max, running_sum
from ..plans.prune import near_cells
from .cells import KEY, with_ordinal

Point = tuple[float, float, float]


def decode(rows: DataFrame, half_size: float = WORLD_HALF_SIZE_PC) -> DataFrame:
    """Adds world position x, y, z, magnitude and teff as a reader of the packed bytes sees them."""
    level, node = F.col("level"), F.col("node_id")
    half = R.cell_half(level, half_size)
    place = {a: R.cell_center(node, level, k, half_size) + F.col(f"rel_{a}").cast("double") * half for k, a in enumerate(R.AXES)}
    return rows.withColumns(place | {"magnitude": F.col("mag_centi") / F.lit(100.0), "teff": R.decode_teff(F.col("teff8"))})


def box(point: Point, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    """Distance of a point from the row's cell."""
    level, node = F.col("level"), F.col("node_id")
    return R.box_distance(point, [R.cell_center(node, level, k, half_size) for k in range(3)], R.cell_half(level, half_size))


def in_shell(point: Point, magnitude: float, levels: Levels, exact: bool = False) -> Column:
    """Whether the row's cell is looked at for stars brighter than magnitude.

    A cell's load radius is that of its level's brightest stars' limit, so a few stars just inside their band are missed
    from afar; that is the format's rule. exact widens the radius to the whole band and never skips level 0.
    """
    half = R.cell_half(F.col("level"), levels.half_size)
    near = box(point, levels.half_size) <= R.load_radius(half, magnitude, levels.v_mag) * F.lit(2.01 if exact else 1.0)
    return near | (F.col("level") == 0) if exact else near


def shell_rows(rows: DataFrame, point: Point, magnitude: float, levels: Levels, exact: bool = False, scan: bool = False) -> DataFrame:
    """The rows whose cells in_shell() keeps. With scan, rows are read from a table in Morton order, and ranges of codes that
    reach the scan prune them first."""
    reach = 10.0 ** ((magnitude - levels.v_mag) / 5.0)
    if scan and not exact:
        rows = near_cells(rows, point, lambda k: levels.half_size / 2**k * reach, levels.last, levels.half_size)
    return rows.where(in_shell(point, magnitude, levels, exact))


def radius_rows(rows: DataFrame, point: Point, radius: float, levels: Levels, scan: bool = False) -> DataFrame:
    """The rows whose cells touch the sphere, pruned like those of shell_rows()."""
    rows = near_cells(rows, point, lambda _: radius, levels.last, levels.half_size) if scan else rows
    return rows.where(box(point, levels.half_size) <= radius)


def from_point(rows: DataFrame, point: Point) -> DataFrame:
    pc = R.distance(*(F.col(a) - F.lit(p) for a, p in zip(R.AXES, point, strict=True)))
    return rows.withColumn("distance_pc", pc).withColumn("apparent_magnitude", R.apparent_magnitude(F.col("magnitude"), F.col("distance_pc")))


def stars_brighter_than(rows: DataFrame, point: Point, magnitude: float = DEFAULT_MAG_VIS, levels: Levels | None = None, exact: bool = False, scan: bool = False) -> DataFrame:
    """Decoded stars that are visible from a point. rows are cell rows with render fields. Filters only: no shuffle."""
    levels = levels or Levels()
    return from_point(decode(shell_rows(rows, point, magnitude, levels, exact, scan), levels.half_size), point).where(F.col("apparent_magnitude") <= magnitude)


def stars_within_distance(rows: DataFrame, point: Point, radius: float, levels: Levels | None = None, scan: bool = False) -> DataFrame:
    if radius < 0:
        raise ValueError("radius must be >= 0")
    levels = levels or Levels()
    return from_point(decode(radius_rows(rows, point, radius, levels, scan), levels.half_size), point).where(F.col("distance_pc") <= radius)


def nearest(rows: DataFrame, point: Point, radius: float, n: int, levels: Levels | None = None, scan: bool = False) -> DataFrame:
    """The n nearest stars within radius. star_id counts all stars of the touched cells in preorder; ties go by it."""
    levels = levels or Levels()
    if radius < 0:
        raise ValueError("radius must be >= 0")
    touched = with_ordinal(radius_rows(rows, point, radius, levels, scan)).withColumn("dfs_key", dfs_key(F.col("node_id"), F.col("level")))
    counted = running_sum(touched, "dfs_key", ["level", "ordinal"], F.lit(1), "star_id")
    found = from_point(decode(counted, levels.half_size), point).where(F.col("distance_pc") <= radius)
    return found.orderBy("distance_pc", "star_id").limit(max(0, n))


def shell_levels(nodes: DataFrame, rows: DataFrame, point: Point, magnitude: float, levels: Levels | None = None, length: str = "payload_len", cells: DataFrame | None = None, scan: bool = False) -> DataFrame:
    """Per level, and in total as level -1: touched nodes, stars loaded and rendered, payload bytes, magnitudes of all loaded stars.

    cells has the payload length of each cell; quantiles interpolate linearly and are nan where nothing is loaded.
    """
    levels = levels or Levels()
    touched = nodes.where(in_shell(point, magnitude, levels)).groupBy("level").agg(F.count("*").alias("nodes"))
    loaded = from_point(decode(shell_rows(rows, point, magnitude, levels, scan=scan), levels.half_size), point)
    stars = loaded.rollup("level").agg(
        F.count("*").alias("stars_loaded"), F.count(F.when(F.col("apparent_magnitude") <= magnitude, 1)).alias("stars_rendered"),
        F.percentile("magnitude", F.array(*(F.lit(q / 4) for q in range(5)))).alias("q"),
    ).select(F.coalesce("level", F.lit(-1)).alias("level"), "stars_loaded", "stars_rendered", "q")
    payload = cells.where(in_shell(point, magnitude, levels)).groupBy("level").agg(F.sum(length).alias("payload_bytes"))
    per = touched.join(payload, "level", "left")
    per = per.rollup("level").agg(F.sum("nodes").alias("nodes"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("payload_bytes")).withColumn("level", F.coalesce("level", F.lit(-1)))
    names = ("mag_min", "mag_p25", "mag_p50", "mag_p75", "mag_max")
    quantiles = [F.coalesce(F.col("q")[k], F.lit(float("nan"))).alias(c) for k, c in enumerate(names)]
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return per.join(stars, "level", "left").select("level", zero("nodes"), zero("stars_loaded"), zero("stars_rendered"), "payload_bytes", *quantiles)


def coalesce_ranges(ranges: DataFrame, gap: int = COALESCE_GAP_BYTES, start: str = "output_offset", length: str = "payload_len", key: str = "dfs_key", order: tuple[str, ...] = ("level",)) -> DataFrame:
    """How byte ranges merge into reads when gaps of at most `gap` bytes are read along.

    Ranges are in order of key, which is the order of their starts. One row: input_ranges, output_batches,
    raw_payload_bytes, total_span_bytes, largest_batch_bytes; all 0 without ranges.
    """
    rows = ranges.where(F.col(length) > 0).withColumn("__end", F.col(start) + F.col(length))
    rows = previous_max(rows, key, list(order), F.col("__end"), "__reach")
    rows = rows.withColumn("__new", F.when(F.col("__reach").isNull() | (F.col(start) > F.col("__reach") + F.lit(gap)), 1).otherwise(0))
    rows = running_sum(rows, key, list(order), F.col("__new"), "__before").withColumn("__island", F.col("__before") + F.col("__new"))
    spans = rows.groupBy("__island").agg(F.count("*").alias("n"), F.sum(length).alias("raw"), (F.max("__end") - F.min(start)).alias("span"))
    zero = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    return spans.agg(zero(F.sum("n"), "input_ranges"), F.count("*").alias("output_batches"), zero(F.sum("raw"), "raw_payload_bytes"), zero(F.sum("span"), "total_span_bytes"), zero(F.max("span"), "largest_batch_bytes"))


def find_nodes(points: DataFrame, nodes: DataFrame, levels: Levels | None = None) -> DataFrame:
    """points(x, y, z, at_level, ...) with the node at that level that contains each, where the tree has it.

    The world's outer faces count as inside; on an inner face the upper octant wins.
    """
    levels = levels or Levels()
    inside = F.lit(True)
    for a in R.AXES:
        inside = inside & (F.abs(F.col(a)) <= levels.half_size)
    code = morton_code(*(F.col(a) for a in R.AXES), levels.half_size)
    asked = points.where(inside).withColumns({"level": F.col("at_level"), "node_id": node_id(code, F.col("at_level"))})
    return asked.join(nodes.select(*KEY), list(KEY))


def nearest_with_meta(found: DataFrame, meta: DataFrame) -> DataFrame:
    """Joins identifiers of meta(level, node_id, ordinal, ...) to the few nearest stars; stars without keep their row."""
    return found.join(meta, [*KEY, "ordinal"], "left")


__all__ = ["coalesce_ranges", "decode", "find_nodes", "in_shell", "nearest", "nearest_with_meta", "shell_levels", "stars_brighter_than", "stars_within_distance"]
