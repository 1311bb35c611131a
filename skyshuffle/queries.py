"""Queries over the catalogue derived from orders, with the SQL that each must agree with."""

from __future__ import annotations

import functools
import json
import math
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import morton as M
from .functions import render as R
from .functions import text
from .functions.constants import TEFF_HI, TEFF_LO
from .functions.levels import Levels
from .operators import cells as C
from .operators import enrich as E
from .operators import glow, layout, meta, search
from .plans.prune import has_prefix
from .sources import artifacts, catalog
from .sources.store import shared_folder, stored

LEVELS = Levels()
POINT, MAGNITUDE = (300.0, 170.0, -110.0), 6.5
ORIGIN, RADIUS, TOP = (0.0, 0.0, 0.0), 10.0, 10
DEEP_FROM, PREFIX_BITS = 8, 3
GAP = 1024  # bytes; small, so that ranges of small files do not all merge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- common inputs -----------------------------------------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")


def stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.derive_stars(orders(spark, sf_dir))


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.derive_identifiers(orders(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched catalogue, written once in Morton order as the first stage does, then scanned with pushed-down filters."""
    return stored(spark, f"enriched {sf_dir}", lambda: E.sort_catalog(E.enrich_fields(stars(spark, sf_dir), LEVELS)))


def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched catalogue, computed."""
    return E.enrich_fields(stars(spark, sf_dir), LEVELS)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cell_rows(enriched(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.count_cells(rows(spark, sf_dir))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _spread(v: str) -> str:
    return f"list_sum(list_transform(range(21), lambda b: ((({v}) >> b) & 1) << (3 * b)))::BIGINT"


def _grid(axis: int, node: str = "node_id", level: str = "level") -> str:
    return f"coalesce(list_sum(list_transform(range({level}), lambda b: (({node} >> (3 * b + {axis})) & 1) << b)), 0)::BIGINT"


_P = "CAST((1::BIGINT << (n % 12)::INTEGER) AS DOUBLE)"
STARS = f"""orders_ AS (SELECT o_orderkey AS n, o_orderpriority FROM orders),
stars AS (SELECT n, CASE n % 10 WHEN 0 THEN 'hip' WHEN 1 THEN 'manual' ELSE 'gaia' END AS source, CAST(n AS VARCHAR) AS source_id,
  CAST((n * 7919) % 20011 - 10005 AS DOUBLE) / {_P} AS x_icrs_pc, CAST((n * 104729) % 20021 - 10010 AS DOUBLE) / {_P} AS y_icrs_pc,
  CAST((n * 1299709) % 20023 - 10011 AS DOUBLE) / {_P} AS z_icrs_pc,
  CASE WHEN n % 97 = 0 THEN NULL ELSE CAST((n * 48271) % 2801 - 1600 AS DOUBLE) / CAST(100 AS DOUBLE) END AS mag_abs,
  CASE WHEN n % 17 = 0 THEN NULL ELSE CAST(1500 + (n * 69621) % 52000 AS DOUBLE) END AS teff FROM orders_)"""
IDS = """ids AS (SELECT CASE n % 10 WHEN 0 THEN 'hip' WHEN 1 THEN 'manual' ELSE 'gaia' END AS source, CAST(n AS VARCHAR) AS source_id,
  NULL::BIGINT AS gaia_source_id, CASE WHEN n % 10 = 0 THEN n END AS hip_id, CASE WHEN n % 6 = 0 THEN n + 100000 END AS hd, NULL::VARCHAR AS bayer,
  NULL::BIGINT AS flamsteed, nullif(trim(o_orderpriority), '') AS constellation, CASE WHEN n % 30 = 0 THEN 'Star ' || n END AS proper_name
  FROM orders_ WHERE n % 3 = 0)"""
_LEVEL = "CASE " + " ".join(f"WHEN mag_s <= {top!r}::DOUBLE THEN {k}" for k, top in enumerate(LEVELS.limits())) + f" ELSE {LEVELS.last} END"
_IX = "greatest(0, least(2097151, CAST(floor(({0}_icrs_pc + 200000.0::DOUBLE) * (2097152 / 400000.0::DOUBLE)) AS BIGINT)))"
ENRICHED = f"""{STARS},
located AS (SELECT *, coalesce(mag_abs, 99.0::DOUBLE) AS mag_s, coalesce(teff, 5800.0::DOUBLE) AS teff_s, {_IX.format("x")} AS ix, {_IX.format("y")} AS iy, {_IX.format("z")} AS iz FROM stars),
coded AS (SELECT *, {_LEVEL} AS level, {_spread("ix")} + 2 * {_spread("iy")} + 4 * {_spread("iz")} AS morton_code FROM located),
enriched AS (SELECT *, morton_code >> (3 * (21 - level)) AS node_id FROM coded)"""
GEOMETRY = f"""{ENRICHED},
gridded AS (SELECT *, {_grid(0)} AS gx, {_grid(1)} AS gy, {_grid(2)} AS gz, 200000.0::DOUBLE / pow(2, level) AS half FROM enriched),
placed AS (SELECT *, (gx + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cx, (gy + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cy,
  (gz + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cz FROM gridded)"""
_REL = "CAST(greatest(least(({0}_icrs_pc - c{0}) / half, 1.0::DOUBLE), (-1.0)::DOUBLE) AS FLOAT)"
_LOW, _WIDE = math.log10(TEFF_LO), math.log10(TEFF_HI) - math.log10(TEFF_LO)
_TEFF8 = f"CASE WHEN teff_s >= 2000 AND teff_s <= 50000 THEN greatest(0, least(254, floor(255.0::DOUBLE * (log10(teff_s) - {_LOW!r}::DOUBLE) / {_WIDE!r}::DOUBLE)))::INTEGER ELSE 255 END"
DECODED = f"""{GEOMETRY},
packed AS (SELECT *, {_REL.format("x")} AS rel_x, {_REL.format("y")} AS rel_y, {_REL.format("z")} AS rel_z,
  greatest(-32768, least(32767, round_even(mag_s * 100.0::DOUBLE, 0)))::INTEGER AS mag_centi, {_TEFF8} AS teff8 FROM placed),
decoded AS (SELECT * EXCLUDE (teff), cx + rel_x::DOUBLE * half AS x, cy + rel_y::DOUBLE * half AS y, cz + rel_z::DOUBLE * half AS z, mag_centi / 100.0::DOUBLE AS magnitude,
  CASE WHEN teff8 = 255 THEN 'nan'::DOUBLE ELSE 2000.0::DOUBLE * pow(25.0::DOUBLE, teff8 / 255.0::DOUBLE) END AS teff FROM packed WHERE mag_abs IS NOT NULL)"""
CELLS = f"""{ENRICHED},
cells AS (SELECT level, node_id, count(*) AS star_count, 16 * count(*) AS payload_len, node_id << (3 * (21 - level)) AS dfs_key FROM enriched WHERE mag_abs IS NOT NULL GROUP BY level, node_id)"""
NODES = """nodes AS (SELECT DISTINCT k AS level, node_id >> (3 * (level - k)) AS node_id FROM (SELECT level, node_id, unnest(range(0, level + 1)) AS k FROM cells)),
masks AS (SELECT level - 1 AS level, node_id >> 3 AS node_id, bit_or((1 << (node_id & 7))::INTEGER) AS child_mask FROM nodes WHERE level > 0 GROUP BY 1, 2)"""
SHARDED = f"""{CELLS}, {NODES},
topped AS (SELECT n.level, n.node_id, coalesce(child_mask, 0) AS child_mask, c.star_count IS NOT NULL AS has_payload, (n.level // 5) * 5 - 1 AS parent_level, n.level - ((n.level // 5) * 5 - 1) AS local_depth
  FROM nodes n LEFT JOIN masks m USING (level, node_id) LEFT JOIN cells c USING (level, node_id)),
pathed AS (SELECT *, CASE WHEN parent_level < 0 THEN 0 ELSE node_id >> (3 * local_depth) END AS parent_node, node_id & ((1::BIGINT << (3 * local_depth)) - 1) AS local_path FROM topped),
indexed AS (SELECT *, row_number() OVER (PARTITION BY parent_level, parent_node ORDER BY local_depth, local_path) AS node_index FROM pathed),
firsts AS (SELECT parent_level, parent_node, level - 1 AS level, node_id >> 3 AS node_id, min(node_index) AS first_child FROM indexed WHERE local_depth > 1 GROUP BY ALL),
shard_nodes AS (SELECT i.*, coalesce(first_child, 0) AS first_child, CASE WHEN has_payload THEN 1 ELSE 0 END + CASE WHEN child_mask <> 0 THEN 2 ELSE 0 END + CASE WHEN local_depth = 5 THEN 4 ELSE 0 END AS flags
  FROM indexed i LEFT JOIN firsts f USING (parent_level, parent_node, level, node_id)),
shards AS (SELECT parent_level, parent_node, count(*) AS node_count, count(*) FILTER (local_depth = 5) AS frontier_count, coalesce(min(node_index) FILTER (local_depth = 5), 0) AS first_frontier_index,
  {", ".join(f"coalesce(max(node_index) FILTER (local_depth = 1 AND local_path = {k}), 0) AS entry_{k}" for k in range(8))},
  80 + 20 * count(*) + 8 * count(*) FILTER (local_depth = 5) AS shard_bytes, CASE WHEN parent_level < 0 THEN 0 ELSE parent_node << (3 * (21 - parent_level)) END AS parent_key FROM shard_nodes GROUP BY parent_level, parent_node),
headers AS (SELECT * EXCLUDE (parent_key), row_number() OVER (ORDER BY parent_key, parent_level) AS shard_id,
  coalesce(sum(shard_bytes) OVER (ORDER BY parent_key, parent_level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS shard_offset FROM shards)"""
FOUND = "coalesce(sum(payload_len) OVER (ORDER BY dfs_key, level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + 192 AS output_offset"


def _box(point: tuple[float, float, float], cx: str = "cx", cy: str = "cy", cz: str = "cz") -> str:
    terms = " + ".join(f"pow(greatest(abs(({p!r})::DOUBLE - {c}) - half, 0), 2)" for p, c in zip(point, (cx, cy, cz), strict=True))
    return f"sqrt({terms})"


def _pc(point: tuple[float, float, float]) -> str:
    return "sqrt(" + " + ".join(f"({a} - ({p!r})) * ({a} - ({p!r}))" for a, p in zip("xyz", point, strict=True)) + ")"


_LOAD = f"half * {10.0 ** ((MAGNITUDE - LEVELS.v_mag) / 5.0)!r}::DOUBLE"
_APPARENT = "magnitude + 5.0::DOUBLE * (log10(greatest(distance_pc, 1e-6::DOUBLE)) - 1.0::DOUBLE)"


def _where(table: str, level: str = "level", node: str = "node_id") -> str:
    """Cell geometry for a table of (level, node_id)."""
    return f"""SELECT *, (gx + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cx, (gy + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cy, (gz + 0.5::DOUBLE) * (2.0::DOUBLE * half) - 200000.0::DOUBLE AS cz
  FROM (SELECT *, {_grid(0, node, level)} AS gx, {_grid(1, node, level)} AS gy, {_grid(2, node, level)} AS gz, 200000.0::DOUBLE / pow(2, {level}) AS half FROM {table})"""


# --- scans, projections ------------------------------------------------------------------------------------------


@query(f"WITH {STARS} SELECT source, source_id, x_icrs_pc, y_icrs_pc, z_icrs_pc, mag_abs, teff FROM stars")
def scan_catalog(spark, sf_dir):
    return stars(spark, sf_dir)


@query(f"WITH {ENRICHED} SELECT level, morton_code, mag_abs, source, source_id FROM enriched LIMIT 0")
def validate_columns(spark, sf_dir):
    df = catalog.require(fresh(spark, sf_dir), ("level", "morton_code", "mag_abs", "source", "source_id"), "The enriched catalogue")
    return df.select("level", "morton_code", "mag_abs", "source", "source_id").limit(0)


@query(f"WITH {STARS}, {IDS} SELECT * FROM ids")
def ident_map(spark, sf_dir):
    return meta.last_wins(identifiers(spark, sf_dir))


@query(f"""WITH {STARS}, {IDS} SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 9 <> 0 THEN hip_id WHEN k % 4 <> 0 THEN k END AS hip_id, CASE WHEN k % 9 <> 0 THEN constellation WHEN k % 2 = 0 THEN 'Late' END AS constellation,
  CASE WHEN k % 9 <> 0 THEN hd END AS hd, CASE WHEN k % 9 <> 0 THEN proper_name END AS proper_name) FROM (SELECT *, source_id::BIGINT AS k FROM ids)""")
def ident_last_wins(spark, sf_dir):
    """Some stars come twice, the second time with blanks and a number that is none."""
    first, k = identifiers(spark, sf_dir).withColumn("hip_id", F.col("hip_id").cast("string")), F.col("source_id").cast("long")
    late = first.where(k % 9 == 0).withColumns({"row": F.col("row") + 10**12, "hip_id": F.when(k % 4 == 0, "none").otherwise(F.concat(F.lit(" "), "source_id")), "hd": F.lit(None).cast("long"), "constellation": F.when(k % 2 == 0, " Late ").otherwise("  "), "proper_name": F.lit("")})
    return meta.last_wins(late.unionByName(first))


@query(f"WITH {STARS} SELECT source, source_id, 5800.0::DOUBLE AS teff FROM stars")
def default_teff(spark, sf_dir):
    return catalog.default_teff(stars(spark, sf_dir).drop("teff")).select("source", "source_id", "teff")


@query(f"WITH {ENRICHED} SELECT source_id, ix, iy, iz, morton_code FROM enriched")
def morton_encode(spark, sf_dir):
    df = E.with_morton(stars(spark, sf_dir), LEVELS)
    return df.select("source_id", *(M.quantise(F.col(f"{a}_icrs_pc")).alias(f"i{a}") for a in "xyz"), "morton_code")


@query(f"WITH {ENRICHED} SELECT source_id, mag_abs, level FROM enriched")
def level_assign(spark, sf_dir):
    return E.with_level(stars(spark, sf_dir), LEVELS).select("source_id", "mag_abs", "level")


_BANDS = ", ".join(f"({k}, {'NULL' if math.isinf(lo) else f'({lo!r})::DOUBLE'}, {'NULL' if math.isinf(hi) else f'({hi!r})::DOUBLE'}, {LEVELS.half_size / 2**k!r}::DOUBLE)" for k, lo, hi in LEVELS.bands())


@query(f"SELECT level, m_min, m_max, half_size FROM (VALUES {_BANDS}) t(level, m_min, m_max, half_size)")
def level_bands(spark, sf_dir):
    open_ = lambda c: F.when(F.abs(c) != float("inf"), F.col(c)).alias(c)
    return LEVELS.table(spark).select("level", open_("m_min"), open_("m_max"), "half_size")


@query(f"WITH {ENRICHED}, bands(b, lo, hi, h) AS (VALUES {_BANDS}) SELECT source_id, b AS level FROM enriched JOIN bands ON (lo IS NULL OR mag_s > lo) AND (hi IS NULL OR mag_s <= hi)")
def level_band_join(spark, sf_dir):
    df = stars(spark, sf_dir).withColumn("mag_s", F.coalesce("mag_abs", F.lit(99.0)))
    bands = LEVELS.table(spark)  # fourteen rows
    return df.join(F.broadcast(bands), (F.col("mag_s") > F.col("m_min")) & (F.col("mag_s") <= F.col("m_max"))).select("source_id", "level")


@query(f"WITH {ENRICHED} SELECT source_id, level, node_id FROM enriched")
def node_id(spark, sf_dir):
    return fresh(spark, sf_dir).select("source_id", "level", "node_id")


@query(f"WITH {GEOMETRY} SELECT source_id, gx, gy, gz FROM placed")
def grid_coords(spark, sf_dir):
    return fresh(spark, sf_dir).select("source_id", *(M.grid(F.col("node_id"), k).alias(f"g{a}") for k, a in enumerate("xyz")))


@query(f"WITH {GEOMETRY} SELECT DISTINCT level, node_id, cx, cy, cz, half FROM placed")
def cell_geometry(spark, sf_dir):
    df = enriched(spark, sf_dir).select("level", "node_id").distinct()
    return df.select("level", "node_id", *(R.cell_center(F.col("node_id"), F.col("level"), k).alias(f"c{a}") for k, a in enumerate("xyz")), R.cell_half(F.col("level")).alias("half"))


@query(f"WITH {DECODED} SELECT source_id, rel_x::DOUBLE AS rel_x, rel_y::DOUBLE AS rel_y, rel_z::DOUBLE AS rel_z, mag_centi FROM packed")
def render_fields(spark, sf_dir):
    return fresh(spark, sf_dir).select("source_id", *(F.col(f"rel_{a}").cast("double").alias(f"rel_{a}") for a in "xyz"), "mag_centi")


@query(f"WITH {DECODED} SELECT source_id, teff8, round(teff, 6) AS teff FROM decoded WHERE teff8 < 255 UNION ALL SELECT source_id, teff8, NULL FROM decoded WHERE teff8 = 255")
def teff_codec(spark, sf_dir):
    df = search.decode(rows(spark, sf_dir))
    return df.select("source_id", "teff8", F.when(~F.isnan("teff"), F.round("teff", 6)).alias("teff"))


@query(f"WITH {DECODED} SELECT level, node_id, source_id, x, y, z, magnitude FROM decoded")
def decode_payload(spark, sf_dir):
    return search.decode(rows(spark, sf_dir)).select("level", "node_id", "source_id", "x", "y", "z", "magnitude")


@query(f"WITH {ENRICHED} SELECT level, count(*) AS stars, count(mag_abs) AS in_cells, min(morton_code) AS first_code, max(morton_code) AS last_code FROM enriched GROUP BY level")
def enrich(spark, sf_dir):
    return fresh(spark, sf_dir).groupBy("level").agg(F.count("*").alias("stars"), F.count("mag_abs").alias("in_cells"), F.min("morton_code").alias("first_code"), F.max("morton_code").alias("last_code"))


@query(f"WITH {ENRICHED} SELECT morton_code, mag_abs, level, source, source_id FROM enriched")
def enrich_sorted(spark, sf_dir):
    return E.sort_catalog(fresh(spark, sf_dir).select("morton_code", "mag_abs", "level", "source", "source_id"))


@query(f"WITH {STARS} SELECT n % 12 AS pixel, count(*) AS stars FROM stars WHERE n % 12 NOT IN (SELECT n % 12 FROM stars WHERE n % 12 < 5) GROUP BY 1")
def resume_antijoin(spark, sf_dir):
    df = stars(spark, sf_dir).withColumn("pixel", F.col("source_id").cast("long") % 12)
    return E.pending(df, df.where("pixel < 5")).groupBy("pixel").agg(F.count("*").alias("stars"))


@query(f"WITH {STARS} SELECT source, count(*) AS stars FROM (SELECT * FROM stars WHERE source = 'hip' UNION ALL SELECT * FROM stars WHERE source <> 'hip') GROUP BY source")
def union_sources(spark, sf_dir):
    df = stars(spark, sf_dir)
    return df.where("source = 'hip'").unionByName(df.where("source <> 'hip'")).groupBy("source").agg(F.count("*").alias("stars"))


# Stars beyond the world and on its faces, magnitudes that are nan, infinite or too large for 16 bits, temperatures that are
# nan, and columns of an earlier run.
EDGES = (
    ("x_icrs_pc", "x_icrs_pc * 64"),
    ("y_icrs_pc", "CASE WHEN n % 5 = 0 THEN 200000 WHEN n % 5 = 1 THEN -200000 ELSE y_icrs_pc END"),
    ("mag_abs", "CASE WHEN n % 11 = 0 THEN CAST('nan' AS DOUBLE) WHEN n % 13 = 0 THEN CAST('infinity' AS DOUBLE) WHEN n % 17 = 0 THEN CAST('-infinity' AS DOUBLE) WHEN n % 3 = 0 THEN mag_abs * 400 ELSE mag_abs END"),
    ("teff", "CASE WHEN n % 19 = 0 THEN CAST('nan' AS DOUBLE) WHEN n % 23 = 0 THEN CAST('infinity' AS DOUBLE) ELSE teff END"),
)
_FINITE = "CASE WHEN isfinite(mag_abs) THEN mag_abs ELSE 99.0::DOUBLE END AS mag_s, CASE WHEN isfinite(teff) THEN teff ELSE 5800.0::DOUBLE END AS teff_s"


def _edged(sql: str) -> str:
    """SQL over the stars with those edges."""
    said = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in EDGES)
    out = sql.replace(STARS, STARS.replace("stars AS", "plain AS") + f", stars AS (SELECT * REPLACE ({said}) FROM plain)")
    return out.replace("coalesce(mag_abs, 99.0::DOUBLE) AS mag_s, coalesce(teff, 5800.0::DOUBLE) AS teff_s", _FINITE)


@query(f"WITH {_edged(DECODED)} SELECT source_id, morton_code, level, rel_x::DOUBLE AS rel_x, rel_y::DOUBLE AS rel_y, rel_z::DOUBLE AS rel_z, mag_centi, teff8, mag_abs IS NOT NULL AS in_cells FROM packed")
def enrich_edges(spark, sf_dir):
    df = stars(spark, sf_dir).withColumn("n", F.col("source_id").cast("long"))
    df = df.withColumns({c: F.expr(f"cast({e} as double)") for c, e in EDGES}).withColumns({"level": F.lit("stale"), "morton_code": F.lit(-1), "render": F.lit(None).cast("binary")})
    kept = [F.col(f"rel_{a}").cast("double").alias(f"rel_{a}") for a in "xyz"]
    return E.enrich_fields(df, LEVELS).select("source_id", "morton_code", "level", *kept, "mag_centi", "teff8", F.col("mag_abs").isNotNull().alias("in_cells"))


# --- cells -------------------------------------------------------------------------------------------------------


@query(f"WITH {ENRICHED} SELECT level, node_id, mag_abs, source, source_id FROM enriched WHERE mag_abs IS NOT NULL")
def stage01_rows(spark, sf_dir):
    return rows(spark, sf_dir).select("level", "node_id", "mag_abs", "source", "source_id")


@query(f"WITH {ENRICHED} SELECT source_id, level, morton_code FROM enriched WHERE mag_abs IS NOT NULL AND (morton_code >> 60) = 7")
def prefix_shard(spark, sf_dir):
    return rows(spark, sf_dir).where(has_prefix(7, 3)).select("source_id", "level", "morton_code")


@query(f"WITH {CELLS} SELECT level, node_id, star_count, payload_len FROM cells")
def distinct_cells(spark, sf_dir):
    return cells(spark, sf_dir)


@query(f"WITH {ENRICHED} SELECT level, node_id, count(*) AS star_count, min(mag_abs) AS brightest, string_agg(source || ':' || source_id, ',' ORDER BY mag_abs, source_id, source) AS stars FROM enriched WHERE mag_abs IS NOT NULL GROUP BY level, node_id")
def cell_aggregate(spark, sf_dir):
    df = C.aggregate_cells(rows(spark, sf_dir))
    return df.select("level", "node_id", "star_count", F.col("stars")[0]["mag_abs"].alias("brightest"), F.concat_ws(",", F.transform("stars", lambda s: F.concat_ws(":", s["source"], s["source_id"]))).alias("stars"))


@query(f"WITH {ENRICHED} SELECT level, node_id, row_number() OVER w - 1 AS ordinal, source, source_id FROM enriched WHERE mag_abs IS NOT NULL WINDOW w AS (PARTITION BY level, node_id ORDER BY mag_abs, source_id, source)")
def cell_identities(spark, sf_dir):
    return C.identities(C.aggregate_cells(rows(spark, sf_dir)))


@query(f"WITH {ENRICHED} SELECT source_id, row_number() OVER (PARTITION BY level, node_id ORDER BY mag_abs, source_id, source) - 1 AS ordinal FROM enriched WHERE mag_abs IS NOT NULL")
def cell_ordinal(spark, sf_dir):
    return C.with_ordinal(rows(spark, sf_dir)).select("source_id", "ordinal")


_SHARD_SQL = f"""{CELLS},
bits AS (SELECT *, CASE WHEN level >= {DEEP_FROM} AND level > 0 THEN least({PREFIX_BITS}, 3 * level) ELSE 0 END AS prefix_bits FROM cells),
split AS (SELECT *, CASE WHEN prefix_bits > 0 THEN node_id >> (3 * level - prefix_bits) ELSE 0 END AS prefix FROM bits)"""


@query(f"WITH {_SHARD_SQL} SELECT level, prefix_bits, prefix, node_id, star_count, coalesce(sum(payload_len) OVER (PARTITION BY level, prefix_bits, prefix ORDER BY node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS payload_offset FROM split")
def shard_layout(spark, sf_dir):
    df = C.shard_offsets(C.with_shard(cells(spark, sf_dir), DEEP_FROM, PREFIX_BITS))
    return df.select(*C.SHARD, "node_id", "star_count", "payload_offset")


@query(f"WITH {_SHARD_SQL} SELECT level, prefix_bits, prefix, count(*) AS record_count FROM split GROUP BY 1, 2, 3")
def shard_manifest(spark, sf_dir):
    return C.shard_manifest(C.with_shard(cells(spark, sf_dir), DEEP_FROM, PREFIX_BITS))


@query(f"WITH {_SHARD_SQL}, a AS (SELECT level, prefix_bits, prefix, count(*) AS count_a FROM split GROUP BY 1, 2, 3), b AS (SELECT level, prefix_bits, prefix, count(*) AS count_b FROM split WHERE star_count > 1 GROUP BY 1, 2, 3) SELECT level, prefix_bits, prefix, count_a, count_b FROM a FULL JOIN b USING (level, prefix_bits, prefix) WHERE count_a IS DISTINCT FROM count_b")
def manifest_diff(spark, sf_dir):
    df = C.with_shard(cells(spark, sf_dir), DEEP_FROM, PREFIX_BITS)
    return C.manifest_differences(C.shard_manifest(df), C.shard_manifest(df.where("star_count > 1")))


@query(f"WITH {_SHARD_SQL} SELECT level, prefix_bits, prefix, node_id FROM split WHERE false")
def monotone_check(spark, sf_dir):
    return C.order_breaches(C.shard_offsets(C.with_shard(cells(spark, sf_dir), DEEP_FROM, PREFIX_BITS)))


@query(f"""WITH {_SHARD_SQL}, placed AS (SELECT *, coalesce(sum(payload_len) OVER (PARTITION BY level, prefix_bits, prefix ORDER BY node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS payload_offset FROM split),
broken AS (SELECT * REPLACE (CASE WHEN star_count = 2 THEN node_id - 1000000 ELSE node_id END AS node_id, CASE WHEN star_count % 3 = 0 THEN payload_len + 1 ELSE payload_len END AS payload_len) FROM placed),
seen AS (SELECT *, lag(node_id) OVER w AS before, lead(payload_offset) OVER w AS after FROM broken WINDOW w AS (PARTITION BY level, prefix_bits, prefix ORDER BY payload_offset))
SELECT level, prefix_bits, prefix, node_id FROM seen WHERE node_id <= before OR payload_offset + payload_len > after""")
def monotone_breaches(spark, sf_dir):
    df = C.shard_offsets(C.with_shard(cells(spark, sf_dir), DEEP_FROM, PREFIX_BITS))
    broken = {"node_id": F.when(F.col("star_count") == 2, F.col("node_id") - 1_000_000).otherwise(F.col("node_id")), "payload_len": F.col("payload_len") + (F.col("star_count") % 3 == 0).cast("int")}
    return C.order_breaches(df.withColumns(broken))


@query(f"WITH {CELLS} SELECT level, node_id, star_count FROM cells c WHERE EXISTS (SELECT 1 FROM cells p WHERE p.level = c.level - 1 AND p.node_id = c.node_id >> 3)")
def semi_cells(spark, sf_dir):
    df = cells(spark, sf_dir)
    parents = df.select((F.col("level") + 1).alias("level"), F.col("node_id").alias("up"))
    return df.withColumn("up", M.shift_right(F.col("node_id"), 3)).join(parents, ["level", "up"], "left_semi").select("level", "node_id", "star_count")


# --- layout ------------------------------------------------------------------------------------------------------


@query(f"WITH {CELLS} SELECT level, node_id, row_number() OVER (ORDER BY dfs_key, level) - 1 AS place FROM cells")
def dfs_order(spark, sf_dir):
    return layout.running_sum(C.preorder(cells(spark, sf_dir)), "dfs_key", ["level"], F.lit(1), "place").select("level", "node_id", "place")


@query(f"WITH {CELLS}, {NODES} SELECT level, node_id FROM nodes")
def node_set(spark, sf_dir):
    return layout.node_set(cells(spark, sf_dir))


@query(f"WITH {CELLS}, {NODES} SELECT level, node_id, child_mask FROM masks")
def child_mask(spark, sf_dir):
    return layout.child_masks(layout.node_set(cells(spark, sf_dir)))


@query(f"WITH {CELLS} SELECT level, node_id, {FOUND} FROM cells")
def payload_offsets(spark, sf_dir):
    return layout.payload_offsets(cells(spark, sf_dir)).select("level", "node_id", "output_offset")


@query(f"WITH {SHARDED} SELECT level, node_id, flags, (child_mask = 0) AS is_leaf FROM shard_nodes")
def node_flags(spark, sf_dir):
    return layout.shard_nodes(cells(spark, sf_dir)).select("level", "node_id", "flags", (F.col("child_mask") == 0).alias("is_leaf"))


@query(f"WITH {SHARDED} SELECT parent_level, parent_node, node_index, level, node_id, local_depth, local_path, child_mask, first_child, has_payload, true AS contiguous FROM shard_nodes")
def shard_nodes(spark, sf_dir):
    return layout.shard_nodes(cells(spark, sf_dir)).select("parent_level", "parent_node", "node_index", "level", "node_id", "local_depth", "local_path", "child_mask", "first_child", "has_payload", "contiguous")


@query(f"WITH {SHARDED} SELECT * FROM headers")
def shard_headers(spark, sf_dir):
    return layout.shard_headers(layout.shard_nodes(cells(spark, sf_dir)))


@query(f"WITH {SHARDED} SELECT n.level, n.node_id, n.node_index, coalesce(h.shard_offset, 0) AS child_offset FROM shard_nodes n LEFT JOIN headers h ON h.parent_level = n.level AND h.parent_node = n.node_id WHERE n.local_depth = 5")
def frontier_refs(spark, sf_dir):
    nodes = layout.shard_nodes(cells(spark, sf_dir))
    return layout.frontier_refs(nodes, layout.shard_headers(nodes)).select("level", "node_id", "node_index", "child_offset")


@query(f"WITH {CELLS}, {NODES} SELECT m.level, m.node_id, c.node_id AS child_id, (c.node_id & 7)::INTEGER AS octant, bit_count((child_mask & ((1 << (c.node_id & 7)) - 1))::INTEGER)::INTEGER AS rank FROM masks m JOIN nodes c ON c.level = m.level + 1 AND c.node_id >> 3 = m.node_id")
def child_nav(spark, sf_dir):
    nodes = layout.node_set(cells(spark, sf_dir))
    return layout.children(nodes.join(layout.child_masks(nodes), ["level", "node_id"], "left"))


@query(f"WITH {CELLS}, {NODES} SELECT level, node_id FROM (SELECT level - 1 AS level, node_id >> 3 AS node_id FROM cells WHERE level > 0 UNION SELECT level, node_id + 1 FROM cells) JOIN nodes USING (level, node_id)")
def descendant_exists(spark, sf_dir):
    df = cells(spark, sf_dir)
    asked = df.where("level > 0").select((F.col("level") - 1).alias("level"), M.shift_right(F.col("node_id"), 3).alias("node_id")).union(df.select("level", F.col("node_id") + 1)).distinct()
    return layout.descendant_exists(df, asked)


@query(f"WITH {CELLS} SELECT level, node_id, true AS in_cells, false AS in_reloc FROM cells WHERE star_count > 5")
def reloc_check(spark, sf_dir):
    df = cells(spark, sf_dir)
    return layout.relocation_breaches(df, layout.payload_offsets(df.where("star_count <= 5")))


# --- identifiers -------------------------------------------------------------------------------------------------

_JOINED = f"WITH {STARS}, {IDS} SELECT source, source_id, gaia_source_id, hip_id, hd, bayer, flamsteed, constellation, proper_name FROM stars LEFT JOIN ids USING (source, source_id)"


@query(_JOINED)
def meta_join(spark, sf_dir):
    return meta.join_identifiers(stars(spark, sf_dir).select("source", "source_id"), identifiers(spark, sf_dir))


@query(f"WITH j AS ({_JOINED}) SELECT source, source_id, hip_id, proper_name FROM j")
def meta_fields(spark, sf_dir):
    kept = identifiers(spark, sf_dir).select("source", "source_id", "hip_id", "proper_name", "row")
    return meta.join_identifiers(stars(spark, sf_dir).select("source", "source_id"), kept)


_ENTRY = """'{"source":"' || source || '","source_id":"' || source_id || '"' || coalesce(',"hip_id":' || hip_id, '') || coalesce(',"hd":' || hd, '')
  || coalesce(',"constellation":"' || constellation || '"', '') || coalesce(',"proper_name":"' || proper_name || '"', '') || '}'"""


@query(f"WITH {ENRICHED}, {IDS} SELECT level, node_id, count(*)::INTEGER AS star_count, '[' || string_agg({_ENTRY}, ',' ORDER BY mag_abs, source_id, source) || ']' AS meta FROM enriched LEFT JOIN ids USING (source, source_id) WHERE mag_abs IS NOT NULL GROUP BY level, node_id")
def cell_meta(spark, sf_dir):
    return meta.build_family("meta", C.identities(C.aggregate_cells(rows(spark, sf_dir))), identifiers(spark, sf_dir))


_LABEL = """CASE WHEN k <> '' THEN k WHEN source = 'gaia' THEN 'Gaia ' || source_id WHEN source = 'hip' THEN 'HIP ' || source_id ELSE source || ':' || source_id END"""


@query(f"WITH j AS ({_JOINED}), l AS (SELECT *, concat_ws(' | ', proper_name, 'HIP ' || hip_id, 'HD ' || hd, 'Gaia ' || gaia_source_id, constellation) AS k FROM j) SELECT source, source_id, {_LABEL} AS label FROM l")
def identifier_label(spark, sf_dir):
    df = meta.join_identifiers(stars(spark, sf_dir).select("source", "source_id"), identifiers(spark, sf_dir))
    return df.select("source", "source_id", text.identifier_label(F.struct(*df.columns)).alias("label"))


# --- bounded queries ---------------------------------------------------------------------------------------------


@query(f"WITH {GEOMETRY} SELECT DISTINCT level, node_id, round({_box(POINT)}, 6) AS aabb FROM placed")
def aabb_distance(spark, sf_dir):
    df = enriched(spark, sf_dir).select("level", "node_id").distinct()
    return df.select("level", "node_id", F.round(search.box(POINT), 6).alias("aabb"))


_SHELL = f"""{DECODED},
loaded AS (SELECT *, {_pc(POINT)} AS distance_pc FROM decoded WHERE {_box(POINT)} <= {_LOAD}),
seen AS (SELECT *, {_APPARENT} AS apparent_magnitude FROM loaded)"""


@query(f"WITH {_SHELL} SELECT source_id, level, node_id, x, y, z, magnitude, round(distance_pc, 6) AS distance_pc, round(apparent_magnitude, 6) AS apparent_magnitude FROM seen WHERE apparent_magnitude <= {MAGNITUDE}")
def shell_query(spark, sf_dir):
    df = search.stars_brighter_than(rows(spark, sf_dir), POINT, MAGNITUDE, LEVELS, scan=True)
    return rounded(df.select("source_id", "level", "node_id", "x", "y", "z", "magnitude", "distance_pc", "apparent_magnitude"), "distance_pc", "apparent_magnitude")


_NEAR = f"{DECODED}, near AS (SELECT *, {_pc(ORIGIN)} AS distance_pc FROM decoded WHERE {_box(ORIGIN)} <= {RADIUS}), inside AS (SELECT *, {_APPARENT} AS apparent_magnitude FROM near WHERE distance_pc <= {RADIUS})"


@query(f"WITH {_NEAR} SELECT source_id, level, magnitude, round(distance_pc, 6) AS distance_pc, round(apparent_magnitude, 6) AS apparent_magnitude FROM inside")
def radius_query(spark, sf_dir):
    df = search.stars_within_distance(rows(spark, sf_dir), ORIGIN, RADIUS, LEVELS, scan=True)
    return rounded(df.select("source_id", "level", "magnitude", "distance_pc", "apparent_magnitude"), "distance_pc", "apparent_magnitude")


_NEAREST = f"""{DECODED},
touched AS (SELECT *, row_number() OVER (ORDER BY node_id << (3 * (21 - level)), level, mag_abs, source_id, source) - 1 AS star_id,
  row_number() OVER (PARTITION BY level, node_id ORDER BY mag_abs, source_id, source) - 1 AS ordinal, {_pc(ORIGIN)} AS distance_pc FROM decoded WHERE {_box(ORIGIN)} <= {RADIUS}),
top AS (SELECT *, {_APPARENT} AS apparent_magnitude FROM touched WHERE distance_pc <= {RADIUS} ORDER BY distance_pc, star_id LIMIT {TOP})"""


@query(f"WITH {_NEAREST} SELECT star_id, source_id, round(distance_pc, 6) AS distance_pc, magnitude, round(apparent_magnitude, 6) AS apparent_magnitude, CASE WHEN teff8 = 255 THEN NULL ELSE round(teff, 6) END AS teff FROM top")
def nearest(spark, sf_dir):
    df = search.nearest(rows(spark, sf_dir), ORIGIN, RADIUS, TOP, LEVELS, scan=True)
    teff = F.when(~F.isnan("teff"), F.round("teff", 6)).alias("teff")
    return rounded(df.select("star_id", "source_id", "distance_pc", "magnitude", "apparent_magnitude", teff), "distance_pc", "apparent_magnitude")


@query(f"WITH {_NEAREST}, {IDS} SELECT star_id, t.source, t.source_id, hip_id, hd, constellation, proper_name FROM top t LEFT JOIN ids USING (source, source_id)")
def nearest_meta(spark, sf_dir):
    found = stored(spark, f"nearest {sf_dir}", lambda: search.nearest(rows(spark, sf_dir), ORIGIN, RADIUS, TOP, LEVELS, scan=True).drop("source", "source_id"))
    cell = F.broadcast(found.select("level", "node_id").distinct())  # at most TOP cells: their stars alone are gathered
    sidecar = meta.cell_meta(C.identities(C.aggregate_cells(rows(spark, sf_dir).join(cell, ["level", "node_id"], "left_semi"))), identifiers(spark, sf_dir))
    return search.nearest_with_meta(found, meta.parse_meta(sidecar)).select("star_id", "source", "source_id", "hip_id", "hd", "constellation", "proper_name")


@query(f"WITH {CELLS}, {NODES}, p(i, x, y, z, at_level) AS (VALUES (1, 0.0, 0.0, 0.0, 3), (2, 300.0, 170.0, -110.0, 5), (3, -5000.0, 2500.0, 1.0, 4), (4, 999999.0, 0.0, 0.0, 1), (5, 123.0, -4567.0, 8901.0, 2)), q AS (SELECT i, at_level, {', '.join(f'greatest(0, least(2097151, CAST(floor(({a}::DOUBLE + 200000.0::DOUBLE) * (2097152 / 400000.0::DOUBLE)) AS BIGINT))) AS i{a}' for a in 'xyz')} FROM p WHERE abs(x) <= 200000), k AS (SELECT i, at_level AS level, ({_spread('ix')} + 2 * {_spread('iy')} + 4 * {_spread('iz')}) >> (3 * (21 - at_level)) AS node_id FROM q) SELECT i, level, node_id FROM k JOIN nodes USING (level, node_id)")
def find_node(spark, sf_dir):
    asked = [(1, 0.0, 0.0, 0.0, 3), (2, 300.0, 170.0, -110.0, 5), (3, -5000.0, 2500.0, 1.0, 4), (4, 999999.0, 0.0, 0.0, 1), (5, 123.0, -4567.0, 8901.0, 2)]
    points = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z"), F.lit(at).alias("at_level")) for i, x, y, z, at in asked))))
    return search.find_nodes(points, layout.node_set(cells(spark, sf_dir)), LEVELS).select("i", "level", "node_id")


_STATS = f"""{_SHELL}, cells AS (SELECT level, node_id, 16 * count(*) AS payload_len, count(*) AS star_count, node_id << (3 * (21 - level)) AS dfs_key FROM enriched WHERE mag_abs IS NOT NULL GROUP BY level, node_id), {NODES},
touched AS (SELECT n.level, c.payload_len, c.dfs_key FROM ({_where("nodes")}) n LEFT JOIN cells c USING (level, node_id) WHERE {_box(POINT)} <= {_LOAD}),
a AS (SELECT coalesce(level, -1) AS level, count(*) AS nodes, coalesce(sum(payload_len), 0)::BIGINT AS payload_bytes FROM touched GROUP BY ROLLUP (level)),
b AS (SELECT coalesce(level, -1) AS level, count(*) AS stars_loaded, count(*) FILTER (apparent_magnitude <= {MAGNITUDE}) AS stars_rendered, quantile_cont(magnitude, [0, 0.25, 0.5, 0.75, 1]) AS q FROM seen GROUP BY ROLLUP (level)),
stats AS (SELECT level, nodes, coalesce(stars_loaded, 0) AS stars_loaded, coalesce(stars_rendered, 0) AS stars_rendered, payload_bytes, q[1] AS mag_min, q[2] AS mag_p25, q[3] AS mag_p50, q[4] AS mag_p75, q[5] AS mag_max FROM a LEFT JOIN b USING (level))"""
_MAGS = ("mag_min", "mag_p25", "mag_p50", "mag_p75", "mag_max")


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir)
    return search.shell_levels(layout.node_set(df), rows(spark, sf_dir), POINT, MAGNITUDE, LEVELS, cells=df, scan=True)


@query(f"WITH {_STATS} SELECT level, nodes, stars_loaded, stars_rendered, payload_bytes FROM stats WHERE level >= 0")
def shell_level_stats(spark, sf_dir):
    return _stats(spark, sf_dir).where("level >= 0").select("level", "nodes", "stars_loaded", "stars_rendered", "payload_bytes")


@query(f"WITH {_STATS} SELECT level, {', '.join(f'round({c}, 6) AS {c}' for c in _MAGS)} FROM stats WHERE level >= 0")
def level_quantiles(spark, sf_dir):
    known = [F.when(~F.isnan(c), F.round(c, 6)).alias(c) for c in _MAGS]
    return _stats(spark, sf_dir).where("level >= 0").select("level", *known)


@query(f"WITH {_STATS} SELECT level, nodes, stars_loaded, stars_rendered, payload_bytes, {', '.join(f'round({c}, 6) AS {c}' for c in _MAGS)} FROM stats")
def stats_rollup(spark, sf_dir):
    known = [F.when(~F.isnan(c), F.round(c, 6)).alias(c) for c in _MAGS]
    return _stats(spark, sf_dir).select("level", "nodes", "stars_loaded", "stars_rendered", "payload_bytes", *known)


@query(f"WITH {_STATS} SELECT level, format('{{:,}} KB', round_even(payload_bytes / 1024.0::DOUBLE, 0)::BIGINT) AS size, printf('%.1f MB', payload_bytes / 1048576.0::DOUBLE) AS compact FROM stats")
def stats_format(spark, sf_dir):
    return _stats(spark, sf_dir).select("level", text.kilobytes(F.col("payload_bytes")).alias("size"), text.megabytes(F.col("payload_bytes")).alias("compact"))


_TOUCHED = f"""{CELLS}, spot AS ({_where("(SELECT *, " + FOUND + " FROM cells)")}), r AS (SELECT output_offset AS s, output_offset + payload_len AS e FROM spot WHERE {_box(POINT)} <= {_LOAD} AND payload_len > 0),
m AS (SELECT *, max(e) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r)"""
_REPORT = "coalesce(sum(n), 0)::BIGINT AS input_ranges, count(*) AS output_batches, coalesce(sum(raw), 0)::BIGINT AS raw_payload_bytes, coalesce(sum(span), 0)::BIGINT AS total_span_bytes, coalesce(max(span), 0)::BIGINT AS largest_batch_bytes"


@query(f"""WITH {_TOUCHED}, g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {GAP} THEN 1 ELSE 0 END) OVER (ORDER BY s) AS island FROM m),
i AS (SELECT island, count(*) AS n, sum(e - s) AS raw, max(e) - min(s) AS span FROM g GROUP BY island) SELECT {_REPORT} FROM i""")
def coalesce_ranges(spark, sf_dir):
    placed = layout.payload_offsets(cells(spark, sf_dir))
    return search.coalesce_ranges(placed.where(search.in_shell(POINT, MAGNITUDE, LEVELS)), GAP)


@query(f"""WITH {_TOUCHED}, tried(gap) AS (VALUES (0), (16), (256), (4096), (65536)), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + gap THEN 1 ELSE 0 END) OVER (PARTITION BY gap ORDER BY s) AS island FROM m, tried),
i AS (SELECT gap, island, count(*) AS n, sum(e - s) AS raw, max(e) - min(s) AS span FROM g GROUP BY gap, island) SELECT gap, {_REPORT} FROM i GROUP BY gap""")
def coalesce_gaps(spark, sf_dir):
    touched = layout.payload_offsets(cells(spark, sf_dir)).where(search.in_shell(POINT, MAGNITUDE, LEVELS))
    return functools.reduce(DataFrame.unionByName, (search.coalesce_ranges(touched, gap).withColumn("gap", F.lit(gap)) for gap in (0, 16, 256, 4096, 65536)))


# --- diffuse light -----------------------------------------------------------------------------------------------

_LOG_T = "log10(least(greatest(teff_s, 2900.0::DOUBLE), 52000.0::DOUBLE))"


def _horner(terms: str) -> str:
    """SQL of a polynomial in lt, of terms with the highest power first."""
    first, *rest = terms.split()
    return functools.reduce(lambda total, term: f"({total} * lt + ({term})::DOUBLE)", rest, f"({first})::DOUBLE")


_HOT = _horner("0.788731721804990e02 -0.170587278406872e04 0.147412923562646e05 -0.636233812100225e05 0.137145973583929e06 -0.118115450538963e06")
_WARM = _horner("-0.170623810323864e03 0.261724637119416e04 -0.150651486316025e05 0.385672629965804e05 -0.370510203809015e05")
_COOL = _horner("0.381476328422343e03 -0.421278819301717e04 0.155144866764412e05 -0.190537291496456e05")
_RED = "CASE WHEN t <= 66 THEN 255.0::DOUBLE ELSE 329.698727446::DOUBLE * pow(t - 60, -0.1332047592::DOUBLE) END"
_GREEN = "CASE WHEN t <= 66 THEN 99.4708025861::DOUBLE * ln(t) - 161.1195681661::DOUBLE ELSE 288.1221695283::DOUBLE * pow(t - 60, -0.0755148492::DOUBLE) END"
_BLUE = "CASE WHEN t >= 66 THEN 255.0::DOUBLE WHEN t <= 19 THEN 0.0::DOUBLE ELSE 138.5177312231::DOUBLE * ln(t - 10) - 305.0447927307::DOUBLE END"
_LINEAR = ", ".join(f"pow(least(greatest({c}, 0.0::DOUBLE), 255.0::DOUBLE) / 255.0::DOUBLE, 2.2::DOUBLE) AS {n}" for c, n in ((_RED, "r"), (_GREEN, "g"), (_BLUE, "b")))
_GLOW = f"""{ENRICHED},
warm AS (SELECT level, node_id, mag_abs, teff_s, {_LOG_T} AS lt, teff_s / 100.0::DOUBLE AS t FROM enriched WHERE isfinite(mag_abs)),
lit AS (SELECT *, pow(10.0::DOUBLE, (4.74::DOUBLE - (mag_abs + CASE WHEN lt >= 3.9::DOUBLE THEN {_HOT} WHEN lt >= 3.7::DOUBLE THEN {_WARM} ELSE {_COOL} END)) / 2.5::DOUBLE) AS l, {_LINEAR} FROM warm),
massed AS (SELECT *, least(greatest(CASE WHEN l < 0.033 THEN pow(l, {1 / 2.3!r}::DOUBLE) WHEN l < 16.0 THEN pow(l, 0.25::DOUBLE) WHEN l < 1e5 THEN pow(l, {1 / 3.5!r}::DOUBLE) ELSE l END, 0.08), 150.0) AS m FROM lit),
leaf AS (SELECT level, node_id, count(*) AS n, sum(l) AS lum, sum(l * r) AS lum_r, sum(l * g) AS lum_g, sum(l * b) AS lum_b, sum(m) AS mass, sum(l * teff_s) AS lum_teff FROM massed GROUP BY level, node_id),
tree AS (SELECT k AS level, node_id >> (3 * (level - k)) AS node_id, sum(n)::BIGINT AS n, sum(lum) AS lum, sum(lum_r) AS lum_r, sum(lum_g) AS lum_g, sum(lum_b) AS lum_b, sum(mass) AS mass, sum(lum_teff) AS lum_teff
  FROM (SELECT *, unnest(range(0, level + 1)) AS k FROM leaf) GROUP BY 1, 2)"""


@query(f"WITH {_GLOW} SELECT level, node_id, n, round(log10(lum), 6) AS lum, round(mass, 4) AS mass FROM leaf")
def glow_leaf(spark, sf_dir):
    return glow.glow_leaves(rows(spark, sf_dir)).select("level", "node_id", "n", F.round(F.log10("lum"), 6).alias("lum"), F.round("mass", 4).alias("mass"))


@query(f"WITH {_GLOW} SELECT level, node_id, n, round(log10(lum), 6) AS lum, round(mass, 4) AS mass FROM tree")
def glow_rollup(spark, sf_dir):
    df = glow.glow_rollup(glow.glow_leaves(rows(spark, sf_dir)))
    return df.select("level", "node_id", "n", F.round(F.log10("lum"), 6).alias("lum"), F.round("mass", 4).alias("mass"))


@query(f"WITH {_GLOW} SELECT level, node_id, n, round(lum_r / lum, 6) AS mean_r, round(lum_g / lum, 6) AS mean_g, round(lum_b / lum, 6) AS mean_b, round(lum_teff / lum, 4) AS mean_teff, round(mass / n, 6) AS mean_mass FROM tree")
def glow_means(spark, sf_dir):
    df = glow.glow_means(glow.glow_rollup(glow.glow_leaves(rows(spark, sf_dir))))
    return rounded(rounded(df, "mean_r", "mean_g", "mean_b", "mean_mass"), "mean_teff", places=4)



# --- binary artifacts: written from the catalogue, read back from their bytes -------------------------------------

_BUILT: dict[tuple[str, str], dict[str, str]] = {}


def built(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of the tree file, the intermediates' manifest, the identities file and the meta sidecar of the catalogue."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        folder = Path(shared_folder(spark).removeprefix("file://")) / f"artifacts-{uuid.uuid4().hex}"
        whole = stored(spark, f"aggregated {sf_dir}", lambda: C.aggregate_cells(rows(spark, sf_dir)))
        render, names = (stored(spark, f"{kind} payloads {sf_dir}", lambda k=kind: artifacts.encode_payloads(whole, k)) for kind in ("render", "identifiers"))
        header = artifacts.write_tree(render, str(folder / "stars"), LEVELS, uuid.uuid4())
        artifacts.write_identities(names, str(folder / "identities"), header.dataset_uuid, DEEP_FROM, PREFIX_BITS)
        said = artifacts.encode_payloads(meta.cell_meta(artifacts.read_identities(spark, str(folder / "identities")), identifiers(spark, sf_dir)), "sidecar")
        artifacts.write_tree(said, str(folder / "meta"), LEVELS, parent_uuid=header.dataset_uuid, sidecar_kind="meta")
        _BUILT[key] = {
            "tree": str(folder / "stars"), "identities": str(folder / "identities"), "meta": str(folder / "meta"),
            "manifest": artifacts.write_intermediates(render, str(folder / "shards"), "render", LEVELS, DEEP_FROM, PREFIX_BITS),
        }
    return _BUILT[key]


@query(f"SELECT 'render' AS artifact_kind, 13 AS max_level, 16 AS record_size, 200000.0::DOUBLE AS half_size, 6.5::DOUBLE AS mag_limit, true AS index_at_end")
def tree_header(spark, sf_dir):
    path = built(spark, sf_dir)["tree"]
    h = artifacts.read_header(path)
    whole = h.index_offset + h.index_length == Path(path).stat().st_size
    said = {"artifact_kind": h.artifact_kind, "max_level": h.max_level, "record_size": h.record_size, "half_size": h.world_half_size, "mag_limit": h.mag_limit, "index_at_end": whole}
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in said.items()))


@query(f"WITH {SHARDED} SELECT level, node_id, child_mask, flags, has_payload FROM shard_nodes")
def tree_nodes(spark, sf_dir):
    nodes = artifacts.read_nodes(spark, built(spark, sf_dir)["tree"])
    return nodes.select("level", "node_id", "child_mask", "flags", (F.col("payload_length") > 0).alias("has_payload"))


@query(f"WITH {DECODED} SELECT level, node_id, row_number() OVER (PARTITION BY level, node_id ORDER BY mag_abs, source_id, source) - 1 AS ordinal, x, y, z, magnitude, teff8 FROM decoded")
def tree_stars(spark, sf_dir):
    stars_ = search.decode(artifacts.read_stars(spark, built(spark, sf_dir)["tree"]), LEVELS.half_size)
    return stars_.select("level", "node_id", "ordinal", "x", "y", "z", "magnitude", "teff8")


@query(f"WITH {DECODED}, seen AS (SELECT *, {_pc(POINT)} AS distance_pc FROM decoded WHERE {_box(POINT)} <= {_LOAD}) SELECT level, count(*) AS stars_loaded, count(*) FILTER ({_APPARENT} <= {MAGNITUDE}) AS stars_rendered FROM seen GROUP BY level")
def tree_shell(spark, sf_dir):
    """Only the payloads of touched nodes are read."""
    path = built(spark, sf_dir)["tree"]
    nodes = artifacts.read_nodes(spark, path).where(search.in_shell(POINT, MAGNITUDE, LEVELS))
    seen = search.from_point(search.decode(artifacts.read_stars(spark, path, nodes), LEVELS.half_size), POINT)
    return seen.groupBy("level").agg(F.count("*").alias("stars_loaded"), F.count_if(F.col("apparent_magnitude") <= MAGNITUDE).alias("stars_rendered"))


@query(f"WITH {_SHARD_SQL} SELECT level, prefix_bits, prefix, count(*) AS record_count FROM split GROUP BY 1, 2, 3")
def manifest_entries(spark, sf_dir):
    said = json.loads(Path(built(spark, sf_dir)["manifest"]).read_text())
    entries = [(lv["level"], s["prefix_bits"], s["prefix"], s["record_count"]) for lv in said["levels"] for s in lv["shards"]]
    return spark.createDataFrame(entries, "level int, prefix_bits int, prefix long, record_count long")


@query(f"WITH {CELLS} SELECT level, node_id, star_count FROM cells")
def intermediate_records(spark, sf_dir):
    return artifacts.read_intermediates(spark, built(spark, sf_dir)["manifest"]).where("payload_len = length(payload)").select("level", "node_id", "star_count")


@query(f"WITH {ENRICHED} SELECT level, node_id, row_number() OVER (PARTITION BY level, node_id ORDER BY mag_abs, source_id, source) - 1 AS ordinal, source, source_id FROM enriched WHERE mag_abs IS NOT NULL")
def identity_rows(spark, sf_dir):
    return artifacts.read_identities(spark, built(spark, sf_dir)["identities"])


@query(f"WITH {ENRICHED}, {IDS} SELECT level, node_id, row_number() OVER (PARTITION BY level, node_id ORDER BY mag_abs, e.source_id, e.source) - 1 AS ordinal, e.source, e.source_id, hip_id, hd, constellation, proper_name FROM enriched e LEFT JOIN ids i ON e.source = i.source AND e.source_id = i.source_id WHERE mag_abs IS NOT NULL")
def sidecar_rows(spark, sf_dir):
    paths = built(spark, sf_dir)
    artifacts.check_sidecar(artifacts.read_header(paths["tree"]), artifacts.read_header(paths["meta"]))
    return meta.parse_meta(artifacts.read_meta(spark, paths["meta"])).select("level", "node_id", "ordinal", "source", "source_id", "hip_id", "hd", "constellation", "proper_name")
