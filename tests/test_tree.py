"""Rules of levels, cells and layout on small cases, with a slow tree walk as a second opinion."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyshuffle.functions import morton as M
from skyshuffle.functions import text
from skyshuffle.functions.levels import Levels
from skyshuffle.operators import cells as C
from skyshuffle.operators import enrich as E
from skyshuffle.operators import layout, meta, search
from skyshuffle.plans.prune import around, prefix_range
from skyshuffle.sources import catalog

STAR = "source string, source_id string, x_icrs_pc double, y_icrs_pc double, z_icrs_pc double, mag_abs double, teff double"


def _cells(spark, keys):
    return spark.createDataFrame([(lv, n, 1, 16) for lv, n in keys], "level int, node_id long, star_count long, payload_len long")


def test_levels_close_above():
    levels = Levels()
    top = levels.limit(3)
    assert levels.level_of(top) == 3 and levels.level_of(math.nextafter(top, 99)) == 4
    assert levels.level_of(math.nan) == levels.last == 13 and levels.level_of(-99.0) == 0
    assert Levels(max_level=None).limit(Levels(max_level=None).last) > 25


def test_morton_round_trip_and_clipping(spark):
    df = spark.createDataFrame([(0, 1, 2), (2097151, 5, 1048576), (123456, 654321, 999999)], "a long, b long, c long")
    code = M.spread(F.col("a")).bitwiseOR(M.shift_left(M.spread(F.col("b")), 1)).bitwiseOR(M.shift_left(M.spread(F.col("c")), 2))
    for r in df.select("a", "b", "c", code.alias("m")).select("*", *(M.grid(F.col("m"), k).alias(f"g{k}") for k in range(3))).collect():
        assert (r.a, r.b, r.c) == (r.g0, r.g1, r.g2)
        assert r.m == sum(((v >> b) & 1) << (3 * b + k) for k, v in enumerate((r.a, r.b, r.c)) for b in range(21))
    edge = spark.createDataFrame([(-1e9,), (1e9,)], "v double").select(M.quantise(F.col("v")).alias("q"))
    assert [r.q for r in edge.collect()] == [0, 2097151]


def test_nan_magnitude_stays_and_null_goes(spark):
    stars = spark.createDataFrame([("gaia", "1", 1.0, 2.0, 3.0, math.nan, None), ("gaia", "2", 1.0, 2.0, 3.0, None, 3.0)], STAR)
    found = C.cell_rows(E.enrich_fields(stars)).select("source_id", "level", "mag_centi", "teff8").collect()
    assert [(r.source_id, r.level, r.mag_centi) for r in found] == [("1", 13, 9900)]


def test_unknown_position_is_an_error(spark):
    stars = spark.createDataFrame([("gaia", "1", math.nan, 2.0, 3.0, 1.0, None)], STAR)
    with pytest.raises(Exception, match="x_icrs_pc is unknown"):
        E.enrich_fields(stars).collect()
    with pytest.raises(ValueError, match="mag_abs"):
        E.enrich_fields(stars.drop("mag_abs"))


def test_render_bytes(spark):
    stars = spark.createDataFrame([("gaia", "1", 10.0, -20.0, 30.0, 4.83, 5772.0)], STAR)
    row = E.enrich(stars).first()
    fields = E.enrich_fields(stars).first()
    assert len(row["render"]) == 16
    import numpy as np

    packed = np.frombuffer(row["render"], E.STAR)[0]
    assert (packed["mag"], packed["teff"]) == (483, fields["teff8"]) and abs(packed["x"] - fields["rel_x"]) < 1e-7


def test_order_within_cells_breaks_ties_by_source(spark):
    stars = spark.createDataFrame([("hip", "7", 0.0, 0.0, 0.0, 1.0, None), ("gaia", "7", 0.0, 0.0, 0.0, 1.0, None), ("gaia", "3", 0.0, 0.0, 0.0, 1.0, None)], STAR)
    rows = C.identities(C.aggregate_cells(C.cell_rows(E.enrich_fields(stars)))).orderBy("ordinal").collect()
    assert [(r.source, r.source_id) for r in rows] == [("gaia", "3"), ("gaia", "7"), ("hip", "7")]


def test_preorder_of_the_small_case(spark):
    placed = layout.payload_offsets(_cells(spark, [(1, 1), (2, 0), (0, 0), (1, 0)])).orderBy("output_offset").collect()
    assert [(r.level, r.node_id) for r in placed] == [(0, 0), (1, 0), (2, 0), (1, 1)]
    assert [r.output_offset for r in placed] == [192, 208, 224, 240]


def test_shard_keys(spark):
    keys = C.with_shard(_cells(spark, [(2, 40), (2, 47), (2, 48), (0, 0)]), 0, 3).collect()
    assert {(r.level, r.node_id): (r.prefix_bits, r.prefix) for r in keys} == {(2, 40): (3, 5), (2, 47): (3, 5), (2, 48): (3, 6), (0, 0): (0, 0)}


def _walk(cells):
    """Preorder and shards by recursion, as the format describes them."""
    nodes = {(k, n >> (3 * (lv - k))) for lv, n in cells for k in range(lv + 1)}
    order, shards = [], []

    def visit(lv, n):
        order.append((lv, n))
        for o in range(8):
            if (lv + 1, n * 8 + o) in nodes:
                visit(lv + 1, n * 8 + o)

    def shard(lv, n):
        own, wave = [], [(lv, n)] if lv >= 0 else []
        tops = [(lv + 1, n * 8 + o) for o in range(8)] if lv >= 0 else [(0, 0)]
        wave = [t for t in tops if t in nodes]
        for _ in range(5):
            own += wave
            last, wave = wave, [(a + 1, b * 8 + o) for a, b in wave for o in range(8) if (a + 1, b * 8 + o) in nodes]
        if own:
            shards.append(((lv, n), own))
            for a, b in [x for x in own if x[0] == lv + 5]:
                shard(a, b)

    visit(0, 0)
    shard(-1, 0)
    return [x for x in order if x in cells], shards


@pytest.mark.parametrize("seed", range(4))
def test_closed_form_layout_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    cells = {(lv, rng.randrange(8**lv) if rng.random() < 0.6 else rng.randrange(min(8**lv, 9))) for lv in [rng.randint(0, 12) for _ in range(60)]}
    order, shards = _walk(cells)
    df = _cells(spark, sorted(cells))
    placed = layout.payload_offsets(df).orderBy("output_offset").collect()
    assert [(r.level, r.node_id) for r in placed] == order
    nodes = layout.shard_nodes(df)
    heads = layout.shard_headers(nodes, 1000).orderBy("shard_id").collect()
    assert [((r.parent_level, r.parent_node), r.node_count) for r in heads] == [(k, len(v)) for k, v in shards]
    at = 1000
    for r in heads:
        assert r.shard_offset == at
        at += r.shard_bytes
    mine = {}
    for r in nodes.orderBy("node_index").collect():
        mine.setdefault((r.parent_level, r.parent_node), []).append((r.level, r.node_id))
        assert r.contiguous
    assert mine == {k: v for k, v in shards}


def test_prune_covers_the_sphere(spark):
    ranges = around((300.0, 170.0, -110.0), 500.0, 8)
    df = spark.createDataFrame([(300.0 + dx, 170.0 + dy, -110.0 + dz) for dx in (-499, 0, 499) for dy in (-499, 0, 499) for dz in (-499, 0, 499)], "x double, y double, z double")
    codes = [r.m for r in df.select(M.morton_code(F.col("x"), F.col("y"), F.col("z")).alias("m")).collect()]
    assert all(any(a <= m <= b for a, b in ranges) for m in codes)
    assert prefix_range(7, 3) == (7 << 60, (8 << 60) - 1)


def test_identifier_map_last_row_wins_and_blanks_go(spark):
    known = spark.createDataFrame([("gaia", "1", "5", "  ", 1), ("gaia", "1", "6", " Sol ", 2)], "source string, source_id string, hd string, proper_name string, row long")
    one = meta.last_wins(known).collect()
    assert [(r.hd, r.proper_name) for r in one] == [(6, "Sol")]
    rows = spark.createDataFrame([(0, 0, 0, "gaia", "1"), (0, 0, 1, "gaia", "2")], "level int, node_id long, ordinal int, source string, source_id string")
    made = meta.cell_meta(rows, known).first()
    assert made["meta"] == '[{"source":"gaia","source_id":"1","hd":6,"proper_name":"Sol"},{"source":"gaia","source_id":"2"}]'
    with pytest.raises(ValueError):
        meta.build_family("other", rows, known)


def test_labels(spark):
    kinds = "source string, source_id string, gaia_source_id long, hip_id long, hd long, bayer string, flamsteed long, constellation string, proper_name string"
    rows = [("gaia", "123", *[None] * 7), ("hip", "42", *[None] * 7), ("manual", "s1", None, None, None, "Alp", None, "Cen", "Rigil"), ("x", "y", 9, 8, 7, None, 61, "Cyg", None)]
    df = spark.createDataFrame(rows, kinds)
    got = [r[0] for r in df.select(text.identifier_label(F.struct(*df.columns))).collect()]
    assert got == ["Gaia 123", "HIP 42", "Rigil | Alp Cen", "HIP 8 | HD 7 | Gaia 9 | 61 Cyg"]


def test_radius_must_not_be_negative(spark):
    with pytest.raises(ValueError):
        search.stars_within_distance(spark.range(0), (0, 0, 0), -1.0)


def test_exact_search_finds_no_less(spark):
    rows = C.cell_rows(E.enrich_fields(catalog.derive_stars(spark.range(3000).withColumnRenamed("id", "o_orderkey"))))
    point = (300.0, 170.0, -110.0)
    everything = search.from_point(search.decode(rows), point).where("apparent_magnitude <= 8").count()
    assert search.stars_brighter_than(rows, point, 8.0, exact=True).count() == everything
    assert search.stars_brighter_than(rows, point, 8.0).count() <= everything


def test_coalescing_by_gap(spark):
    ranges = spark.createDataFrame([(i, 0, s, n) for i, (s, n) in enumerate([(0, 10), (12, 5), (100, 1), (200, 0)])], "dfs_key long, level int, output_offset long, payload_len long")
    assert list(search.coalesce_ranges(ranges, 2).first()) == [3, 2, 16, 18, 17]
    assert list(search.coalesce_ranges(ranges.limit(0), 2).first()) == [0, 0, 0, 0, 0]


def test_light_of_stars(spark):
    """Corrections and masses as published: the sun, ends of the fit, surface gravity; what shines without a magnitude."""
    from skyshuffle.operators import glow

    inf, nan = float("inf"), float("nan")
    stars = [(4.83, 5772.0, 4.438), (4.83, 5772.0, None), (4.83, 5772.0, nan), (4.83, 5772.0, -1.0), (4.83, 5772.0, 9.5), (-20.0, 5772.0, None), (20.0, 5772.0, None), (4.83, 500.0, None), (4.83, 2900.0, None), (4.83, nan, None), (inf, 5772.0, None), (nan, 5772.0, None), (None, 5772.0, None)]
    df = spark.createDataFrame([(k, 0, *s) for k, s in enumerate(stars)], "node_id long, level int, mag_abs double, teff double, log_g double")
    got = {r["node_id"]: r for r in glow.glow_leaves(df).collect()}
    assert sorted(got) == list(range(10))
    assert abs(got[0]["lum"] - 1) < 0.02 and abs(got[0]["mass"] - 1) < 0.03
    plain = min(max(got[1]["lum"] ** 0.25, 0.08), 150)
    assert all(abs(got[k]["mass"] - plain) < 1e-9 for k in (1, 2, 3, 4))
    assert got[5]["mass"] == 150 and got[6]["mass"] == 0.08 and got[7]["lum"] == got[8]["lum"]
    assert got[7]["lum_b"] == 0 and got[7]["lum_r"] == got[7]["lum"] and abs(got[9]["lum_teff"] / got[9]["lum"] - 5800) < 1e-6
    assert {r["n"] for r in got.values()} == {1}
