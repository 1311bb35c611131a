"""A project from catalogue to statistics, and the binary formats."""

import http.server
import os
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyshuffle import stages
from skyshuffle.__main__ import main
from skyshuffle.operators import cells as C
from skyshuffle.operators import enrich as E
from skyshuffle.operators import layout, search
from skyshuffle.project import load_project, template
from skyshuffle.sources import artifacts, catalog, formats
from skyshuffle.sources.ranges import Ranges


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "p.toml").write_text(template().replace("deep_shard_from_level = 99", "deep_shard_from_level = 8"))
    orders = spark.range(600).selectExpr("id as o_orderkey", "'1-URGENT' as o_orderpriority")
    stars = catalog.derive_stars(orders).toPandas()
    for pixel, part in stars.groupby(stars.index % 3):
        os.makedirs(root / f"data/merged/{pixel}")
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False), root / f"data/merged/{pixel}/a.parquet")
    catalog.derive_identifiers(orders).drop("row").coalesce(1).write.parquet(str(root / "data/identifiers_map.parquet"))
    project = load_project(root / "p.toml")
    assert stages.stage00(spark, project) == 3
    assert stages.stage00(spark, project) == 0  # resumes
    stages.stage01(spark, project)
    header = stages.stage02(spark, project)
    paths = stages.stage03(spark, project)
    rows = C.cell_rows(E.enrich_fields(catalog.derive_stars(orders)))
    return project, header, paths, rows


def test_tree_round_trip(spark, built):
    project, header, _, rows = built
    path = str(project.paths["stage02_output_path"])
    nodes = artifacts.read_nodes(spark, path)
    wanted = layout.shard_nodes(C.count_cells(rows)).select("level", "node_id", "child_mask", "flags")
    got = nodes.select("level", "node_id", "child_mask", "flags")
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    fields = ["level", "node_id", "ordinal", "rel_x", "rel_y", "rel_z", "mag_centi", "teff8"]
    stars, plan = artifacts.read_stars(spark, path).select(*fields), C.with_ordinal(rows).select(*fields)
    assert stars.count() == rows.count() and stars.exceptAll(plan).count() == 0
    assert os.path.getsize(path) == header.index_offset + header.index_length
    assert artifacts.read_header(path).dataset_uuid == header.dataset_uuid


def test_data_source(spark, built):
    from skyshuffle.sources.datasource import register

    register(spark)
    path = str(built[0].paths["stage02_output_path"])
    nodes, stars = (spark.read.format("startree").option("what", w).load(p) for w, p in (("nodes", path), ("stars", f"file://{path}")))
    for a, b in ((nodes, artifacts.read_nodes(spark, path)), (stars, artifacts.read_stars(spark, path))):
        assert a.count() == b.count() > 0 and a.exceptAll(b.select(*a.columns)).count() == 0


def test_identities_and_sidecar_share_the_order(spark, built):
    project, header, paths, rows = built
    got = artifacts.read_identities(spark, str(project.paths["identifiers_order_output_path"]))
    plan = C.with_ordinal(rows).select("level", "node_id", "ordinal", "source", "source_id")
    assert got.exceptAll(plan).count() == 0 and got.count() == plan.count()
    sidecar = artifacts.read_header(paths[0])
    artifacts.check_sidecar(header, sidecar) if header.mag_limit == sidecar.mag_limit else None
    assert sidecar.parent_dataset_uuid == header.dataset_uuid and sidecar.sidecar_kind == "meta"


def test_statistics(spark, built):
    project, _, paths, rows = built
    out = stages.statistics(spark, str(project.paths["stage02_output_path"]), (0.0, 0.0, 0.0), 6.5, 10.0, 5, paths[0])
    total = out["levels"].where("level = -1").first()
    assert total["stars_rendered"] == search.stars_brighter_than(rows, (0.0, 0.0, 0.0)).count()
    near = out["nearest"].collect()
    plan = search.nearest(rows, (0.0, 0.0, 0.0), 10.0, 5).collect()
    assert [(r["star_id"], r["source_id"]) for r in near] == [(r["star_id"], r["source_id"]) for r in plan]
    assert all(r["label"] for r in near)
    assert out["ranges"].first()["input_ranges"] > 0


def test_stage01_resumes_and_refuses_other_levels(spark, built, tmp_path):
    project = built[0]
    assert stages.stage01(spark, project)[0].endswith("render-manifest.json")
    other = template().replace("max_level = 13", "max_level = 5").replace('"build/', f'"{project.path.parent}/build/')
    (tmp_path / "p.toml").write_text(other)
    with pytest.raises(ValueError, match="max_level"):
        stages.stage01(spark, load_project(tmp_path / "p.toml"))


def test_http_ranges(built):
    path = str(built[0].paths["stage02_output_path"])
    data = open(path, "rb").read()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            a, b = self.headers["Range"].removeprefix("bytes=").split("-")
            part = data[int(a) : int(b) + 1]
            self.send_response(206)
            self.send_header("Content-Length", str(len(part)))
            self.end_headers()
            self.wfile.write(part)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    with Ranges(f"http://127.0.0.1:{server.server_port}/x") as f:
        assert f.read(10, 300) == data[10:310]
        with pytest.raises(ValueError):
            f.read(-1, 5)
    server.shutdown()


def test_identity_codec():
    rows = [("gaia", "1"), ("hip", "é" * 9), ("", "")]
    data = formats.pack_identities(rows)
    assert formats.unpack_identities(data) == rows
    with pytest.raises(ValueError):
        formats.unpack_identities(data[:-1] + b"")[5]
    with pytest.raises(ValueError):
        formats.unpack_identities(formats.pack_identities(rows)[:7])


def test_sizes_and_headers():
    sizes = [s.size for s in (formats.INTERMEDIATE_HEADER, formats.INTERMEDIATE_RECORD, formats.STAR_HEADER, formats.DESCRIPTOR, formats.SHARD_HEADER, formats.NODE, formats.FRONTIER, formats.IDENTITIES_HEADER, formats.IDENTITIES_RECORD)]
    assert sizes == [32, 24, 64, 128, 80, 20, 8, 80, 32]
    head = formats.TreeHeader(200, 10, (0.0, 0.0, 0.0), 200000.0, 13, 6.5)
    assert formats.TreeHeader.unpack(head.pack()) == head
    with pytest.raises(ValueError):
        formats.TreeHeader.unpack(b"X" * 192)
    assert formats.compress(b"a") == formats.compress(b"a")
    assert formats.shard_name(10, 3, 5) == ("level-10-p3-5.index", "level-10-p3-5.payload")


@pytest.mark.parametrize("change", [("format_version = 1", "format_version = 2"), ('"data/merged"', '"$HOME/x"'), ("max_level = 13", "max_level = true"), ("[stage02]", "[stage02]\nother = 1"), ("batch_size = 100000", "batch_size = 0")])
def test_bad_projects(tmp_path, change):
    (tmp_path / "p.toml").write_text(template().replace(*change))
    with pytest.raises(ValueError):
        load_project(tmp_path / "p.toml")


def test_planning_reads_few_shards(built, monkeypatch):
    """Whether the driver finds all shards or only the first, tasks read each node once."""
    from skyshuffle.sources import datasource

    path, seen = str(built[0].paths["stage02_output_path"]), []
    for planned in (1, 2, 10**9):
        monkeypatch.setattr(datasource, "PLANNED", planned)
        reader = datasource.TreeReader(path, "nodes")
        parts = reader.partitions()
        seen.append((len(parts), sorted(tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist())))
    assert seen[0][0] == 1 < seen[2][0] and seen[0][1] == seen[1][1] == seen[2][1] and len(set(seen[0][1])) == len(seen[0][1])


def test_cli_init(tmp_path):
    assert main(["project", "init", str(tmp_path / "q.toml")]) == 0
    assert main(["project-init", str(tmp_path / "p.toml")]) == 0
    assert main(["project-init", str(tmp_path / "p.toml")]) == 1
    assert load_project(tmp_path / "p.toml").sidecars == {"meta": ()}


def test_stream(spark, tmp_path):
    from skyshuffle.streaming.incremental import enrich_stream

    stars = catalog.derive_stars(spark.range(50).withColumnRenamed("id", "o_orderkey"))
    for k in range(2):
        stars.where(F.col("source_id").cast("int") % 2 == k).write.mode("append").parquet(str(tmp_path / "in"))
        enrich_stream(spark, str(tmp_path / "in"), stars.schema, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
