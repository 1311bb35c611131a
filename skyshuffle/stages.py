"""The four build stages of a project, and the statistics report."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .operators import cells as C
from .operators import enrich as E
from .operators import meta, search
from .project import Project
from .sources import artifacts, catalog, formats

RENDER_MANIFEST, IDENTIFIERS_MANIFEST = "render-manifest.json", "identifiers-manifest.json"


def stage00(spark: SparkSession, project: Project, force: bool = False) -> int:
    """Enriches the catalogue's pixels that are not yet in the output; the number of pixels written."""
    out = project.paths["stage00_output_dir"]
    stars = catalog.read_pixels(spark, str(project.paths["merged_healpix_dir"]))
    done = [] if force or not out.exists() else [p.name.removeprefix("pixel=") for p in out.iterdir() if p.name.startswith("pixel=") and any(p.glob("*.parquet"))]
    if done:
        stars = E.pending(stars, spark.createDataFrame([(d,) for d in done], "pixel string"))
    todo = stars.select("pixel").distinct().count()
    if todo:
        E.write_pixels(E.enrich(stars, project.levels), str(out))
    return todo


def _aggregated(spark: SparkSession, project: Project) -> DataFrame:
    rows = C.cell_rows(catalog.read_enriched(spark, project.settings["stage01"]["input_glob"]))
    rows = E.with_render_fields(E.with_node(catalog.default_teff(rows)), project.levels)
    return C.aggregate_cells(rows)


def stage01(spark: SparkSession, project: Project) -> tuple[str, str]:
    """Writes render and identifiers intermediates from one aggregation. A finished folder of the same settings is kept."""
    out, deep = project.paths["stage01_output_dir"], (project.settings["stage01"]["deep_shard_from_level"], project.settings["stage01"]["deep_prefix_bits"])
    manifests = (out / RENDER_MANIFEST, out / IDENTIFIERS_MANIFEST)
    if all(m.exists() for m in manifests):
        for said in (json.loads(m.read_text()) for m in manifests):
            if said["max_level"] != project.levels.last:
                raise ValueError(f"{out} was built with another max_level")
            split = {(lv["level"], s["prefix_bits"]) for lv in said["levels"] for s in lv["shards"]}
            if any(bits != (min(deep[1], 3 * level) if level >= deep[0] and level > 0 else 0) for level, bits in split):
                raise ValueError(f"{out} was built with another deep_shard_from_level or deep_prefix_bits")
        return tuple(map(str, manifests))
    if out.exists() and any(p.suffix in (".index", ".payload") for p in out.iterdir()) and not any(m.exists() for m in manifests):
        raise ValueError(f"{out} holds shards without a manifest")
    cells = artifacts.stored(spark, f"cells {uuid.uuid4()}", lambda: _aggregated(spark, project))
    return tuple(artifacts.write_intermediates(artifacts.encode_payloads(cells, kind), str(out), kind, project.levels, *deep) for kind in ("render", "identifiers"))


def stage02(spark: SparkSession, project: Project) -> formats.TreeHeader:
    """Writes the tree file and the identities file from the intermediates."""
    folder = project.paths["stage01_output_dir"]
    render, identities = (artifacts.read_intermediates(spark, str(folder / m)) for m in (RENDER_MANIFEST, IDENTIFIERS_MANIFEST))
    deep = (project.settings["stage01"]["deep_shard_from_level"], project.settings["stage01"]["deep_prefix_bits"])
    shards = [C.shard_manifest(C.with_shard(p, *deep)) for p in (render, identities)]
    if C.manifest_differences(*shards).take(1):
        raise ValueError("Render and identifiers intermediates do not hold the same cells")
    header = artifacts.write_tree(render, str(project.paths["stage02_output_path"]), project.levels, uuid.uuid4())
    artifacts.write_identities(identities, str(project.paths["identifiers_order_output_path"]), header.dataset_uuid, *deep)
    return header


def stage03(spark: SparkSession, project: Project, family: str | None = None) -> list[str]:
    """Writes the sidecars of all families, or of one, and their manifest."""
    if family is not None and family not in project.sidecars:
        raise ValueError(f"The project has no sidecar {family!r}")
    tree = artifacts.read_header(str(project.paths["stage02_output_path"]))
    identities = artifacts.read_identities(spark, str(project.paths["identifiers_order_output_path"]))
    out, entries = project.paths["stage03_output_dir"], []
    for name in [family] if family else project.sidecars:
        known = catalog.read_identifiers(spark, str(project.paths["identifiers_map_path"]), project.sidecars[name] or None)
        payloads = artifacts.encode_payloads(meta.build_family(name, identities, known), "sidecar")
        path = out / f"{name}.tree"
        header = artifacts.write_tree(payloads, str(path), project.levels, parent_uuid=tree.dataset_uuid, sidecar_kind=name)
        entries.append({"name": name, "path": str(path), "sidecar_uuid": str(header.sidecar_uuid)})
    said = {"format": formats.SIDECARS_FORMAT, "render_octree_path": str(project.paths["stage02_output_path"]), "identifiers_order_path": str(project.paths["identifiers_order_output_path"]), "parent_dataset_uuid": str(tree.dataset_uuid), "sidecars": entries}
    Path(out, "sidecars-manifest.json").write_text(json.dumps(said, indent=2) + "\n")
    return [e["path"] for e in entries]


def statistics(spark: SparkSession, tree: str, point: search.Point, magnitude: float = 6.5, radius: float = 10.0, top: int = 10, meta_tree: str | None = None) -> dict[str, DataFrame]:
    """levels, ranges and nearest of a tree file: DataFrames as the report shows them."""
    from .functions.levels import Levels

    header = artifacts.read_header(tree)
    levels = Levels(v_mag=header.mag_limit, half_size=header.world_half_size, max_level=header.max_level)
    nodes = artifacts.read_nodes(spark, tree)
    stars = artifacts.read_stars(spark, tree, nodes.where(search.in_shell(point, magnitude, levels)))
    held = nodes.where("payload_length > 0").withColumn("payload_len", F.col("payload_length"))
    out = {"levels": search.shell_levels(nodes, stars, point, magnitude, levels, cells=held).orderBy(F.col("level") < 0, "level")}
    touched = C.preorder(held.where(search.in_shell(point, magnitude, levels)))
    out["ranges"] = search.coalesce_ranges(touched, start="payload_offset")
    near = nodes.where(search.box(point, levels.half_size) <= radius)
    rows = artifacts.read_stars(spark, tree, near).withColumns({"mag_abs": F.col("ordinal"), "source_id": F.lit(""), "source": F.lit("")})  # canonical order is the stored one
    found = search.nearest(rows, point, radius, top, levels).drop("mag_abs", "source_id", "source")
    if meta_tree:
        sidecar = artifacts.read_header(meta_tree)
        artifacts.check_sidecar(header, sidecar)
        wanted = artifacts.read_nodes(spark, meta_tree).join(F.broadcast(found.select("level", "node_id").distinct()), ["level", "node_id"], "left_semi")  # at most `top` cells
        known = meta.parse_meta(artifacts.read_meta(spark, meta_tree, wanted))
        found = search.nearest_with_meta(found, known)
        fields = [c for c in known.columns if c not in ("level", "node_id", "ordinal")]
        found = found.withColumn("label", text.identifier_label(F.struct(*fields)))
    out["nearest"] = found.orderBy("distance_pc", "star_id")
    return out
