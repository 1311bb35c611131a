"""Tree files, sidecars, identities files and intermediate shards: writers and readers.

The layout comes from relational plans; the driver only streams rows that are already in file order to one file, one
partition at a time. Readers give DataFrames: executors read index shards and payloads by byte range.
"""

from __future__ import annotations

import gzip
import json
import logging
import os
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FILE_HEAD_BYTES, HAS_PAYLOAD, LEVELS_PER_SHARD, WORLD_CENTER
from ..functions.levels import Levels
from ..operators import cells as C
from ..operators import layout
from ..operators.enrich import STAR
from . import formats as fmt
from .ranges import Ranges, changed
from .store import stored

log = logging.getLogger(__name__)
RANGE_ROWS = 256  # frontier references or nodes that are turned into tasks at a time


# --- payloads ----------------------------------------------------------------------------------------------------


def _encoder(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(3):
                if kind == "sidecar":
                    data = json.dumps(json.loads(value.as_py()), separators=(",", ":")).encode()
                elif kind == "identifiers":
                    data = fmt.pack_identities([(s["source"], s["source_id"]) for s in value.as_py()])
                else:
                    stars = value.values
                    packed = np.zeros(len(stars), STAR)
                    for field, name in zip(STAR.names, ("rel_x", "rel_y", "rel_z", "mag_centi", "teff8"), strict=False):
                        packed[field] = stars.field(name).to_numpy(zero_copy_only=False)
                    data = packed.tobytes()
                out.append(fmt.compress(data))
            yield pa.record_batch([*batch.columns[:3], pa.array(out, pa.binary())], ["level", "node_id", "star_count", "payload"])

    return run


def encode_payloads(cells: DataFrame, kind: str = "render") -> DataFrame:
    """level, node_id, star_count, payload, payload_len: gzipped payloads of aggregated cells, or of sidecar cells (meta)."""
    value = "meta" if kind == "sidecar" else "stars"
    rows = cells.select("level", "node_id", F.col("star_count").cast("int"), value)
    return rows.mapInArrow(_encoder(kind), "level int, node_id long, star_count int, payload binary").withColumn("payload_len", F.length("payload").cast("long"))


# --- writers -----------------------------------------------------------------------------------------------------


def _publish(path: Path, write) -> None:
    """Writes a file beside its place and moves it there; a failed run leaves nothing."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with open(part, "wb") as out:
            write(out)
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)


def write_tree(payloads: DataFrame, path: str, levels: Levels | None = None, dataset_uuid: uuid.UUID | None = None, parent_uuid: uuid.UUID | None = None, sidecar_kind: str | None = None) -> fmt.TreeHeader:
    """Writes a tree file, or with sidecar_kind a sidecar of parent_uuid, from encoded payloads."""
    spark, levels = payloads.sparkSession, levels or Levels()
    placed = stored(spark, f"tree {uuid.uuid4()}", lambda: layout.payload_offsets(payloads))
    nodes = stored(spark, f"nodes {uuid.uuid4()}", lambda: layout.shard_nodes(placed.select("level", "node_id")))
    index_offset = FILE_HEAD_BYTES + (placed.agg(F.sum("payload_len")).first()[0] or 0)
    shards = layout.shard_headers(nodes, index_offset)
    if (worst := shards.agg(F.max("node_count")).first()[0] or 0) > 0xFFFF:
        raise ValueError(f"An index shard has more nodes than 16 bits count: {worst}")
    refs = layout.frontier_refs(nodes, shards)
    located = placed.select("level", "node_id", "output_offset", "payload_len")
    parent = nodes.where(F.col("local_depth") == LEVELS_PER_SHARD).select(F.col("level").alias("parent_level"), F.col("node_id").alias("parent_node"), F.col("node_index").alias("parent_index"), F.col("parent_level").alias("up_level"), F.col("parent_node").alias("up_node"))
    up = shards.select(F.col("parent_level").alias("up_level"), F.col("parent_node").alias("up_node"), F.col("shard_id").alias("parent_shard_id"))
    node = F.struct("node_index", "first_child", "local_path", "child_mask", "local_depth", "flags", F.coalesce("output_offset", F.lit(0)).alias("offset"), F.coalesce("payload_len", F.lit(0)).alias("length"))
    tables = nodes.join(located, ["level", "node_id"], "left").groupBy(*layout.SHARD).agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    frontier = refs.groupBy(*layout.SHARD).agg(F.array_sort(F.collect_list(F.struct("node_index", "child_offset"))).alias("refs"))
    whole = shards.join(tables, list(layout.SHARD)).join(frontier, list(layout.SHARD), "left").join(parent, list(layout.SHARD), "left").join(up, ["up_level", "up_node"], "left").orderBy("shard_id")
    index_length = shards.agg(F.sum("shard_bytes")).first()[0] or 0
    dataset = None if sidecar_kind else dataset_uuid or uuid.uuid4()
    header = fmt.TreeHeader(
        index_offset, index_length, WORLD_CENTER, levels.half_size, levels.last, levels.v_mag, artifact_kind="sidecar" if sidecar_kind else "render",
        dataset_uuid=dataset, parent_dataset_uuid=parent_uuid, sidecar_uuid=uuid.uuid4() if sidecar_kind else None, sidecar_kind=sidecar_kind,
    )

    def write(out) -> None:
        out.write(header.pack())
        for row in placed.orderBy("dfs_key", "level").select("payload").toLocalIterator():
            out.write(row[0])
        for s in whole.toLocalIterator():
            at = s["shard_offset"] + fmt.SHARD_HEADER.size
            grid = [0, 0, 0] if s["parent_level"] < 0 else [sum(((s["parent_node"] >> (3 * b + a)) & 1) << b for b in range(s["parent_level"])) for a in range(3)]
            out.write(fmt.SHARD_HEADER.pack(b"OSHR", 1, LEVELS_PER_SHARD, 0, s["shard_id"], s["parent_shard_id"] or 0, s["parent_index"] or 0, s["node_count"], 0, s["parent_level"], *grid, *(s[f"entry_{k}"] for k in range(8)), s["first_frontier_index"], at, at + fmt.NODE.size * s["node_count"], FILE_HEAD_BYTES))
            for n in s["nodes"]:
                out.write(fmt.NODE.pack(n["first_child"], n["local_path"], n["child_mask"], n["local_depth"], n["flags"], 0, n["offset"], n["length"]))
            for r in s["refs"] or []:
                out.write(fmt.FRONTIER.pack(r["child_offset"]))

    _publish(Path(path), write)
    return header


def write_intermediates(payloads: DataFrame, folder: str, kind: str, levels: Levels | None = None, deep_from: int = 99, prefix_bits: int = 3, family: str | None = None) -> str:
    """Writes one index and payload file a shard, and the manifest; the path of the manifest."""
    levels, out = levels or Levels(), Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    rows = C.shard_offsets(C.with_shard(payloads, deep_from, prefix_bits))
    shards: list[dict] = []
    index = payload = None

    def finish() -> None:
        nonlocal index, payload
        if index is None:
            return
        s = shards[-1]
        index.seek(0)
        index.write(fmt.INTERMEDIATE_HEADER.pack(fmt.MAGICS[kind], 1, fmt.INTERMEDIATE_HEADER.size, s["level"], s["prefix_bits"], fmt.GZIP_SORTED, fmt.INTERMEDIATE_RECORD.size, s["prefix"], s["record_count"]))
        index.close()
        payload.close()
        index = payload = None

    try:
        for r in rows.orderBy(*C.SHARD, "node_id").toLocalIterator():
            key = {k: r[k] for k in C.SHARD}
            if not shards or any(shards[-1][k] != v for k, v in key.items()):
                finish()
                names = shard_names = fmt.shard_name(*key.values(), family or kind)
                shards.append(key | {"index_path": names[0], "payload_path": shard_names[1], "record_count": 0})
                index, payload = open(out / names[0], "wb"), open(out / names[1], "wb")  # noqa: SIM115
                index.write(b"\0" * fmt.INTERMEDIATE_HEADER.size)
            index.write(fmt.INTERMEDIATE_RECORD.pack(r["node_id"], r["payload_offset"], r["payload_len"], r["star_count"]))
            payload.write(r["payload"])
            shards[-1]["record_count"] += 1
        finish()
    finally:
        for f in (index, payload):
            if f is not None:
                f.close()
    path = out / f"{family or kind}-manifest.json"
    _publish(path, lambda f: f.write(fmt.manifest(kind, shards, levels.last, levels.v_mag, WORLD_CENTER, levels.half_size).encode()))
    return str(path)


def read_intermediates(spark: SparkSession, manifest_path: str) -> DataFrame:
    """level, node_id, star_count, payload, payload_len of all shards of a manifest."""
    said = json.loads(Path(manifest_path).read_text())
    wanted = {"format": fmt.INTERMEDIATES_FORMAT, "payload_codec": "gzip", "index_header_struct": fmt.INTERMEDIATE_HEADER.format, "index_record_struct": fmt.INTERMEDIATE_RECORD.format}
    for key, value in wanted.items():
        if said.get(key) != value:
            raise ValueError(f"{manifest_path}: {key} is {said.get(key)!r}, not {value!r}")
    magic, folder = said["index_magic"].encode(), str(Path(manifest_path).parent)
    shards = [(lv["level"], s["index_path"], s["payload_path"], s["record_count"]) for lv in said["levels"] for s in lv["shards"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                found = list(fmt.read_records(Path(folder, s["index_path"]).read_bytes(), magic))
                if len(found) != s["record_count"]:
                    raise ValueError(f"{s['index_path']} has {len(found)} records, the manifest {s['record_count']}")
                with open(Path(folder, s["payload_path"]), "rb") as f:
                    for k in range(0, len(found), 4096):
                        rows = []
                        for node, offset, length, stars in found[k : k + 4096]:
                            f.seek(offset)
                            rows.append((s["level"], node, stars, f.read(length), length))
                        yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["level", "node_id", "star_count", "payload", "payload_len"])

    df = spark.createDataFrame(shards, "level int, index_path string, payload_path string, record_count int")
    return df.repartition(max(1, min(len(shards), 64))).mapInArrow(run, "level int, node_id long, star_count int, payload binary, payload_len long")


def write_identities(payloads: DataFrame, path: str, parent_uuid: uuid.UUID, deep_from: int = 99, prefix_bits: int = 3) -> None:
    """Writes the identities file from encoded identity payloads: header, directory, uncompressed payload, level-major."""
    rows = C.with_shard(payloads, deep_from, prefix_bits).orderBy(*C.SHARD, "node_id")

    def write(out) -> None:
        start, count, length = fmt.IDENTITIES_HEADER.size, payloads.count(), 0
        directory = start + count * fmt.IDENTITIES_RECORD.size
        out.seek(start)
        with open(out.name, "r+b") as cells:  # directory and payload grow side by side, each written through
            cells.seek(directory)
            for r in rows.select("level", "node_id", "star_count", "payload").toLocalIterator():
                data = gzip.decompress(r["payload"])
                out.write(fmt.IDENTITIES_RECORD.pack(r["level"], r["node_id"], r["star_count"], length, len(data)))
                cells.write(data)
                length += len(data)
        out.seek(0)
        out.write(fmt.IDENTITIES_HEADER.pack(b"OIOR", 1, start, parent_uuid.bytes, uuid.uuid4().bytes, start, directory - start, directory, length, count))

    _publish(Path(path), write)


def read_identities(spark: SparkSession, path: str) -> DataFrame:
    """level, node_id, ordinal, source, source_id of an identities file, read by ranges of its directory."""
    with Ranges(path) as f:
        magic, version, _, _, _, start, size, payload, _, count = fmt.IDENTITIES_HEADER.unpack(f.read(0, fmt.IDENTITIES_HEADER.size))
    if magic != b"OIOR" or version != 1 or size != count * fmt.IDENTITIES_RECORD.size:
        raise ValueError(f"Not an identities file: {magic!r} version {version}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Ranges(path) as f:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    n, rows = min(4096, count - k * 4096), []
                    for level, node, stars, offset, length in fmt.IDENTITIES_RECORD.iter_unpack(f.read(start + k * 4096 * fmt.IDENTITIES_RECORD.size, n * fmt.IDENTITIES_RECORD.size)):
                        pairs = fmt.unpack_identities(f.read(payload + offset, length))
                        if len(pairs) != stars:
                            raise ValueError(f"Cell {level}/{node} has {len(pairs)} identities, its directory {stars}")
                        rows += [(level, node, o, *p) for o, p in enumerate(pairs)]
                    yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string()))], ["level", "node_id", "ordinal", "source", "source_id"])

    blocks = -(-count // 4096)
    return spark.range(0, blocks, 1, max(1, min(blocks, 256))).mapInArrow(run, "level int, node_id long, ordinal int, source string, source_id string")


# --- tree reader -----------------------------------------------------------------------------------------------


def read_header(path: str) -> fmt.TreeHeader:
    with Ranges(path) as f:
        header = fmt.TreeHeader.unpack(f.read(0, FILE_HEAD_BYTES))
        if header.index_length and f.read(header.index_offset, 4) != b"OSHR":
            raise ValueError(f"{path} has no index where its header says")
    return header


def shard_at(f: Ranges, offset: int):
    raw = fmt.SHARD_HEADER.unpack(f.read(offset, fmt.SHARD_HEADER.size))
    if raw[0] != b"OSHR" or raw[1] != 1:
        raise ValueError(f"No index shard at {offset}: {raw[0]!r}")
    nodes = list(fmt.NODE.iter_unpack(f.read(raw[22], fmt.NODE.size * raw[7])))
    deep = sum(n[3] == LEVELS_PER_SHARD for n in nodes)
    refs = [r[0] for r in fmt.FRONTIER.iter_unpack(f.read(raw[23], fmt.FRONTIER.size * deep))]
    return raw[9], raw[10:13], nodes, refs


def node_at(grid: tuple[int, ...], level: int) -> int:
    return sum(((grid[a] >> b) & 1) << (3 * b + a) for b in range(level) for a in range(3))


NODES = "level int, node_id long, child_mask int, flags int, payload_offset long, payload_length long, next long"


def _shard_reader(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = [x.split(" ")[0] for x in NODES.split(", ")]
        with Ranges(path) as f:
            for batch in batches:
                for offset in batch.column(0).to_pylist():
                    parent, grid, nodes, refs = shard_at(f, offset)
                    above, rest = node_at(grid, max(0, parent)), iter(refs)
                    rows = [(parent + depth, (above << (3 * depth)) | path_, mask, flags, at, size, next(rest) if depth == LEVELS_PER_SHARD else 0) for _, path_, mask, depth, flags, _, at, size in nodes]
                    yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return run


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """All nodes of a tree file: level, node_id, child_mask, flags, payload_offset, payload_length.

    Shards of one generation are read side by side; their frontier tables name the next generation's.
    """
    header = read_header(path)
    level_of, found = spark.createDataFrame([(header.index_offset,)] if header.index_length else [], "next long"), None
    for k in range(-(-(header.max_level + 1) // LEVELS_PER_SHARD)):
        part = stored(spark, f"nodes of {path} {changed(path)} {header.dataset_uuid or header.sidecar_uuid} {k}", lambda todo=level_of: todo.mapInArrow(_shard_reader(path), NODES))
        found = part if found is None else found.unionByName(part)
        level_of = part.where("next > 0").select("next").repartition(max(1, spark.sparkContext.defaultParallelism))
    return found.drop("next")


def _payload_reader(path: str, record_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Ranges(path) as f:
            for batch in batches:
                level, node, start, size = (batch.column(k).to_pylist() for k in range(4))
                for s in range(0, batch.num_rows, RANGE_ROWS):
                    parts, keys = [], []
                    for k in range(s, min(batch.num_rows, s + RANGE_ROWS)):
                        try:
                            data = gzip.decompress(f.read(start[k], size[k]))
                        except (OSError, EOFError, zlib.error) as e:
                            log.warning("Payload of cell %s/%s cannot be read: %s", level[k], node[k], e)
                            data = b""
                        stars = np.frombuffer(data[: len(data) // record_size * record_size], STAR)
                        parts.append(stars)
                        keys += [(level[k], node[k], o) for o in range(len(stars))]
                    stars = np.concatenate(parts) if parts else np.zeros(0, STAR)
                    yield pa.record_batch(
                        [pa.array([x[0] for x in keys], pa.int32()), pa.array([x[1] for x in keys], pa.int64()), pa.array([x[2] for x in keys], pa.int32()), *(pa.array(np.ascontiguousarray(stars[c])) for c in "xyz"), pa.array(stars["mag"].astype(np.int32)), pa.array(stars["teff"].astype(np.int32))],
                        ["level", "node_id", "ordinal", "rel_x", "rel_y", "rel_z", "mag_centi", "teff8"],
                    )

    return run


def read_stars(spark: SparkSession, path: str, nodes: DataFrame | None = None) -> DataFrame:
    """Stars of a tree file in packed fields with their ordinals; of the given nodes only, so that a filter on nodes
    decides which payloads are read. Payloads that cannot be decoded give a warning and no stars."""
    header = read_header(path)
    if header.record_size != STAR.itemsize:
        raise ValueError(f"Unsupported record size: {header.record_size}")
    nodes = read_nodes(spark, path) if nodes is None else nodes
    held = nodes.where((F.col("flags").bitwiseAND(F.lit(HAS_PAYLOAD)) != 0) & (F.col("payload_length") > 0))
    return held.select("level", "node_id", "payload_offset", "payload_length").mapInArrow(_payload_reader(path, header.record_size), "level int, node_id long, ordinal int, rel_x float, rel_y float, rel_z float, mag_centi int, teff8 int")


def read_meta(spark: SparkSession, path: str, nodes: DataFrame | None = None) -> DataFrame:
    """level, node_id, meta (JSON) of a sidecar file's cells."""
    nodes = read_nodes(spark, path) if nodes is None else nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Ranges(path) as f:
            for batch in batches:
                data = [gzip.decompress(f.read(a, n)).decode() for a, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(data, pa.string())], ["level", "node_id", "meta"])

    return nodes.where("payload_length > 0").select("level", "node_id", "payload_offset", "payload_length").mapInArrow(run, "level int, node_id long, meta string")


def check_sidecar(tree: fmt.TreeHeader, sidecar: fmt.TreeHeader) -> None:
    """Raises unless the sidecar holds meta of exactly this tree."""
    same = (("world_center", "world_center"), ("world_half_size", "world_half_size"), ("max_level", "max_level"), ("dataset_uuid", "parent_dataset_uuid"))
    if sidecar.artifact_kind != "sidecar" or sidecar.sidecar_kind != "meta" or tree.dataset_uuid is None:
        raise ValueError("Not a meta sidecar")
    for a, b in same:
        if getattr(tree, a) != getattr(sidecar, b):
            raise ValueError(f"The sidecar's {b} differs from the tree's {a}")
