"""Binary layouts of the tree, its intermediates and the identities file. All little-endian."""

from __future__ import annotations

import gzip
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of the format: record layouts, magics, names.
INTERMEDIATE_HEADER, INTERMEDIATE_RECORD = struct.Struct("<4sHHBBHIQQ"), struct.Struct("<QQII")
STAR_HEADER, DESCRIPTOR = struct.Struct("<4sHHQQ3ffHHf16s"), struct.Struct("<4sHH16s16s16s32s40x")
SHARD_HEADER, NODE, FRONTIER = struct.Struct("<4sHBBIIHHHhIII8HHQQQ2x"), struct.Struct("<HHBBBBQI"), struct.Struct("<Q")
IDENTITIES_HEADER, IDENTITIES_RECORD, LENGTH = struct.Struct("<4sHH16s16sQQQQQ"), struct.Struct("<H2xQIQQ"), struct.Struct("<H")
MAGICS = {"render": b"OIDX", "identifiers": b"OIDN", "sidecar": b"OSIX", "relocation": b"ORLX"}
GZIP_SORTED = 3
KINDS = {"render": 1, "sidecar": 2}
INTERMEDIATES_FORMAT, SIDECARS_FORMAT = "three_dee.octree.intermediates/v1", "three_dee.octree.sidecars/v1"
NO_UUID = uuid.UUID(int=0)


def compress(data: bytes) -> bytes:
    """gzip without a time stamp: equal data gives equal bytes."""
    return gzip.compress(data, mtime=0)


def pack_identities(rows: list[tuple[str, str]]) -> bytes:
    out = bytearray()
    for pair in rows:
        for text in pair:
            data = text.encode()
            out += LENGTH.pack(len(data)) + data
    return bytes(out)


def unpack_identities(data: bytes) -> list[tuple[str, str]]:
    texts, at = [], 0
    while at < len(data):
        if at + LENGTH.size > len(data):
            raise ValueError("Truncated identity row")
        n = LENGTH.unpack_from(data, at)[0]
        at += LENGTH.size
        if at + n > len(data):
            raise ValueError("Truncated identity row")
        texts.append(data[at : at + n].decode())
        at += n
    if len(texts) % 2:
        raise ValueError("Truncated identity row")
    return list(zip(texts[::2], texts[1::2], strict=True))


@dataclass(frozen=True)
class TreeHeader:
    """Header and descriptor of a tree file."""

    index_offset: int
    index_length: int
    world_center: tuple[float, float, float]
    world_half_size: float
    max_level: int
    mag_limit: float
    record_size: int = 16
    artifact_kind: str = "render"
    dataset_uuid: uuid.UUID | None = None
    parent_dataset_uuid: uuid.UUID | None = None
    sidecar_uuid: uuid.UUID | None = None
    sidecar_kind: str | None = None

    def pack(self) -> bytes:
        kind = (self.sidecar_kind or "").encode()
        if len(kind) > 32:
            raise ValueError("sidecar_kind is longer than 32 bytes")
        head = STAR_HEADER.pack(b"STAR", 1, 0, self.index_offset, self.index_length, *self.world_center, self.world_half_size, self.record_size, self.max_level, self.mag_limit, b"")
        ids = [(u or NO_UUID).bytes for u in (self.dataset_uuid, self.parent_dataset_uuid, self.sidecar_uuid)]
        return head + DESCRIPTOR.pack(b"ODSC", 1, KINDS[self.artifact_kind], *ids, kind)

    @staticmethod
    def unpack(data: bytes) -> TreeHeader:
        if len(data) < STAR_HEADER.size + DESCRIPTOR.size:
            raise ValueError("Truncated tree header")
        magic, version, _, offset, length, *center, half, size, level, mag, _ = STAR_HEADER.unpack_from(data)
        if magic != b"STAR" or version != 1:
            raise ValueError(f"Not a tree file: {magic!r} version {version}")
        magic, version, code, a, b, c, kind = DESCRIPTOR.unpack_from(data, STAR_HEADER.size)
        if magic != b"ODSC" or version != 1:
            raise ValueError(f"Not a tree descriptor: {magic!r} version {version}")
        names = {v: k for k, v in KINDS.items()}
        if code not in names:
            raise ValueError(f"Unknown artifact kind: {code}")
        ids = [None if not any(x) else uuid.UUID(bytes=x) for x in (a, b, c)]
        return TreeHeader(offset, length, tuple(center), half, level, mag, size, names[code], *ids, kind.rstrip(b"\0").decode() or None)


def shard_name(level: int, prefix_bits: int, prefix: int, family: str = "render") -> tuple[str, str]:
    """File names of an intermediate shard's index and payload."""
    if not family.strip():
        raise ValueError("A sidecar family needs a name")
    stem = f"level-{level:02d}" + (f"-p{prefix_bits}-{prefix}" if prefix_bits else "")
    ends = {"render": ("index", "payload"), "identifiers": ("ident-index", "ident-payload")}.get(family, (f"{family}.index", f"{family}.payload"))
    return f"{stem}.{ends[0]}", f"{stem}.{ends[1]}"


def read_records(data: bytes, magic: bytes) -> Iterator[tuple[int, int, int, int]]:
    """node_id, offset, length, star_count of an intermediate index; a wrong layout is an error."""
    found, version, head, _, _, _, size, _, count = INTERMEDIATE_HEADER.unpack_from(data)
    if found != magic or version != 1:
        raise ValueError(f"Not an index of kind {magic!r}: {found!r} version {version}")
    if head != INTERMEDIATE_HEADER.size or size != INTERMEDIATE_RECORD.size or len(data) - head != count * size:
        raise ValueError("Index sizes do not agree with its header")
    return INTERMEDIATE_RECORD.iter_unpack(data[head:])


def manifest(kind: str, shards: list[dict], max_level: int, mag_limit: float, center: tuple[float, float, float], half_size: float) -> str:
    """The JSON manifest of intermediate shards."""
    levels: dict[int, list[dict]] = {}
    for s in sorted(shards, key=lambda s: (s["level"], s["prefix_bits"], s["prefix"])):
        levels.setdefault(s["level"], []).append({k: v for k, v in s.items() if k != "level"})
    return json.dumps({
        "format": INTERMEDIATES_FORMAT, "artifact_kind": kind, "index_magic": MAGICS[kind].decode(), "world_center": list(center), "world_half_size_pc": half_size,
        "max_level": max_level, "mag_limit": mag_limit, "payload_codec": "gzip", "index_header_struct": INTERMEDIATE_HEADER.format, "index_record_struct": INTERMEDIATE_RECORD.format,
        "levels": [{"level": k, "shards": v} for k, v in levels.items()],
    }, indent=2) + "\n"
