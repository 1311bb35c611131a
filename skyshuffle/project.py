"""Project files: where a build's inputs and outputs are, and its settings."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from pathlib import Path

from .functions.constants import DEFAULT_DEEP_SHARD_FROM_LEVEL, DEFAULT_MAG_VIS, DEFAULT_MAX_LEVEL
from .functions.levels import Levels

# The file's tables, their keys with types, and the template's values.
PATHS = {
    "merged_healpix_dir": "data/merged", "identifiers_map_path": "data/identifiers_map.parquet", "stage00_output_dir": "build/stage00",
    "stage01_output_dir": "build/stage01", "stage02_output_path": "build/stars.tree", "identifiers_order_output_path": "build/identifiers.order",
    "stage03_output_dir": "build/sidecars",
}
SETTINGS: dict[str, dict[str, tuple[type, object]]] = {
    "stage00": {"batch_size": (int, 1_000_000), "v_mag": (float, DEFAULT_MAG_VIS), "max_level": (int, DEFAULT_MAX_LEVEL)},
    "stage01": {"input_glob": (str, "build/stage00/**/*.parquet"), "batch_size": (int, 100_000), "deep_shard_from_level": (int, DEFAULT_DEEP_SHARD_FROM_LEVEL), "deep_prefix_bits": (int, 3)},
    "stage02": {"max_open_files": (int, 32)},
}
POSITIVE = {"batch_size", "max_open_files"}


@dataclass(frozen=True)
class Project:
    """A checked project file; paths are absolute or relative to its folder.

    Batch sizes and open files are checked but not used: Spark sizes its own batches.
    """

    path: Path
    paths: dict[str, Path]
    settings: dict[str, dict[str, object]]
    sidecars: dict[str, tuple[str, ...]]

    @property
    def levels(self) -> Levels:
        return Levels(v_mag=self.settings["stage00"]["v_mag"], max_level=self.settings["stage00"]["max_level"])


def _only(table: dict, allowed: set[str], name: str) -> None:
    unknown = sorted(set(table) - allowed)
    if unknown:
        raise ValueError(f"[{name}] has unknown key(s): {', '.join(unknown)}")


def _place(folder: Path, value: object, name: str) -> Path:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{name} must be a non-empty string")
    if "$" in value:
        raise ValueError(f"{name} must not refer to environment variables: {value!r}")
    return folder / value  # an absolute value stays as it is


def _number(value: object, kind: type, name: str) -> object:
    if isinstance(value, bool) or not isinstance(value, (int, float) if kind is float else int):
        raise ValueError(f"{name} must be {'a number' if kind is float else 'an integer'}")
    if value < 0 and kind is int or value == 0 and name.split(".")[-1] in POSITIVE:
        raise ValueError(f"{name} is too small: {value}")
    return kind(value)


def load_project(path: str | Path) -> Project:
    path = Path(path).expanduser().resolve()
    raw = tomllib.loads(path.read_text())
    if raw.get("format_version") != 1:
        raise ValueError(f"format_version must be 1, not {raw.get('format_version')!r}")
    for name in ("paths", *SETTINGS, "stage03"):
        if not isinstance(raw.get(name), dict):
            raise ValueError(f"The project file needs a table [{name}]")
    _only(raw["paths"], set(PATHS), "paths")
    paths = {k: _place(path.parent, raw["paths"].get(k), f"paths.{k}") for k in PATHS}
    settings: dict[str, dict[str, object]] = {}
    for name, keys in SETTINGS.items():
        _only(raw[name], set(keys), name)
        read = lambda k, kind, name=name: str(_place(path.parent, raw[name].get(k), f"{name}.{k}")) if kind is str else _number(raw[name].get(k), kind, f"{name}.{k}")
        settings[name] = {k: read(k, kind) for k, (kind, _) in keys.items()}
    _only(raw["stage03"], {"sidecars"}, "stage03")
    sidecars: dict[str, tuple[str, ...]] = {}
    listed = raw["stage03"].get("sidecars", [])
    if not isinstance(listed, list) or not all(isinstance(s, dict) for s in listed):
        raise ValueError("stage03.sidecars must be an array of tables")
    for s in listed:
        _only(s, {"name", "fields"}, "stage03.sidecars")
        name, fields = s.get("name"), s.get("fields", [])
        if not isinstance(name, str) or not name.strip() or name.strip() in sidecars:
            raise ValueError(f"A sidecar needs a name of its own, not {name!r}")
        if not isinstance(fields, list) or not all(isinstance(f, str) and f.strip() for f in fields):
            raise ValueError(f"Fields of sidecar {name} must be a list of non-empty strings")
        sidecars[name.strip()] = tuple(f.strip() for f in fields)
    return Project(path, paths, settings, sidecars)


def template() -> str:
    shown = lambda v: f'"{v}"' if isinstance(v, str) else str(v)
    lines = ["format_version = 1", "", "[paths]", *(f"{k} = {shown(v)}" for k, v in PATHS.items())]
    for name, keys in SETTINGS.items():
        lines += ["", f"[{name}]", *(f"{k} = {shown(v)}" for k, (_, v) in keys.items())]
    return "\n".join([*lines, "", "[stage03]", "", "[[stage03.sidecars]]", 'name = "meta"', "fields = []", ""])
