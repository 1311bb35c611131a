"""Predicates that reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import MORTON_BITS, WORLD_HALF_SIZE_PC


def prefix_range(prefix: int, bits: int) -> tuple[int, int]:
    """First and last Morton code whose upper bits are the prefix."""
    shift = 3 * MORTON_BITS - bits
    return prefix << shift, ((prefix + 1) << shift) - 1


def has_prefix(prefix: int, bits: int, morton: str = "morton_code") -> Column:
    """Morton codes of a shard, as a range that is pushed down; a shift is not."""
    low, high = prefix_range(prefix, bits)
    return F.col(morton).between(low, high)


def _interleave(x: int, y: int, z: int) -> int:
    return sum(((v >> b) & 1) << (3 * b + a) for b in range(MORTON_BITS) for a, v in enumerate((x, y, z)))


def around(point: tuple[float, float, float], radius: float, level: int, half_size: float = WORLD_HALF_SIZE_PC, most: int = 512) -> list[tuple[int, int]] | None:
    """Morton ranges that hold every cell of a level within radius of a point; None if they would be more than `most`.

    Cells that touch the cube around the point are counted at the level, or at the deepest level above it at which they
    are few enough; neighbouring ranges are joined.
    """
    for at in range(level, -1, -1):
        cell, n = 2 * half_size / 2**at, 2**at
        spans = [(max(0, int((p - radius + half_size) // cell)), min(n - 1, int((p + radius + half_size) // cell))) for p in point]
        if any(hi < lo for lo, hi in spans):
            spans = [(min(lo, n - 1), max(hi, 0)) for lo, hi in spans]  # outside the world: its edge cells
            spans = [(min(s), max(s)) for s in spans]
        size = 1
        for lo, hi in spans:
            size *= hi - lo + 1
        if size <= most:
            shift = 3 * (MORTON_BITS - at)
            codes = sorted(_interleave(x << (MORTON_BITS - at), y << (MORTON_BITS - at), z << (MORTON_BITS - at)) for x in range(spans[0][0], spans[0][1] + 1) for y in range(spans[1][0], spans[1][1] + 1) for z in range(spans[2][0], spans[2][1] + 1))
            out: list[tuple[int, int]] = []
            for code in codes:
                if out and out[-1][1] + 1 == code:
                    out[-1] = (out[-1][0], code + (1 << shift) - 1)
                else:
                    out.append((code, code + (1 << shift) - 1))
            return out
    return None


def near_cells(rows: DataFrame, point: tuple[float, float, float], radius: Callable[[int], float], last: int, half_size: float = WORLD_HALF_SIZE_PC, most: int = 27) -> DataFrame:
    """rows but those whose cells are surely farther from the point than their level's radius.

    The test is of level and ranges of Morton codes alone, so it reaches the scan of a catalogue in Morton order; rows
    without a code are all kept. It keeps some cells that are too far: the exact test follows. Only for rows that are read
    from a table: a computed code would be computed again for each range.
    """
    if "morton_code" not in rows.columns:
        return rows
    tests = []
    for level in range(last + 1):
        ranges = around(point, radius(level) * (1 + 1e-9) + 1e-6, level, half_size, most)
        tests.append(f"level = {level}" + ("" if ranges is None else f" AND {within(ranges)}"))
    return rows.where(" OR ".join(f"({t})" for t in tests))


def within(ranges: list[tuple[int, int]], morton: str = "morton_code") -> str:
    """Whether a Morton code is in one of the ranges, as SQL: one call builds what would be thousands of columns."""
    return "(" + (" OR ".join(f"{morton} BETWEEN {low} AND {high}" for low, high in ranges) or "false") + ")"
