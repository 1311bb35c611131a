"""Compact render fields of a star, their decoding, and distances."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DISTANCE_FLOOR_PC, STAR_BYTES, TEFF_HI, TEFF_LO, TEFF_UNKNOWN_CODE, WORLD_CENTER, WORLD_HALF_SIZE_PC
from .morton import grid

AXES = ("x", "y", "z")


def cell_half(level: Column, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    return F.greatest(F.lit(half_size) / F.pow(F.lit(2.0), level), F.lit(1e-20))


def grid_center(place: Column, level: Column, axis: int, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    """Centre of the cell at a grid place of its level."""
    return F.lit(WORLD_CENTER[axis]) + (place.cast("double") + F.lit(0.5)) * (F.lit(2.0) * cell_half(level, half_size)) - F.lit(half_size)


def cell_center(node: Column, level: Column, axis: int, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    return grid_center(grid(node, axis), level, axis, half_size)


def relative(position: Column, center: Column, half: Column) -> Column:
    """Position within a cell, -1 to 1, in single precision."""
    return F.least(F.greatest((position - center) / half, F.lit(-1.0)), F.lit(1.0)).cast("float")


def centi_magnitude(mag: Column) -> Column:
    return F.least(F.greatest(F.rint(mag * F.lit(100.0)), F.lit(-32768.0)), F.lit(32767.0)).cast("int")


def encode_teff(teff: Column) -> Column:
    """Temperature as 8 bits of its logarithm; out of range, null and nan: 255."""
    low, wide = math.log10(TEFF_LO), math.log10(TEFF_HI) - math.log10(TEFF_LO)
    code = F.floor(F.lit(255.0) * (F.log10(teff) - F.lit(low)) / F.lit(wide))
    fits = (teff >= F.lit(TEFF_LO)) & (teff <= F.lit(TEFF_HI)) & ~F.isnan(teff)
    return F.when(fits, F.least(F.greatest(code, F.lit(0)), F.lit(254))).otherwise(F.lit(TEFF_UNKNOWN_CODE)).cast("int")


def decode_teff(code: Column) -> Column:
    return F.when(code == TEFF_UNKNOWN_CODE, F.lit(float("nan"))).otherwise(F.lit(TEFF_LO) * F.pow(F.lit(TEFF_HI / TEFF_LO), code / F.lit(255.0)))


def distance(*offsets: Column) -> Column:
    return F.sqrt(sum((d * d for d in offsets[1:]), offsets[0] * offsets[0]))


def box_distance(point: tuple[float, float, float], centers: list[Column], half: Column) -> Column:
    """Distance of a point from a cell; 0 inside."""
    return distance(*(F.greatest(F.abs(F.lit(p) - c) - half, F.lit(0.0)) for p, c in zip(point, centers, strict=True)))


def apparent_magnitude(mag: Column, pc: Column) -> Column:
    return mag + F.lit(5.0) * (F.log10(F.greatest(pc, F.lit(DISTANCE_FLOOR_PC))) - F.lit(1.0))


def load_radius(half: Column, magnitude: float, mag_limit: float) -> Column:
    """How far a cell's stars are looked for at a limiting magnitude."""
    return half * F.lit(10.0 ** ((magnitude - mag_limit) / 5.0))


__all__ = ["AXES", "STAR_BYTES", "apparent_magnitude", "box_distance", "cell_center", "cell_half", "grid_center", "centi_magnitude", "decode_teff", "distance", "encode_teff", "load_radius", "relative"]
