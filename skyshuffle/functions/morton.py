"""Morton codes of 21 bits an axis as Column expressions: no Python in the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import MORTON_BITS, WORLD_HALF_SIZE_PC

def shift_left(column: Column, by: Column | int) -> Column:
    return F.call_function("shiftleft", column, F.lit(by).cast("int") if isinstance(by, int) else by.cast("int"))


def shift_right(column: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", column, F.lit(by).cast("int") if isinstance(by, int) else by.cast("int"))


def quantise(axis: Column, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    """Grid coordinate of a position; positions outside the world go to its edge."""
    top = 2**MORTON_BITS
    return F.least(F.greatest(F.floor((axis + F.lit(half_size)) * F.lit(top / (2 * half_size))), F.lit(0)), F.lit(top - 1)).cast("long")


#: Masks that hold 21 bits ever further apart, down to every third place, and the shifts between them.
ROUNDS = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def spread(value: Column) -> Column:
    """21 bits to every third place. Meant for projections, where code generation evaluates each repeated term once."""
    for by, mask in ROUNDS:
        value = value.bitwiseOR(shift_left(value, by)).bitwiseAND(F.lit(mask))
    return value


def gather(value: Column) -> Column:
    """The inverse of spread. Each round is bound to a name by a one-element transform: predicates are pushed down by
    inlining, and without names a five-round term would be repeated 32 times."""
    held = F.array(value.bitwiseAND(F.lit(ROUNDS[-1][1])))
    masks = [mask for _, mask in ROUNDS[-2::-1]] + [(1 << MORTON_BITS) - 1]
    closer = lambda by, mask: lambda v: v.bitwiseOR(F.shiftright(v, by)).bitwiseAND(F.lit(mask))
    for (by, _), mask in zip(ROUNDS[::-1], masks, strict=True):
        held = F.transform(held, closer(by, mask))
    return F.get(held, F.lit(0))


def morton_code(x: Column, y: Column, z: Column, half_size: float = WORLD_HALF_SIZE_PC) -> Column:
    a, b, c = (spread(quantise(v, half_size)) for v in (x, y, z))
    return a.bitwiseOR(shift_left(b, 1)).bitwiseOR(shift_left(c, 2))


def up_to(level: Column) -> Column:
    """Bits below a level: 3 (21 - level)."""
    return (F.lit(MORTON_BITS) - level) * 3


def node_id(morton: Column, level: Column) -> Column:
    return shift_right(morton, up_to(level))


def grid(node: Column, axis: int) -> Column:
    return gather(shift_right(node, axis))


def dfs_key(node: Column, level: Column) -> Column:
    """Preorder of nodes is the order by (dfs_key, level)."""
    return shift_left(node, up_to(level))
