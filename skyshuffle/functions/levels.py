"""Magnitude levels: which tree level a star of an absolute magnitude belongs to."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import DEFAULT_MAG_VIS, DEFAULT_MAX_LEVEL, FAINT_STOP, UNKNOWN_MAG, WORLD_HALF_SIZE_PC


@dataclass(frozen=True)
class Levels:
    """Bands (m_min, m_max] by level; the first is open below, the last above.

    A star on the limit of level L is just visible at magnitude v_mag from half a cell of that level away. Without
    max_level, levels go on until the limit passes FAINT_STOP.
    """

    v_mag: float = DEFAULT_MAG_VIS
    half_size: float = WORLD_HALF_SIZE_PC
    max_level: int | None = DEFAULT_MAX_LEVEL

    def limit(self, level: int) -> float:
        return self.v_mag - 5.0 * (math.log10(self.half_size / 2**level) - 1.0)

    @property
    def last(self) -> int:
        if self.max_level is not None:
            return self.max_level
        level = 0
        while self.limit(level) <= FAINT_STOP:
            level += 1
        return level

    def limits(self) -> list[float]:
        """The upper limits of all levels but the last."""
        return [self.limit(k) for k in range(self.last)]

    def level_of(self, mag: float) -> int:
        """The level of one magnitude."""
        mag = mag if math.isfinite(mag) else UNKNOWN_MAG
        return next((k for k, top in enumerate(self.limits()) if mag <= top), self.last)

    def bands(self) -> list[tuple[int, float, float]]:
        edges = [-math.inf, *self.limits(), math.inf]
        return [(k, edges[k], edges[k + 1]) for k in range(self.last + 1)]

    def table(self, spark: SparkSession) -> DataFrame:
        """level, m_min, m_max, half_size: one row a level."""
        rows = [F.struct(F.lit(k).alias("level"), F.lit(lo).alias("m_min"), F.lit(hi).alias("m_max"), F.lit(self.half_size / 2**k).alias("half_size")) for k, lo, hi in self.bands()]
        return spark.range(1).select(F.inline(F.array(*rows)))

    def column(self, mag: Column) -> Column:
        """The level of a magnitude column that holds finite values, as a chain of comparisons with literals."""
        out = F.lit(self.last)
        for k, top in reversed(list(enumerate(self.limits()))):
            out = F.when(mag <= F.lit(top), F.lit(k)).otherwise(out)
        return out


def finite(column: Column, otherwise: float) -> Column:
    """The column, with null and non-finite values replaced."""
    return F.when(column.isNull() | F.isnan(column) | (F.abs(column) == float("inf")), F.lit(otherwise)).otherwise(column)
