"""Tree files as a Spark data source: spark.read.format("startree").load(path).

Options: what = nodes (default) or stars. The first index shards are input partitions of their own; those below them are
found by the tasks that read them.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.constants import HAS_PAYLOAD
from ..operators.enrich import STAR
from . import artifacts
from .ranges import Ranges

NODES = "level int, node_id long, child_mask int, flags int, payload_offset long, payload_length long"
STARS = "level int, node_id long, ordinal int, rel_x float, rel_y float, rel_z float, mag_centi int, teff8 int"


#: The driver reads shards until so many are found beside each other.
PLANNED = 64


class Shard(InputPartition):
    """An index shard, alone or with all shards below it."""

    def __init__(self, offset: int, below: bool):
        self.offset, self.below = offset, below


class TreeReader(DataSourceReader):
    def __init__(self, path: str, what: str):
        self.path, self.what = path, what

    def partitions(self) -> list[Shard]:
        """Generations of index shards, from headers and frontier tables, down to one of PLANNED shards or more."""
        header = artifacts.read_header(self.path)
        todo, found = [header.index_offset] if header.index_length else [], []
        with Ranges(self.path) as f:
            while todo and len(todo) < PLANNED:
                found += todo
                todo = [r for offset in todo for r in artifacts.shard_at(f, offset)[3] if r]
        return [Shard(offset, False) for offset in found] + [Shard(offset, True) for offset in todo]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        todo = [partition.offset]
        with Ranges(self.path) as f:
            while todo:
                shard = artifacts.shard_at(f, todo.pop())
                yield from self._rows(f, shard)
                todo += [r for r in shard[3] if r and partition.below]

    def _rows(self, f: Ranges, shard: tuple) -> Iterator[pa.RecordBatch]:
        parent, grid, nodes, _ = shard
        above = artifacts.node_at(grid, max(0, parent))
        rows = [(parent + depth, (above << (3 * depth)) | path, mask, flags, at, size) for _, path, mask, depth, flags, _, at, size in nodes]
        if self.what == "nodes":
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split(" ")[0] for c in NODES.split(", ")])
            return
        for level, node, _, flags, at, size in rows:
            if flags & HAS_PAYLOAD and size:
                stars = np.frombuffer(gzip.decompress(f.read(at, size)), STAR)
                n = len(stars)
                fields = [pa.array(np.ascontiguousarray(stars[c])) for c in "xyz"] + [pa.array(stars[c].astype(np.int32)) for c in ("mag", "teff")]
                yield pa.record_batch([pa.array([level] * n, pa.int32()), pa.array([node] * n, pa.int64()), pa.array(range(n), pa.int32()), *fields], [c.split(" ")[0] for c in STARS.split(", ")])


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "startree"

    def _what(self) -> str:
        what = self.options.get("what", "nodes")
        if what not in ("nodes", "stars"):
            raise ValueError(f"what is nodes or stars, not {what!r}")
        return what

    def schema(self) -> str:
        return NODES if self._what() == "nodes" else STARS

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options["path"], self._what())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TreeSource)


__all__ = ["TreeSource", "register"]
