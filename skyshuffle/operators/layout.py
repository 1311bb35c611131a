"""The index and byte layout of the tree, in closed form: no node is ever walked to.

Preorder is the order of (dfs_key, level), so offsets are running sums; nodes are the distinct prefixes of cells; shards,
child masks and entry tables are aggregations over nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.constants import FILE_HEAD_BYTES, FRONTIER_BYTES, HAS_CHILDREN, HAS_PAYLOAD, IS_FRONTIER, LEVELS_PER_SHARD, NODE_BYTES, SHARD_HEADER_BYTES
from ..functions.morton import dfs_key, shift_left, shift_right
from ..plans.prefix import running_sum, running_sums
from .cells import KEY, preorder


def node_set(cells: DataFrame) -> DataFrame:
    """Every cell's node and all ancestors, once: one distinct instead of a range test per candidate child."""
    up = F.explode(F.sequence(F.lit(0), F.col("level"))).alias("at")
    return cells.select("level", "node_id", up).select(F.col("at").alias("level"), shift_right(F.col("node_id"), (F.col("level") - F.col("at")) * 3).alias("node_id")).distinct()


def child_masks(nodes: DataFrame) -> DataFrame:
    """Bit k of child_mask: the child in octant k exists. Nodes without children have no row."""
    below = nodes.where("level > 0")
    bit = shift_left(F.lit(1), F.col("node_id").bitwiseAND(F.lit(7)))
    parent = below.select((F.col("level") - 1).alias("level"), shift_right(F.col("node_id"), 3).alias("node_id"), bit.cast("int").alias("bit"))
    return parent.groupBy(*KEY).agg(F.bit_or("bit").alias("child_mask"))


def payload_offsets(cells: DataFrame, length: str = "payload_len", start: int = FILE_HEAD_BYTES) -> DataFrame:
    """Absolute offset of every payload in the tree file, in preorder."""
    return running_sum(preorder(cells), "dfs_key", ["level"], F.col(length), "__before").withColumn("output_offset", F.col("__before") + F.lit(start)).drop("__before")


def with_shard(nodes: DataFrame) -> DataFrame:
    """The index shard of each node: its implicit parent, depth below it, and path from it."""
    level = F.col("level")
    top = (F.floor(level / LEVELS_PER_SHARD) * LEVELS_PER_SHARD - 1).cast("int")
    out = nodes.withColumn("parent_level", top).withColumn("local_depth", level - F.col("parent_level"))
    path = F.col("node_id").bitwiseAND(shift_left(F.lit(1).cast("long"), F.col("local_depth") * 3) - 1)
    parent = F.when(F.col("parent_level") < 0, F.lit(0)).otherwise(shift_right(F.col("node_id"), F.col("local_depth") * 3))
    return out.withColumns({"parent_node": parent.cast("long"), "local_path": path})


SHARD = ("parent_level", "parent_node")


def shard_nodes(cells: DataFrame) -> DataFrame:
    """One row a node: its place in the shard (from 1), child mask, first child, flags."""
    nodes = node_set(cells)
    nodes = with_shard(nodes.join(child_masks(nodes), list(KEY), "left").join(cells.select(*KEY, F.lit(True).alias("held")), list(KEY), "left"))
    nodes = nodes.withColumns({"child_mask": F.coalesce("child_mask", F.lit(0)), "has_payload": F.coalesce("held", F.lit(False))}).drop("held")
    nodes = nodes.withColumn("node_index", F.row_number().over(W.partitionBy(*SHARD).orderBy("local_depth", "local_path")))
    child = nodes.where("local_depth > 1").select(*SHARD, (F.col("level") - 1).alias("level"), shift_right(F.col("node_id"), 3).alias("node_id"), "node_index")
    first = child.groupBy(*SHARD, *KEY).agg(F.min("node_index").alias("first_child"), (F.max("node_index") - F.min("node_index") + 1 == F.count("*")).alias("contiguous"))
    nodes = nodes.join(first, [*SHARD, *KEY], "left").withColumns({"first_child": F.coalesce("first_child", F.lit(0)), "contiguous": F.coalesce("contiguous", F.lit(True))})
    flag = lambda test, bit: F.when(test, bit).otherwise(0)
    flags = flag(F.col("has_payload"), HAS_PAYLOAD) + flag(F.col("child_mask") != 0, HAS_CHILDREN) + flag(F.col("local_depth") == LEVELS_PER_SHARD, IS_FRONTIER)
    return nodes.withColumn("flags", flags)


def shard_headers(nodes: DataFrame, index_offset: int = 0) -> DataFrame:
    """One row an index shard: shard_id in preorder (from 1), counts, entry nodes, size and absolute offset."""
    entry = [F.coalesce(F.max(F.when((F.col("local_depth") == 1) & (F.col("local_path") == k), F.col("node_index"))), F.lit(0)).alias(f"entry_{k}") for k in range(8)]
    frontier = F.col("local_depth") == LEVELS_PER_SHARD
    shards = nodes.groupBy(*SHARD).agg(
        F.count("*").alias("node_count"), F.count(F.when(frontier, 1)).alias("frontier_count"),
        F.coalesce(F.min(F.when(frontier, F.col("node_index"))), F.lit(0)).alias("first_frontier_index"), *entry,
    )
    shards = shards.withColumns({
        "shard_bytes": F.lit(SHARD_HEADER_BYTES) + NODE_BYTES * F.col("node_count") + FRONTIER_BYTES * F.col("frontier_count"),
        "parent_key": F.when(F.col("parent_level") < 0, F.lit(0)).otherwise(dfs_key(F.col("parent_node"), F.col("parent_level"))).cast("long"),
    })
    shards = running_sums(shards, "parent_key", ["parent_level"], {"shard_id": F.lit(1), "shard_offset": F.col("shard_bytes")})
    shards = shards.withColumns({"shard_id": F.col("shard_id") + 1, "shard_offset": F.col("shard_offset") + F.lit(index_offset)})
    return shards.drop("parent_key")


def frontier_refs(nodes: DataFrame, shards: DataFrame) -> DataFrame:
    """For each frontier node, the offset of the shard below it, 0 without one."""
    below = shards.select(F.col("parent_level").alias("level"), F.col("parent_node").alias("node_id"), F.col("shard_offset").alias("child_offset"))
    return nodes.where(F.col("local_depth") == LEVELS_PER_SHARD).join(below, list(KEY), "left").select(*SHARD, "node_index", *KEY, F.coalesce("child_offset", F.lit(0)).alias("child_offset"))


def children(nodes: DataFrame) -> DataFrame:
    """Every parent with its children, by a self join; rank is the child's place among them."""
    child = nodes.where("level > 0").select((F.col("level") - 1).alias("level"), shift_right(F.col("node_id"), 3).alias("node_id"), F.col("node_id").alias("child_id"))
    both = nodes.select(*KEY, "child_mask").join(child, list(KEY)).withColumn("octant", F.col("child_id").bitwiseAND(F.lit(7)).cast("int"))
    lower = F.col("child_mask").bitwiseAND(shift_left(F.lit(1), F.col("octant")) - 1)
    return both.withColumn("rank", F.bit_count(lower)).select(*KEY, "child_id", "octant", "rank")


def relocation_breaches(cells: DataFrame, relocated: DataFrame) -> DataFrame:
    """Cells without a relocation, and relocations without a cell. Empty: both agree."""
    a, b = cells.select(*KEY).withColumn("in_cells", F.lit(True)), relocated.select(*KEY).withColumn("in_reloc", F.lit(True))
    return a.join(b, list(KEY), "full").where(F.col("in_cells").isNull() | F.col("in_reloc").isNull()).select(*KEY, F.coalesce("in_cells", F.lit(False)).alias("in_cells"), F.coalesce("in_reloc", F.lit(False)).alias("in_reloc"))


def descendant_exists(cells: DataFrame, asked: DataFrame) -> DataFrame:
    """Nodes of asked(level, node_id) that are or contain a cell: an equi semi-join with the node set."""
    return asked.join(node_set(cells), list(KEY), "left_semi")
