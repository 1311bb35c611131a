"""Identifiers of stars: the map, its join, and JSON entries in cell order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import IDENTIFIER_FIELDS, INTEGER_FIELDS
from .cells import KEY

#: An identifier map of at most so many rows, of strings of so many bytes in all, is broadcast; a larger one is joined by
#: shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def last_wins(identifiers: DataFrame) -> DataFrame:
    """One row a (source, source_id): the last in column row. Empty strings and bad numbers become null."""
    fields = [c for c in IDENTIFIER_FIELDS if c in identifiers.columns]
    clean = {c: F.col(c).try_cast("long") if c in INTEGER_FIELDS else F.when(F.trim(c) != "", F.trim(c)) for c in fields}
    rows = identifiers.withColumns(clean)
    return rows.groupBy("source", "source_id").agg(F.max_by(F.struct(*fields), "row").alias("ids")).select("source", "source_id", "ids.*") if fields else rows.select("source", "source_id").distinct()


def join_identifiers(rows: DataFrame, identifiers: DataFrame) -> DataFrame:
    """rows(source, source_id, ...) with their identifiers; a star without any keeps its row."""
    one = last_wins(identifiers)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in identifiers.schema.fields if f.dataType.simpleString() == "string"]
    size = identifiers.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)).alias("bytes")).first()  # the map is no smaller than its last rows
    small = size["n"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES
    return rows.join(F.broadcast(one) if small else one, ["source", "source_id"], "left")


def entry(columns: list[str]):
    """The JSON entry of a star: identity first, then its known identifiers in their fixed order."""
    return F.struct("source", "source_id", *(c for c in IDENTIFIER_FIELDS if c in columns))


def cell_meta(identities: DataFrame, identifiers: DataFrame) -> DataFrame:
    """One row a cell: a JSON array with one object a star, in cell order; unknown identifiers are left out."""
    joined = join_identifiers(identities, identifiers)
    sorted_ = F.array_sort(F.collect_list(F.struct("ordinal", entry(joined.columns).alias("e"))))
    return joined.groupBy(*KEY).agg(F.transform(sorted_, lambda s: F.to_json(s["e"])).alias("entries")).select(*KEY, F.size("entries").alias("star_count"), F.concat(F.lit("["), F.concat_ws(",", "entries"), F.lit("]")).alias("meta"))


def parse_meta(cells: DataFrame, column: str = "meta") -> DataFrame:
    """level, node_id, ordinal and identifiers of every entry; what is no array, or no object, is left empty."""
    kinds = {c: "bigint" if c in INTEGER_FIELDS else "string" for c in ("source", "source_id", *IDENTIFIER_FIELDS)}
    schema = "array<struct<" + ",".join(f"{c}:{t}" for c, t in kinds.items()) + ">>"
    return cells.select(*KEY, F.posexplode(F.from_json(column, schema)).alias("ordinal", "e")).select(*KEY, "ordinal", "e.*")


#: Sidecar families by name.
FAMILIES: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"meta": cell_meta}


def build_family(name: str, identities: DataFrame, identifiers: DataFrame) -> DataFrame:
    if name not in FAMILIES:
        raise ValueError(f"Unknown sidecar family: {name}")
    return FAMILIES[name](identities, identifiers)
