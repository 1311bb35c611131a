"""The corpus pipeline: stages over documents, each written as Parquet and read again.

No row is lost but by a stage's decision. Rows are told apart by doc_id where it is one row's own; rows without doc_id and
rows that share one get a key of their own behind it, so each is judged by its own text. Null and empty texts pass every
filter that their score or links allow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyshuffle.llm import common
from skyshuffle.llm.decontaminate import contamination
from skyshuffle.llm.jaccard import near_duplicates
from skyshuffle.llm.mixing import mix_sources
from skyshuffle.llm.quality import keep_quality, train_quality
from skyshuffle.llm.substrings import remove_substrings

#: A list of at most so many keys is broadcast; a longer one is joined by shuffle.
BROADCAST_KEYS = 1_000_000


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with an added column that tells every row from all others, and its name.

    The key is doc_id where that is one row's own. The other rows are stored in order of doc_id (null last), text and all
    else, and take keys above all doc_ids (below, where there is no room above) in that order.
    """
    key = next(name for name in ("row_key", *(f"row_key{k}" for k in range(len(docs.columns) + 1))) if name not in docs.columns)
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    odd = F.col("doc_id").isNull() | (F.col("n") > 1)
    said = ids.agg(F.count_if(odd).alias("odd"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    own = docs.withColumn(key, F.col("doc_id").cast("long"))
    if not said["odd"]:
        return own, key
    shared = common.saved(ids.where("doc_id is not null and n > 1").select("doc_id"), "shared-ids")
    rows = docs.where(F.col("doc_id").isNull()).unionByName(docs.join(shared, "doc_id", "left_semi").select(*docs.columns))
    rest = F.to_json(F.struct(*docs.columns))
    place = common.saved(rows.orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_last(), rest).withColumn(key, F.monotonically_increasing_id()), "odd-rows")
    low, high = said["low"] or 0, said["high"] or 0
    number = F.lit(high + 1) + F.col(key) if high < 1 << 62 else F.lit(low - (1 << 62)) + F.col(key)
    alone = own.where(F.col("doc_id").isNotNull()).join(shared, "doc_id", "left_anti").select(*own.columns)
    return alone.unionByName(place.withColumn(key, number.cast("long"))), key


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of docs, without the key column, whose key gone(key) does not hold. gone is stored, of one column."""
    return docs.join(F.broadcast(gone) if common.few(gone, BROADCAST_KEYS) else gone, key, "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects.

    Null and empty texts are scored as texts without words, rows that repeat get equal scores, other columns are kept
    as they are, an empty table stays empty.
    """
    return keep_quality(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near duplicates: the one with the smallest doc_id that is its own, else the first
    in order of doc_id (null last), text and all else.

    Texts without words have no duplicates: all such rows stay. Other columns are kept as they are, an empty table stays
    empty, rows that repeat are duplicates of each other.
    """
    with common.tables() as kept:
        rows, key = _keyed(docs)
        with common.tables() as spent:
            found = near_duplicates(rows.select(key, "text"), doc_id=key)
            gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
            gone = common.saved(gone, "near-duplicates")
            kept.append(spent.pop())
            common.drop_tables(spark, spent)
    return _without(rows, key, gone)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of all documents but the first; n_chars follows the text.

    Null texts stay null; rows that share a doc_id or have none do not take passages from each other; texts without
    repeats and other columns stay as they are; an empty table stays empty.
    """
    out, changed = remove_substrings(docs)
    if "n_chars" in docs.columns:
        length = F.when(F.col(changed), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are contaminated with benchmark items.

    Null and empty texts are not contaminated; each row is judged by its own text, whatever its doc_id; other columns are
    kept as they are; an empty table stays empty.
    """
    with common.tables() as kept:
        rows, key = _keyed(docs)
        with common.tables() as spent:
            found = contamination(rows.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=key)
            gone = common.saved(found.where("contaminated").select(F.col("doc_id").alias(key)), "contaminated")
            kept.append(spent.pop())
            common.drop_tables(spark, spent)
    return _without(rows, key, gone)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document.

    Null and empty texts have size 0 and are not taken; a null source is one of its own; rows that repeat are decided one
    by one; an empty table gives no rows.
    """
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
#: A trained network and random rounding decide: tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is stored and read again, and what a stage stored is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with common.tables() as spent:
            out = stage(spark, docs, sf_dir)
        with common.tables() as result:
            docs = common.saved(out, f"stage-{name}")
        common.drop_tables(spark, spent + before)
        before = list(result)
    return STAGES[-1][1](spark, docs, sf_dir)
