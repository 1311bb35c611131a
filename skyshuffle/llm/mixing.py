"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import few, saved, word_count

BROADCAST_SOURCES = 100_000  # one row each
FAN_IN = 2048  # documents, later residuals, that one task pairs


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source of sizes(source, size): source, source_size, target.

    Sources by code point, null last, take the weights in turn and share `share` times all sizes. A target stops at
    `most` times its source's size; what that leaves is shared again by weight until no target is above its stop. The
    fixed point is level * weight below the stop, found by running sums over sources in order of stop / weight.
    An empty table has no sources; sources of size 0 get 0. Window functions here see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    ratio = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = ratio.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    per = per.withColumn("weight", weight)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left / open_weight)
    level = F.max("level").over(everything)  # it rises up to the first source that is not stopped, then falls
    target = F.least(level * F.col("weight"), F.lit(most) * F.col("source_size"))
    return per.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(target).alias("target"))


def _pair(sizes: np.ndarray, copies: np.ndarray, part: np.ndarray, draws: np.ndarray) -> int:
    """Pivotal rounding along one list, in place; the index of the one document left between integers, or -1.

    Large documents come first, so that the one left over tends to be small. Two documents with fractions p, q of a copy exchange words: one gains d words, the other loses d, until either
    fraction is 0 or 1. Which way is drawn so that every fraction keeps its mean.
    """
    held = -1
    for i in range(len(sizes)):
        if part[i] <= 0:
            continue
        if held < 0:
            held = i
            continue
        a, b, p, q = sizes[held], sizes[i], part[held], part[i]
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)  # words that held can gain, lose
        if draws[i] * (up + down) < down:
            gains = up
            done_a, done_b = (1 - p) * a <= q * b, q * b <= (1 - p) * a
            p, q = (1.0 if done_a else p + gains / a), (0.0 if done_b else q - gains / b)
        else:
            done_a, done_b = p * a <= (1 - q) * b, (1 - q) * b <= p * a
            p, q = (0.0 if done_a else p - down / a), (1.0 if done_b else q + down / b)
        part[held], part[i] = p, q
        for k, done in ((held, done_a), (i, done_b)):
            if done:
                copies[k] += int(part[k])
                part[k] = 0.0
        held = -1 if done_a and done_b else i if done_a else held
    return held


def _rounder(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_key"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
        name = f"{seed}|{pdf['source'].iloc[0]!r}|{pdf['level'].iloc[0]}|{pdf['slot'].iloc[0]}"
        rng = np.random.default_rng(int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big"))
        sizes, copies, part = pdf["size"].to_numpy(float), pdf["copies"].to_numpy().copy(), pdf["part"].to_numpy().copy()
        held = _pair(sizes, copies, part, rng.random(len(pdf)))
        if last and held >= 0:
            copies[held] += int(rng.random() < part[held])
            part[held], held = 0.0, -1
        return pdf.assign(copies=copies, part=part)

    return run


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per row of docs.

    A document's expected copies are target / source_size. Its whole copies are certain; the fraction is rounded by
    pivotal sampling within the source, so that the words taken stay within one document of the target and each
    document keeps its mean. Lists of about FAN_IN documents are rounded apart; the at most one document that each
    leaves undecided goes to the next level of the tree, until one list per source is left.

    Slots and draws depend on doc_id, source and size alone, and for rows that agree in all three on a number of each:
    reruns agree whatever the partitions, and no doc_id, nor null, gathers in one list. Null and empty texts
    have size 0 and 0 copies; a null source is a source of its own; rows that repeat are decided one by one; an empty
    table gives no rows. A source of one row is one list; a hot source is many.
    """
    rows = saved(docs.select(F.col(doc_id).alias("doc_key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")), "mix-sizes")
    targets = saved(source_targets(rows, weights, share, most), "mix-targets")
    counts = rows.groupBy("source").agg(F.count("*").alias("n"))
    plan = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).select(targets["source"].alias("s"), "source_size", "target", "n")
    most_n = plan.agg(F.max("n")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    alike = rows.where("size > 0").groupBy("doc_key", "source", "size").agg(F.count("*").alias("m")).withColumn("number", F.explode(F.sequence(F.lit(1), F.col("m"))))
    every = alike.select("doc_key", "source", "size", "number").unionByName(rows.where("size = 0").select("*", F.lit(0).cast("long").alias("number")))
    state = every.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_key", "source", "size", F.when(F.col("size") > 0, F.floor(ratio)).otherwise(0).cast("long").alias("copies"),
        F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0).alias("part"), "n",
        F.xxhash64(F.col("doc_key").cast("string"), F.col("size"), F.lit(seed), F.col("number")).alias("spot"),
    )
    schema = "doc_key long, source string, size long, copies long, part double, n long, spot long, level int, slot long"
    done, level, width = [], 0, most_n
    while True:
        lists = F.greatest(F.ceil(F.col("n") / F.lit(FAN_IN ** (level + 1))), F.lit(1))
        state = state.withColumns({"level": F.lit(level), "slot": F.pmod(F.col("spot"), lists).cast("long")})
        last = width <= FAN_IN
        open_, shut = state.where("part > 0"), state.where("part <= 0")
        state = saved(open_.groupBy("source", "slot").applyInPandas(_rounder(seed, last), schema).unionByName(shut.select(*open_.columns)), f"mix-level{level}")
        done.append(state.where("part <= 0"))
        if last:
            break
        state, level, width = state.where("part > 0").drop("level", "slot"), level + 1, -(-width // FAN_IN)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.join(F.broadcast(plan) if few(plan, BROADCAST_SOURCES) else plan, F.col("source").eqNullSafe(F.col("s")))
    return out.select(F.col("doc_key").alias("doc_id"), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
