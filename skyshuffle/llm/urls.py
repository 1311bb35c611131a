"""URL filters: a blocked Bloom filter in front of an exact hash join, all in DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, saved

BLOCK_WORDS = 4  # 64-bit words of a filter block
HASHES = 6  # bits set per key, all in one block
KEYS_PER_BLOCK = 16
#: A list of at most so many rules is broadcast; a longer one is joined by shuffle.
BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(after), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a DataFrame, for short lists; a long list is read from a table of these columns."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).select(*[F.lit("").alias(c) for c in ("verdict", "rule_host", "rule_path")])


def _slot(key: Column, blocks: int) -> list[Column]:
    """The block of a key, and the mask that it sets in each of the block's words."""
    spread = F.xxhash64(key, F.lit("bits"))
    masks = [F.lit(0).cast("long")] * BLOCK_WORDS
    for i in range(HASHES):
        bit = F.shiftrightunsigned(spread, 8 * i).bitwiseAND(F.lit(64 * BLOCK_WORDS - 1))
        word, shift = F.floor(bit / 64), (bit % 64).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
        masks = [m.bitwiseOR(F.when(word == w, one).otherwise(F.lit(0).cast("long"))) for w, m in enumerate(masks)]
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *(m.alias(f"m{w}") for w, m in enumerate(masks))]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: one row of BLOCK_WORDS words for each block that holds a key."""
    return keys.select(*_slot(F.col(key), blocks)).groupBy("block").agg(*(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to pages.

    rules has verdict (allow or block), rule_host and rule_path. A rule fits its host and every subdomain when the path
    starts with the rule's path; the longest host+path wins, then block before allow. A URL that no rule fits gets
    rule null and the default verdict.

    Each URL gives the keys that a listed entry could have (its host's suffixes of listed label counts, its path's
    prefixes of listed lengths). Keys that the Bloom filter lets through meet the rules in an exact hash join. With a short
    list both happen where pages are read, and hits alone are shuffled; with a long one, URLs are made distinct first.
    Null URLs and URLs without :// have empty host and path; repeated pages each keep their row; columns of pages named
    host, path, rule or verdict are replaced; an empty list gives every URL the default.
    """
    made = ("host", "path", "rule", "verdict")
    free = [c for k in range(len(pages.columns) + 2) if (c := f"made{k}") not in pages.columns][:2]
    pages = pages.withColumns(dict(zip(free, (url_host(F.col(url)), url_path(F.col(url))), strict=True))).drop(*made).withColumnsRenamed(dict(zip(free, made, strict=False)))
    rules = rules.select("verdict", "rule_host", "rule_path").withColumn("key", F.concat_ws(" ", "rule_host", "rule_path"))
    shape = rules.agg(
        F.count("*").alias("n"),
        F.collect_set(F.size(F.split("rule_host", "\\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    if not shape["n"]:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    small = shape["n"] <= BROADCAST_RULES
    near = F.broadcast if small else (lambda df: df)
    blocks = max(1, shape["n"] // KEYS_PER_BLOCK)

    host, path = F.col("host"), F.col("path")
    labels = F.size(F.split(host, "\\."))
    hosts = F.array(*(F.when(labels >= k, F.substring_index(host, ".", -k)) for k in sorted(shape["labels"])))
    paths = F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(shape["lengths"])))
    urls = pages.where(host != "").select("host", "path")
    keys = (
        (urls if small else urls.distinct())
        .withColumn("suffix", F.explode(hosts)).where(F.col("suffix").isNotNull())
        .withColumn("prefix", F.explode(paths)).where(F.col("prefix").isNotNull())
        .withColumn("key", F.concat_ws(" ", "suffix", "prefix"))
    )
    bloom = bloom_blocks(rules, "key", blocks)
    possible = keys.select("host", "path", "key", *_slot(F.col("key"), blocks)).join(near(bloom), "block")
    for w in range(BLOCK_WORDS):
        possible = possible.where(F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    rank = F.struct(F.length("key"), F.when(F.col("verdict") == "block", 1).otherwise(0))
    exact = saved(
        possible.select("host", "path", "key").join(near(rules), "key")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), rank).alias("hit")),
        "url-hits",
    )
    # stored, so that AQE can split the join where one URL has very many pages; pages without host need none. Hits grow with
    # the pages, and a compressed table's size bounds no broadcast: the join is by shuffle
    hit = exact.select("host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("verdict"))
    met = pages.where(host != "").join(hit.hint("merge"), ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    rest = pages.where(host == "").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    return met.select(*rest.columns).unionByName(rest)


RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP7_SQL = f"""
WITH rules(v, h, p) AS (VALUES {_RULES_SQL}),
parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path,
  (SELECT h || p FROM rules WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) ORDER BY length(h || p) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM rules WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) ORDER BY length(h || p) DESC LIMIT 1), 'allow') AS verdict
FROM parsed"""
