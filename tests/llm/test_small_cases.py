"""Edge cases and brute-force versions of the training-data operators on small tables."""

import gzip
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyshuffle.llm import common, decontaminate, extraction, jaccard, language, learning, markup, mixing, quality, queries, substrings, topk, urls, warc
from skyshuffle.llm.components import components
from tests.oracle import same

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string, score double, node string"
VOCAB = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "é")]


def _text(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty texts, copies, near copies, shared passages, ties, one long text, columns with clashing names."""
    rng = random.Random(3)
    passage, long = _text(rng, 40), _text(rng, 4000)
    rows = [(1, None), (2, ""), (3, "  \n\t"), (4, "One"), (5, "one"), (6, _text(rng, 4)), (None, _text(rng, 30)), (None, None)]
    base = [_text(rng, rng.randint(20, 300)) for _ in range(12)]
    for k, t in enumerate(base):
        rows.append((10 + k, t))
        words = t.split(" ")
        rows.append((100 + k, t.upper() if k % 3 == 0 else t))
        for j in range(3):
            w = list(words)
            for _ in range(j + 1):
                w[rng.randrange(len(w))] = "zz"
            rows.append((200 + 10 * k + j, " ".join(w)))
    rows += [(900 + k, f"{_text(rng, 20)}\n{passage}  {_text(rng, 15)}") for k in range(5)]
    rows += [(990, long), (991, long + " tail"), (10, base[0]), (992, "   " + passage + "\n")]
    return spark.createDataFrame([(i, t, ["a", "b", None][k % 3], 0.5, "x") for k, (i, t) in enumerate(rows)], DOC).repartition(3)


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def _words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


def _lower(t):
    return (t or "").translate(str.maketrans(common.UPPER, common.LOWER))


def test_kernel_agrees_with_regular_expressions():
    rng = random.Random(1)
    texts = ["", " ", "a", " a", "a ", "é ü\x0bß", *("".join(rng.choice(" \n\tab1é.-") for _ in range(rng.randint(0, 40))) for _ in range(200))]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    buf = np.frombuffer(b"".join(data), np.uint8)
    for table, pattern in ((common.SPACE, r"[^\x20\x09-\x0d]+"), (common.ALNUM, r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        found = common.words(buf, bounds, table, lower=True)
        got = [buf[s:e].tobytes().decode().lower() for s, e in zip(found.starts, found.ends)]
        want = [w for t in texts for w in re.findall(pattern, t.lower())]
        assert got == want and found.counts.tolist() == [len(re.findall(pattern, t.lower())) for t in texts]
        by = {}
        for w, h in zip(want, found.hashes.tolist()):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(x)) == x).all() and len(common.unpack(common.pack(x[:0]))) == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)


# --- near duplicates ---------------------------------------------------------------------------------------------


def _shingles(t):
    w = _words(_lower(t))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _components(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2):
        n = len(a & b)
        if 100 * n >= 80 * (len(a) + len(b) - n):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def test_near_duplicates_by_brute_force(spark, docs, monkeypatch):
    got = sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=repr)
    assert got == _components(_pairs(docs))
    assert len({c for _, _, c in got if c}) < len(got) - 20


def test_near_duplicates_of_nothing(spark, docs):
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def _n_links(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    n = [0] * len(sets)
    for (j, (x, a)), (k, (y, b)) in itertools.combinations(enumerate(sets), 2):
        if x is not None and y is not None and a and b and 5 * len(a & b) >= 4 * len(a | b):
            n[j], n[k] = n[j] + 1, n[k] + 1
    return sorted(((i, len(s), c) for (i, s), c in zip(sets, n)), key=repr)


def test_links_by_brute_force(spark, docs, monkeypatch):
    """Near copies of one text, all different, have links with nearly all others; in small tiles as in large ones."""
    rng = random.Random(5)
    words = _text(rng, 400).split(" ")
    near = [(2000 + k, " ".join([*words[:k], f"z{k}", *words[k + 1 :]])) for k in range(40)] + [(2000, "x"), (2050, " ".join(words))] + [(2100 + k, " ".join(words[: 400 - 9 * k])) for k in range(20)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    want = _n_links(_pairs(docs))
    assert sum(n >= 39 for _, _, n in want) >= 40
    for tile in (256, 7):
        monkeypatch.setattr(jaccard, "TILE", tile)
        got = jaccard.near_duplicates(docs, links=True).select("doc_id", "n_shingles", "n_links").collect()
        assert sorted((tuple(r) for r in got), key=repr) == want
    assert queries.QUERIES["op3_ngram_jaccard"](spark, SF).columns[-1] == "n_links"


def test_overlaps_of_rare_and_common_shingles():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in [*range(40), *rng.integers(0, 30, 5), *rng.integers(0, 3, 8)]) for _ in range(200)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    sets = jaccard.ShingleSets(common.words(np.frombuffer("".join(texts).encode(), np.uint8), bounds))
    got = jaccard.overlaps(sets)
    assert all(got[a, b] == jaccard.overlap(sets.of(a), sets.of(b)) for a in range(200) for b in range(200))


def test_tree_bound_never_loses_a_pair():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200))).astype(np.uint64) for _ in range(150)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * 0.93)], rng.integers(1000, 1100, 2).astype(np.uint64)])) for s in sets]
    points = np.stack([np.bincount((s % 16).astype(int), minlength=16) for s in sets]).astype(np.int32)
    tree, links = jaccard.CountTree(points), 0
    for k, s in enumerate(sets):
        near = set(tree.search(points[k], len(s)).tolist())
        for j, o in enumerate(sets):
            n = len(np.intersect1d(s, o))
            if 100 * n >= 80 * (len(s) + len(o) - n):
                links += 1
                assert j in near and jaccard.overlap(s, o) >= jaccard.needed(len(s), len(o))
    assert links > len(sets)


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- substrings --------------------------------------------------------------------------------------------------


def _removed(rows, window=13):
    first = {}
    for i, t in rows:
        w = _words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, t in rows:
        w = _words(t)
        hit = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (math.inf if i is None else i):
                hit |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in hit)
        out.append((i, len(w), len(hit), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [50, 2_000_000])
def test_substrings_by_brute_force(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(substrings, "BIN_SUFFIXES", limit)
    got = sorted((tuple(r) for r in substrings.dedup_substrings(docs, keep_text=True).collect()), key=repr)
    assert got == _removed(_pairs(docs))
    assert sum(r[2] for r in got) > 1000


def _repeats(rows, window=13):
    first, out = {}, []
    for i, t in rows:
        w = _words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    for i, t in rows:
        w, last = _words(t), None
        for k in range(len(w) - window + 1):
            owner = first[tuple(w[k : k + window])]
            if owner < (math.inf if i is None else i):
                if last and last[2] == k + window - 1 and last[3] == owner:
                    last[2] += 1
                else:
                    out.append(last := [i, k, k + window, owner])
    return sorted(map(tuple, out), key=repr)


def test_maximal_repeats_by_brute_force(spark, docs, monkeypatch):
    for limit in (40, 2_000_000):
        monkeypatch.setattr(substrings, "BIN_SUFFIXES", limit)
        got = sorted((tuple(r) for r in substrings.maximal_repeats(docs).collect()), key=repr)
        assert got == _repeats(_pairs(docs)) and len(got) > 40
    assert substrings.maximal_repeats(docs.limit(0)).count() == 0


def test_crowded_prefixes_are_extended():
    """Groups stay in bounds whatever the corpus: prefixes are extended until few enough suffixes share them."""
    rng = np.random.default_rng(3)
    text = b" ".join(b"w%d" % x for x in np.minimum(rng.zipf(1.3, 60000), 500))
    found = common.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    prefixes, at = substrings.Prefixes(13, 60000, 400), substrings._starts(found, 13)
    for _ in range(len(prefixes.depths)):
        level, bucket = prefixes.place(found, at)
        counts = np.bincount(bucket[level == len(prefixes.heads)])
        heads = np.flatnonzero(counts > prefixes.limit)
        if not len(heads) or len(prefixes.heads) + 1 == len(prefixes.depths):
            break
        prefixes.extend(heads, counts[heads])
    assert len(prefixes.heads) >= 2 and sum(prefixes.sizes) < 60000
    _, sizes = np.unique(level * (1 << 40) + bucket, return_counts=True)
    assert sizes.max() <= prefixes.limit == 100
    many = substrings.Prefixes(13, 10**13, 2_000_000)  # what the driver holds does not follow the corpus beyond that
    assert 10**13 // many.limit <= substrings.MOST_HEADS and many.sizes[0] <= 8 * substrings.MOST_HEADS


def test_substrings_keep_columns(spark, docs):
    out, changed = substrings.remove_substrings(docs.withColumn("changed", F.lit(1)))
    assert changed == "changed0" and out.columns == [*docs.columns, "changed", "changed0"]
    want = {(i, k) for i, _, n, _, k in _removed(_pairs(docs)) if n}
    assert {(r["doc_id"], r["text"]) for r in out.where(changed).collect()} == want
    same_ = out.where(f"not {changed}").select("doc_id", "text", "source")
    assert same_.exceptAll(docs.select("doc_id", "text", "source")).count() == 0
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


# --- benchmark ---------------------------------------------------------------------------------------------------


def _contamination(rows, items, window=13):
    pattern = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    grams = {}
    for item, t in items:
        w = re.findall(pattern, _lower(t)) if item is not None else []
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k : k + min(window, len(w))]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for i, t in rows:
        w, hit, seen = re.findall(pattern, _lower(t)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := grams.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    seen |= found
        out.append((i, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [100, 4 << 20])
def test_contamination_by_brute_force(spark, docs, monkeypatch, block):
    rows = _pairs(docs)
    long = max((t for _, t in rows if t), key=len).split(" ")
    items = [(1, " ".join(long[5:30])), (2, "ONE"), (3, None), (4, ""), (None, "one"), (5, " ".join(long[100:108]) + "!"), (5, "ba bé"), (6, "ONE"), (7, " ".join(long[5:30]))]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).drop("spans", "items")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _contamination(rows, items)


def test_contamination_of_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "one")], "item_id long, text string")).count() == 0


def test_proximity_ignores_order_and_stays_in_documents(spark):
    rows = spark.createDataFrame([(1, "red x x green blue"), (2, "green red"), (3, "blue"), (4, "blue red " + "x " * 50 + "green")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "red green blue")], "item_id string, text string")
    assert {r.doc_id for r in decontaminate.proximity(rows, items, 5).collect()} == {1}


# --- search ------------------------------------------------------------------------------------------------------


def test_topk_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = [(int(k), [float(v) for v in rng.normal(0, 0.2, 8).astype(np.float32)]) for k in range(230)]
    data[7] = (7, None)
    data[9] = (9, [None, *data[9][1][1:]])
    data[11] = (11, [math.nan, *data[11][1][1:]])
    data[13] = (13, data[12][1])
    data += [(None, data[5][1]), (500, [0.1, 0.2]), (501, []), (50, data[50][1]), (60, data[60][1]), (550, [1e12] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    fine = [(i, [math.floor(256 * float(np.float32(v))) for v in x]) for i, x in data if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    want = []
    for q, x in {i: x for i, x in fine if i % 50 == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in fine if i != q and len(y) == len(x))[:5]
        want += [(q, r, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(found, 1)]
    assert sorted(tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df).collect()) == sorted(want)
    for queries, block, seeds in ((7, 3, 0), (2, 2, 9)):  # whatever the blocks and first thresholds
        monkeypatch.setattr(topk, "QUERIES", queries)
        monkeypatch.setattr(topk, "QUERY_BLOCK", block)
        monkeypatch.setattr(topk, "SEEDS", seeds)
        assert sorted(tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df).collect()) == sorted(want)
    rows = [(0, [1.0, math.nan]), (0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, None)]
    few = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few.where("vec_id = 0"), few).collect()] == [(0, 1, 1, 2 * 65536)]  # the smallest valid query of the id
    assert topk.top_k(df.limit(0), df).count() == 0


def test_topk_of_batches_that_hold_no_result(spark):
    """The bounds let candidates pass whose exact scores are all too low."""
    rng = np.random.default_rng(5)
    data = [(int(k), [float(v) for v in rng.normal(0, 0.2, 64).astype(np.float32)]) for k in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").coalesce(1)
    e = [[math.floor(256 * v) for v in x] for _, x in data]
    want = []
    for q in range(0, 200, 50):
        found = sorted((-sum(a * b for a, b in zip(e[q], e[i])), i) for i in range(200) if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert sorted(tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df).collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("scale", [1.0, 60.0, 1e7, 1e12])  # single precision, double, beyond doubles' integers
def test_topk_is_exact_at_any_scale_and_density(scale):
    rng = np.random.default_rng(6)
    centre = rng.normal(0, 1, (5, 16))[rng.integers(0, 5, 300)]
    for x in (rng.normal(0, 50, (300, 16)), 200 * centre + rng.normal(0, 1, (300, 16))):  # bounds drop hardly any; nearly all
        x, ids = np.floor(x * scale), np.arange(300)
        best = topk._Best(ids[::50], x[::50], 5, (ids[:20], x[:20]))
        for s in range(0, 300, 60):
            best.add(topk._Rows(ids[s : s + 60], x[s : s + 60]))
        whole = [[int(v) for v in row] for row in x]
        for q, found in zip(ids[::50], best.rows):
            assert found == sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), int(i)) for i in ids if i != q)[:5]


def test_bounds_are_bounds():
    x = np.random.default_rng(1).normal(0, 50, (60, 64))
    exact, last = x @ x.T, None
    for s in topk.LEVELS:
        f = topk.segment_statistics(x, s)
        bound = f @ f.T
        assert (bound >= exact - 1e-6).all() and (last is None or (bound <= last + 1e-6).all())
        last = bound


# --- URLs --------------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"), "x": ("", "", None, "allow"), "http://": ("", "", None, "allow"), "http://COM/en/1": ("com", "/en/1", "com/en/", "block"),
        "http://a.com/EN/": ("a.com", "/EN/", None, "allow"), "http://xcom/en/": ("xcom", "/en/", None, "allow"), "h://b.example.com/en/77?q#f": ("b.example.com", "/en/77", "example.com/en/7", "allow"),
        "h://example.com/en/6": ("example.com", "/en/6", "com/en/", "block"), "h://x.net/de/8": ("x.net", "/de/8", "net/de/", "allow"), "h://example.net/de/88#": ("example.net", "/de/88", "example.net/de/8", "block"),
        "h://org?x/es/": ("org", "", None, "allow"), "h://q.ORG/es/\n1": ("q.org", "/es/\n1", "org/es/", "block"), "a://b.org/es/://c.com/en/": ("b.org", "/es/://c.com/en/", "org/es/", "block"),
        "h://" + ".".join("a" * 300) + ".com/en/": (".".join("a" * 300) + ".com", "/en/", "com/en/", "block"),
    }
    df = spark.createDataFrame([(u, "old") for u in [*cases, "http://COM/en/1"]], "url string, verdict string")
    got = urls.filter_urls(df, urls.rule_table(spark, urls.RULES)).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]], r
    assert {r["verdict"] for r in urls.filter_urls(df, urls.rule_table(spark, [])).collect()} == {"allow"}
    for name in ("host", "path", "rule", "verdict"):  # the URL's own column is replaced too
        back = urls.filter_urls(df.select(F.col("url").alias(name), F.lit(1).alias("made0")), urls.rule_table(spark, urls.RULES), url=name)
        assert sorted(back.columns) == ["host", "made0", "path", "rule", "verdict"] and sorted(map(str, (r["verdict"] for r in back.collect()))) == sorted(r["verdict"] for r in got)
    assert urls.filter_urls(df.limit(0), urls.rule_table(spark, urls.RULES)).count() == 0


def test_url_filter_runs_no_python(spark):
    plan = queries.op7_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan


def test_bloom_filter_has_no_false_negatives(spark):
    rules = spark.range(5000).select(F.lit("block").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".com")).alias("rule_host"), F.lit("/a").alias("rule_path"))
    pages = spark.range(6000).select(F.concat(F.lit("http://h"), "id", F.lit(".com/ab")).alias("url"))
    assert urls.filter_urls(pages, rules).where("verdict = 'block'").count() == 5000


# --- mixing ------------------------------------------------------------------------------------------------------


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, out = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        left, w = total - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > most * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        out |= {s: most * sizes[s] for s in over}


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 16)  # several levels of the tree
    rng = random.Random(5)
    rows = [(k, _text(rng, rng.choice([0, 1, 5, 30, 80])) if k % 50 else None, rng.choice(["a", "a", "a", "a", "B", "c", None, "é"])) for k in range(900)] + [(1, "x y", "solo"), (2, "v " * 40000, "é"), *[(None, "w w", "a")] * 60, (3, "t t", "a"), (3, "t t", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(_words(t))
    want = _targets(sizes)
    for s, target in want.items():
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 * target + 1e-9 and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine)
    assert all(r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_pivotal_rounding_keeps_means_and_sums():
    rng = np.random.default_rng(6)
    sizes, mean = np.array([5.0, 3, 8, 1, 13, 2, 2, 7]), np.zeros(8)
    for _ in range(4000):
        copies, part = np.zeros(8, np.int64), np.full(8, 0.3)
        held = mixing._pair(sizes, copies, part, rng.random(8))
        assert abs((copies + part) @ sizes - 0.3 * sizes.sum()) < 1e-9 and ((part > 0).sum() == (held >= 0))
        mean += copies + part
    assert np.abs(mean / 4000 - 0.3).max() < 0.04


# --- learned -----------------------------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.score_quality(docs, quality.train_quality(docs, labels)).join(labels, "doc_id").where("held_out")
    right, n = got.where("predicted = quality").count(), got.count()
    assert n > 50 and right >= 0.95 * n
    assert got.where("score < 0 or score > 1 or (predicted = 1) <> (score >= 0.7)").count() == 0


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(10, 20)] + [(10, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train_quality(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.keep_quality(docs, model).columns == docs.columns
    assert quality.score_quality(docs.limit(0), model).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, quality.train_quality(docs, labels.limit(0))).collect()} == {1.0}
    held = {r["doc_id"]: r["held_out"] for r in got if r["doc_id"] is not None}
    import zlib

    assert all(v == (zlib.crc32(str(k).encode()) % 4 == 2) for k, v in held.items())


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify_language(docs, language.train_language(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.where("lang_pred = lang").count(), got.count()
    assert n > 100 and right >= 0.95 * n


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, "the cat and the dog " * 40, "en"), (5, "жук", None), (6, "el gato y el perro " * 40, "es"), (None, "the", "en"), (7, "the dog " * 9, "en"), (8, "el perro " * 9, "es")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.identify_language(df, language.train_language(df)).collect()}
    assert len(got) == len(rows)
    assert [got[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and got[5]["lang_pred"] in ("en", "es")
    assert language.identify_language(df.limit(0), language.ByteNetwork()).count() == 0
    assert {r["lang_pred"] for r in language.identify_language(df, language.train_language(df.limit(0))).collect()} == {"und"}


def test_byte_network_against_plain_convolution():
    """Windows of several texts at once give what one window alone gives, filter by filter and place by place."""
    rng = np.random.default_rng(9)
    f, n = language.FILTERS * len(language.WIDTHS), language.LENGTH
    net = language.ByteNetwork()
    net.langs = ["a", "b", "c"]
    net.weights = {"embed": rng.normal(0, 1, (257, language.EMBED)), "filter": rng.normal(0, 1, (language.WIDEST * language.EMBED, f)) * net._mask(), "bias": rng.normal(0, 1, f), "out": rng.normal(0, 1, (f, 3)), "out_bias": rng.normal(0, 1, 3)}
    net.weights = {k: v.astype(np.float32) for k, v in net.weights.items()}
    net.weights["embed"][language.PAD] = 0
    texts = [b"The Cat sat", b"x", b"", "жук й".encode() * 60, b"Ab c" * 200]
    langs, p = net.predict(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    w = net.weights
    for text, lang, got in zip(texts, langs, p, strict=True):
        if not text:
            assert (lang, got) == ("und", 0)
            continue
        total = np.zeros(3)
        for s in range(0, len(text), n):
            window = text[s : s + n].lower()
            cells = list(window) + [language.PAD] * (n + language.WIDEST - 1 - len(window))
            pooled = []
            for k in range(f):
                width = language.WIDTHS[k // language.FILTERS]
                at = [sum(float(w["embed"][cells[i + j]] @ w["filter"][j * language.EMBED : (j + 1) * language.EMBED, k]) for j in range(width)) for i in range(n)]
                pooled.append(max(0.0, max(at) + float(w["bias"][k])))
            total += (np.array(pooled) @ w["out"] + w["out_bias"]) * len(window)
        e = np.exp(total / len(text) - (total / len(text)).max())
        assert lang == net.langs[int(e.argmax())] and abs(got - (e / e.sum()).max()) < 1e-3


def test_quality_network_against_plain_pooling(monkeypatch):
    """Documents of many sizes pooled at once give what each gives alone, symbol by symbol."""
    rng = np.random.default_rng(2)
    monkeypatch.setattr(quality, "BLOCK", 3)
    doc = np.repeat(np.arange(7), [3, 0, 1, 5, 0, 2, 4])
    symbol, vectors = rng.integers(0, 6, len(doc)), rng.normal(0, 1, (6, 4)).astype(np.float32)
    got = quality._pooled(7, doc, symbol, vectors)
    for k in range(7):
        own = [vectors[s] for d, s in zip(doc, symbol, strict=True) if d == k]
        assert np.allclose(got[k], np.mean(own, 0) if own else 0, atol=1e-5)
    spots = quality._index_spots(6, 1)
    total = np.zeros((6 * quality.DIM), np.int64)
    quality._add_contexts(total, symbol, doc, spots)
    plain = np.zeros((6, quality.DIM), np.int64)
    for i in range(len(doc)):
        for j in range(max(0, i - quality.CONTEXT), min(len(doc), i + quality.CONTEXT + 1)):
            if i != j and doc[i] == doc[j]:
                for k, spot in enumerate(spots):
                    plain[symbol[i], spot[symbol[j]]] += 1 if k % 2 else -1
    assert (total.reshape(6, -1) == plain).all()


def test_temperature_flattens_overconfidence():
    rng = np.random.default_rng(0)
    gold = rng.integers(0, 2, 400)
    logits = np.where(np.eye(2)[np.where(rng.random(400) < 0.8, gold, 1 - gold)] > 0, 8.0, 0.0)
    assert learning.temperature(logits, gold) > 2


# --- pages -------------------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><article><h1>The &amp; headline</h1><p>First  para<br>graph with <b>bold</b> text and more words.</p><p>Second paragraph, also long enough to read.</article>
<div class="comments"><div class="comment"><p>Nice post, thanks.</p></div></div><footer>&copy; x.example</footer></body></html>"""


def test_blocks():
    got = [b.text for b in markup.blocks(PAGE)]
    assert got == ["Home", "News", "We use cookies.", "The & headline", "First para graph with bold text and more words.", "Second paragraph, also long enough to read.", "Nice post, thanks.", "© x.example"]
    for broken in ("", None, "<", "a < b", "<p", "<!--", "<script>x", '<a href="x', "<p title='a>b'>c</p>", "&amp", "</p></div>"):
        markup.blocks(broken)
    assert [b.text for b in markup.blocks("<p title='a>b'>c</p>a < b")] == ["c", "a < b"]
    assert [b.text for b in markup.blocks("<p>a<noscript>b<p>c<select><option>d<svg>e")] == ["a", "b", "c", "d", "e"]  # never closed
    assert markup.plain_text("<title>T &amp; U</title><p>x") == "T & U\nx" and [b.text for b in markup.blocks("<title>T</title><p>x")] == ["x"]


def test_long_broken_pages_take_time_in_proportion():
    n = 20000
    pages = ["</b>" * n + "<b>" * n + "</i>" * n, "<div>" * 8000 + "<p>x" * 8000, ("<p><li>" + "<b>" * 50) * 2000, "<p><li><div>" + "<b>" * n + "<p><li>" * n, "<svg>x" * n, "<a href=\"" * n, "<a \">\"'" * n, "<a '\">" * n]
    cache, start = {}, time.process_time()
    for page in pages:
        found = markup.blocks(page)
        if found:
            assert extraction.page_features(found, cache).shape == (len(found), extraction.FEATURES)
    assert time.process_time() - start < 20 and len(markup.blocks(pages[1])) == 8000


def test_ends_of_tags_by_brute_force():
    """Quotes in tags, closed and not, against a walk over the characters from each tag anew."""

    def walk(source, at):
        quote = ""
        for k in range(at, len(source)):
            if quote:
                quote = "" if source[k] == quote else quote
            elif source[k] in "\"'":
                quote = source[k]
            elif source[k] == ">":
                return k + 1
        return source.find(">", at) + 1 or len(source)

    def texts(source):
        out, at = [], 0
        while at < len(source):
            if re.match("</?[a-z]", source[at : at + 3]):
                end = walk(source, at)
                if source[at : at + 2] == "<p" or source[at : at + 3] == "</p":
                    out.append("")
            else:
                end = at + 1
                out = (out or [""])[:-1] + [(out or [""])[-1] + source[at]]
            at = end
        return [" ".join(t.split()) for t in out if t.split()]

    rng = random.Random(5)
    for _ in range(4000):
        source = "".join(rng.choice(["<p ", "<p>", "</p>", "<b ", "<b>", '"', "'", ">", "x", "y ", ' c="d"']) for _ in range(rng.randint(1, 25)))
        assert [b.text for b in markup.blocks(source)] == texts(source), source


def test_labeller_against_plain_recurrence():
    """Batches of padded pages give what one page alone gives, one block and one unit at a time."""
    model, rng, h = extraction.BlockLabeller(), np.random.default_rng(4), extraction.HIDDEN
    pages = [rng.normal(0, 1, (n, extraction.FEATURES)).astype(np.float32) for n in (1, 4, 9)]
    logits, *_ = model.logits(*extraction._padded(pages))

    def states(d, rows):
        out, cell, out_all = [0.0] * h, [0.0] * h, []
        for row in rows:
            z = [float(row @ model.w[f"{d}x"][:, k]) + float(model.w[f"{d}c"][k]) + sum(out[j] * float(model.w[f"{d}h"][j, k]) for j in range(h)) for k in range(4 * h)]
            gate = lambda k: 1 / (1 + np.exp(-z[k]))  # noqa: B023, E731
            cell = [gate(h + j) * cell[j] + gate(j) * np.tanh(z[3 * h + j]) for j in range(h)]
            out = [gate(2 * h + j) * np.tanh(cell[j]) for j in range(h)]
            out_all.append(out)
        return out_all

    for k, page in enumerate(pages):
        both = zip(states("f", page), states("b", page[::-1])[::-1], strict=True)
        plain = [float(np.dot(a + b, model.w["out"][:, 0]) + model.w["bias"][0]) for a, b in both]
        assert np.allclose(logits[: len(page), k], plain, atol=1e-3)


def test_extraction_of_labelled_pages(spark):
    model = extraction.train_labeller()
    rng, right, n = random.Random(77), 0, 0
    for _ in range(80):
        found, labels = extraction.training_page(rng)
        right += sum(a == bool(b) for a, b in zip(model.main([found], {})[0], labels))
        n += len(labels)
    assert right >= 0.97 * n
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (1, "u", PAGE), (4, "u", "<p>" + "word " * 20000)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r for r in extraction.extract_main_text(df, model).collect()}
    assert got[1]["text"] == "The & headline\nFirst para graph with bold text and more words.\nSecond paragraph, also long enough to read."
    assert got[2]["text"] == got[3]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert extraction.extract_main_text(df.limit(0), model).count() == 0
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    bad = 0
    for r in extraction.extract_main_text(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(extraction.blocks(f"<p>{p}")[0].text.split()) if extraction.blocks(f"<p>{p}") else "" for p in re.split(r"</?(?:p|h1)>", inner))
        bad += r["text"] != "\n".join(p for p in parts if p)
    assert bad <= 0.02 * pages.count()


def test_index_holds_all_training_tokens(spark, docs, monkeypatch):
    """Words that no item has are in the stored index too, so that it serves other items."""
    built, build = [], decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda *a: built.append(build(*a)) or built[-1])
    items = spark.createDataFrame([("i", "one"), ("j", _text(random.Random(3), 13))], "item_id string, text string")
    found = decontaminate.contamination(docs, items)
    assert sum(len(common.unpack_sorted(r["postings"])) for r in built[0].collect()) == found.agg(F.sum("n_words")).first()[0] > 1000


def test_warc_codings():
    """Chunks and content codings are undone before text is taken; broken and unknown ones have a defined result."""
    page = ("<p>" + " ".join(f"word{k}" for k in range(3000)) + "</p>").encode()
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(page) + raw.flush()
    zipped = gzip.compress(page)

    def chunked(data):
        return b"".join(b"%x;a=b\r\n%s\r\n" % (len(data[s : s + 700]), data[s : s + 700]) for s in range(0, len(data), 700)) + b"0\r\n\r\n"

    def got(payload, *heads):
        block = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html", *heads]).encode() + b"\r\n\r\n" + payload
        meta, text = warc._derived({"WARC-Record-ID": "<x>"}, block)
        return text[-1], meta[-1]

    plain, chunks = markup.plain_text(page.decode()), "transfer-encoding: Chunked"
    assert got(page)[0] == plain
    for payload, *heads in (
        (chunked(page), chunks), (zipped, "Content-Encoding: gzip"), (chunked(zipped), chunks, "Content-Encoding: x-gzip"), (chunked(zipped), "Transfer-Encoding: gzip, chunked"),
        (zlib.compress(page), "Content-Encoding: deflate"), (raw, "Content-Encoding: deflate"), (gzip.compress(raw), "Content-Encoding: deflate, gzip"),
        (gzip.compress(page[:50]) + gzip.compress(page[50:]), "Content-Encoding: gzip"), (page, chunks, "Content-Encoding: gzip"), (page, "Content-Encoding: deflate"), (zipped + b"junk", "Content-Encoding: gzip"),
    ):
        assert got(payload, *heads)[0] == plain, heads
    for payload, head in ((chunked(page)[:5000], chunks), (zipped[: len(zipped) // 2], "Content-Encoding: gzip")):
        assert len(got(payload, head)[0]) > 1000 and plain.startswith(got(payload, head)[0])
    assert got(b"\x1b\x00\xf8", "Content-Encoding: br") == ("", got(b"\x1b\x00\xf8", "Content-Encoding: br")[1]) and "conversion-unknown-coding: br" in got(b"", "Content-Encoding: br")[1]
    assert got(b"", "Content-Encoding: gzip", chunks)[0] == ""


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/é", PAGE), (2, None, None), (3, "u", ""), (1, "http://x/é", PAGE)], "page_id long, url string, html string")
    source = warc.responses(pages)
    derived = warc.derive(source).collect()
    assert len(derived) == 8 and {r["warc_type"] for r in derived} == {"metadata", "conversion"}
    ids = {r["record_id"] for r in source.collect()}
    assert {r["refers_to"] for r in derived} == ids
    text = next(r for r in derived if r["warc_type"] == "conversion" and r["block"])
    assert text["block"] == "T\n" + "\n".join(b.text for b in markup.blocks(PAGE)) and text["source_payload_digest"] == warc.digest(PAGE.encode()) and text["block_digest"] == warc.digest(text["block"].encode())
    for name, compress in (("a.warc.gz", True), ("b.warc", False)):
        data = b"".join(bytes(r[0]) for r in warc.serialised(warc.derive(source), compress).collect())
        (tmp_path / name).write_bytes(data)
        back = warc.read_warc(spark, str(tmp_path / name)).collect()
        assert sorted((r["warc_type"], bytes(r["block"]).decode()) for r in back) == sorted((r["warc_type"], r["block"]) for r in derived)
    assert warc.derive(warc.read_warc(spark, str(tmp_path / "b.warc"))).count() == 0  # no responses there
    assert warc.derive(source.limit(0)).count() == 0
    one = [warc.serialise({"WARC-Type": "resource", "WARC-Record-ID": f"<{k}>"}, b"x" * (200_000 * k)) for k in range(3)]
    broken = bytearray(one[1])
    broken[40] ^= 255
    told = lambda data: [(f["WARC-Record-ID"], len(b)) for f, b in warc.records(data)]
    assert told(b"".join(one)) == [("<0>", 0), ("<1>", 200_000), ("<2>", 400_000)]
    assert told(one[0] + bytes(broken) + one[2]) == told(one[0] + one[1][:60] + one[2]) == [("<0>", 0), ("<2>", 400_000)]
    assert told(gzip.compress(b"".join(map(gzip.decompress, one)))) == told(b"".join(map(gzip.decompress, one))) == told(b"".join(one))
    clash = warc.responses(pages.withColumns({"headers": F.lit(1), "block": F.lit(2)}).withColumn("html", F.repeat("html", 500)))
    assert warc.derive(clash.withColumn("refers_to", F.lit(0))).where("length(block) > 50000").count() == 2
    written = warc.serialised(warc.derive(source), False).collect()
    assert all(b"WARC-Source-Block-Digest: " in bytes(r[0]) and b"WARC-Source-Headers: {" in bytes(r[0]) for r in written)
    assert list(warc.records(b"junk")) == [] and list(warc.records(b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort")) == []
