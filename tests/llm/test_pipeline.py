"""The pipeline on a small table: each stage against a brute-force version of its decision."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from skyshuffle.llm import quality
from tests.llm import test_small_cases as small


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    rng = random.Random(1)
    extra = [(5000, None), (5001, ""), (None, "x y"), (5002, small._text(rng, 200)), (5003, None)]
    extra += [(5004, extra[3][1]), (5005, small._text(rng, 100)), (5005, small._text(rng, 90)), (None, small._text(rng, 80)), (5006, "x " * 30000)]
    extra += [(None, extra[-2][1]), extra[-1]]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in extra], docs.schema))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = small._pairs(docs)
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == columns
            kept[name] = sorted(small._pairs(out), key=repr)
        if name == "quality":
            model = quality.train_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            good = quality.score_quality(docs, model).where("predicted = 1").select("doc_id").collect()
            assert sorted(map(repr, (r["doc_id"] for r in good))) == sorted(repr(i) for i, _ in kept[name]) and set(kept[name]) <= set(before)
        elif name == "near_duplicate":
            assert kept[name] == _firsts(before)
        elif name == "substring_dedup":
            changed = [(i, text if n else None) for i, _, n, _, text in small._removed(before)]
            assert sorted(i for i, _ in before if i) == sorted(i for i, _ in kept[name] if i)
            assert {x for x in changed if x[1] is not None} <= set(kept[name])
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = [p for p in before if not small._contamination([p], items)[0][-1]]
            assert kept[name] == sorted(want, key=repr)
        else:
            assert out.count() == len(before) and out.where("taken > 2 * size").count() == 0
        docs = out


def _firsts(rows):
    """One row of each component of rows that link: the first by a doc_id of its own, else by doc_id, null last, and text."""
    ids = [i for i, _ in rows]
    order = sorted(rows, key=lambda r: (ids.count(r[0]) > 1 or r[0] is None, r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    found = {k: c for k, _, c in small._components([(k, t) for k, (_, t) in enumerate(order)])}
    return sorted((r for k, r in enumerate(order) if found[k] == k), key=repr)


def test_rows_of_one_id_are_judged_one_by_one(spark):
    """Unlike texts of one doc_id, and rows without one, go on; copies of them do not; clashing columns are kept."""
    rng = random.Random(9)
    a, b, c = (small._text(rng, 60) for _ in range(3))
    rows = [(7, a), (7, b), (7, b), (None, c), (None, c), (None, None), (8, a), (9, ""), (10, c)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, row_key string")
    out = corpus_pipeline.near_duplicate(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns and sorted(map(repr, small._pairs(out))) == sorted(map(repr, [(8, a), (7, b), (10, c), (None, None), (9, "")]))
    dirty = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").where("length(text) > 100").first()["text"]
    docs = docs.unionByName(spark.createDataFrame([(7, dirty, "k"), (None, dirty, "k")], docs.schema))
    out = corpus_pipeline.decontamination(spark, docs, "/root/testdata/sf0.001")
    assert sorted(map(repr, small._pairs(out))) == sorted(map(repr, rows))


def test_run_keeps_going_on_repeated_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    out = corpus_pipeline.near_duplicate(spark, docs.unionByName(docs), sf)
    assert out.groupBy("doc_id").count().where("count > 1").count() == 0
    assert corpus_pipeline.near_duplicate(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.run(spark, sf).agg(F.sum("taken")).first()[0] > 0
