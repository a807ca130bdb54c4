"""Ids at the ends of the longs, components beyond any long, number-like letters."""

import random

import numpy as np
import pytest
from llm_data import SCHEMA, prose, rows

from retalia.llm import embeddings, language, sharding, simhash, substrings, topk

ENDS = [-(2**63), 2**63 - 1, 0, -1]


def test_number_signs_are_no_letters():
    assert not any(map(language.has_letter, ["", "\u00b2", "\u00bd", "\u2460 \u2167", "12_3 !", "\u0663"]))
    assert all(map(language.has_letter, ["1a", "\u00aa", "\u02b0", "\u6f22", "\u2167 \u00e9", "\u01c5"]))


@pytest.mark.parametrize("copies", [False, True])
def test_shards_of_any_ids(spark, copies):
    azar = random.Random(7)
    ids = [*ENDS, *(azar.randrange(-(2**63), 2**63) for _ in range(400)), None]
    text = lambda i: "same text" if copies else prose(5, i)
    docs = spark.createDataFrame([(d, text(i), *rows([""])[0][2:]) for i, d in enumerate(ids)], SCHEMA).repartition(3)
    out = sharding.shard_documents(docs, 8).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((i is None, i or 0) for i in ids)
    sums = {}
    for r in out:
        sums.setdefault(r.shard, []).append((r.slot, r["size"]))
    assert set(sums) == set(range(8)) or copies
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in sums.values())
    total = [sum(n for _, n in v) for v in sums.values()]
    assert max(total) - min(total) <= 4 * max(n for v in sums.values() for _, n in v)


def test_near_duplicates_with_the_largest_id(spark):
    a, b = prose(60, 1), prose(60, 2)
    docs = [(2**63 - 1, a), (None, a), (-(2**63), b), (2**63 - 1, b), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(i, t, *rows([""])[0][2:]) for i, t in docs], SCHEMA)
    found = sorted(((r.id, r.first_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    want = [(2**63 - 1, 2**63 - 1), (None, 2**63 - 1), (-(2**63), -(2**63)), (2**63 - 1, -(2**63)), (None, None), (None, None)]
    assert found == sorted(want, key=str)
    kept = simhash.keep_first(docs, 4, 1, 4).collect()
    assert sorted([(r.doc_id, r.text) for r in kept], key=str) == sorted([(2**63 - 1, a), (-(2**63), b), (None, "alone")], key=str)


def test_passages_with_the_largest_id(spark):
    a = prose(60, 3, 5000)
    docs = spark.createDataFrame([(i, a, *rows([""])[0][2:]) for i in (2**63 - 1, -(2**63), None)], SCHEMA)
    found = {(r.doc_id, r.ref_id) for r in substrings.find_passages(docs).collect()}
    assert found == {(2**63 - 1, -(2**63)), (None, -(2**63))}
    assert [r.doc_id for r in substrings.remove_passages(docs).collect()] == [-(2**63)]


def vectors(spark, items):
    return spark.createDataFrame(items, "vec_id long, embedding array<double>")


def test_vectors_with_the_largest_id(spark):
    df = vectors(spark, [(2**63 - 1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (5, [-1.0, 0.0])])
    got = sorted([tuple(r) for r in embeddings.near_duplicates(df).collect()], key=str)
    want = [(2**63 - 1, 1, 2**63 - 1, True), (None, 1, 2**63 - 1, False), (None, 0, None, True), (5, 0, 5, True)]
    assert got == sorted(want, key=str)


def test_scores_beyond_doubles(spark):
    big = 2.0**44
    items = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [-big, 1.0]), (3, [1e30, 1.0]), (4, [1.0 / 512, -1.0 / 512])]
    items = [(i, [x / 2**24, y]) if i < 3 else (i, [x, y]) for i, (x, y) in items]
    df = vectors(spark, items[:3] + items[4:])
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, df).collect()}
    q = {i: [int(np.floor(256 * x)) for x in v] for i, v in items}
    assert got == {(i, j): q[i][0] * q[j][0] + q[i][1] * q[j][1] for i in (0, 1, 2, 4) for j in (0, 1, 2, 4) if i != j}
    assert max(got.values()) > 2**53
    with pytest.raises(Exception, match="too large"):
        topk.top_k(vectors(spark, items), vectors(spark, items)).collect()


def test_passages_and_stages_read_texts_by_bytes(spark, tmp_path):
    import corpus_pipeline

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(1, "a b c", 5)], "doc_id long, text string, n_chars long")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for work in (substrings.remove_passages, lambda d: corpus_pipeline.quality_stage(spark, d, str(tmp_path))):
        spark.conf.unset(limit)
        work(docs)
        assert int(spark.conf.get(limit).removesuffix("b")) <= 4 << 20
