"""Language, quality, language-model scores, embeddings, top-k, and the pipeline on small data."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, brute_components, prose, rows
from pyspark.sql import functions as F

from retalia.llm import embeddings, language, lm, quality, topk
from retalia.llm.common import held_out

SYLLABLES = {"aa": "ba lo mi ten sar", "bb": "xy quo zet vrk olp", "cc": "ñu é ça dür ßo"}


def spoken(lang, n, seed):
    azar, s = random.Random(f"{lang}{seed}"), SYLLABLES[lang].split()
    return " ".join("".join(azar.choices(s, k=azar.randrange(1, 4))) for _ in range(n))


# -- language ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scorer(spark):
    langs = [["aa", "bb", "cc", None][i % 4] for i in range(240)]
    texts = [spoken(x or "aa", 60, i) for i, x in enumerate(langs)]
    return language.fit(spark.createDataFrame(rows(texts, lang=langs.__getitem__), SCHEMA))


def test_languages_are_told_apart(spark, scorer):
    langs = [["aa", "bb", "cc"][i % 3] for i in range(60)]
    docs = spark.createDataFrame(rows([spoken(x, 200, 1000 + i) for i, x in enumerate(langs)]), SCHEMA)
    found = {r.doc_id: r for r in language.identify(docs, scorer).collect()}
    assert sum(found[i].lang_pred == x for i, x in enumerate(langs)) >= 58
    assert all(0 <= float(r.score) <= 1 for r in found.values())


def test_tables_give_what_the_network_gives():
    net = language.Network(["a", "b"], seed=3)
    x = language.windows(spoken("aa", 200, 1))[:3]
    inputs = net.w["vector"][x]
    hidden = []
    for w in language.WIDTHS:
        spans = x.shape[1] - w + 1
        cols = np.concatenate([inputs[:, j : j + spans] for j in range(w)], axis=2)
        hidden.append((cols @ net.w[f"filter{w}"] + net.w[f"shift{w}"]).max(axis=1))
    z = np.maximum(np.concatenate(hidden, axis=1), 0) @ net.w["out"] + net.w["bias"]
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(net.compiled().probabilities(x), p, atol=1e-4)


def test_gradients_are_those_of_the_loss():
    net = language.Network(["a", "b", "c"], seed=5)
    x, y = language.windows(spoken("bb", 300, 2))[:4], np.array([0, 1, 2, 1])
    g = net._gradients(x, y)

    def loss():
        hidden = []
        inputs = net.w["vector"][x]
        for w in language.WIDTHS:
            spans = x.shape[1] - w + 1
            cols = np.concatenate([inputs[:, j : j + spans] for j in range(w)], axis=2)
            hidden.append((cols @ net.w[f"filter{w}"] + net.w[f"shift{w}"]).max(axis=1))
        z = np.maximum(np.concatenate(hidden, axis=1), 0) @ net.w["out"] + net.w["bias"]
        return -np.mean((z - np.log(np.exp(z).sum(axis=1, keepdims=True)))[np.arange(4), y]) + 5e-5 * np.square(net.w["out"]).sum()

    for key, at in [("out", (3, 1)), ("filter3", (4, 2)), ("vector", (5, 3)), ("shift2", (6,))]:
        before = net.w[key][at]
        net.w[key][at] = before + 1e-6
        up = loss()
        net.w[key][at] = before - 1e-6
        down = loss()
        net.w[key][at] = before
        assert g[key][at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7)


def test_language_of_odd_rows(spark, odd, empty, scorer):
    out = language.identify(odd, scorer)
    assert out.count() == odd.count() and set(out.columns) == {*odd.columns, "lang_pred"}
    assert {r.lang_pred for r in out.filter("text IS NULL OR trim(text) = ''").collect()} == {"und"}
    assert language.identify(empty, scorer).count() == 0
    assert language.fit(empty).predict("some text") == ("und", 0.0)


# -- quality -----------------------------------------------------------------------------


def labelled(n):
    texts = [prose(80, i) + "." if i % 3 else " ".join(w.upper() + "!!" for w in prose(60, i).split()) for i in range(n)]
    return texts, [int(i % 3 > 0) for i in range(n)]


def test_quality_on_held_out_rows(spark):
    texts, y = labelled(200)
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    labels = spark.createDataFrame([*enumerate(y), (None, 1), (5, None), (7, 9)], "doc_id long, quality int")
    train = quality.training_rows(docs, labels)
    model = quality.fit(train)
    x = np.array([quality.features(t) for t in texts])
    out = quality.score_documents(docs, model).filter(held_out(F.col("doc_id"))).collect()
    assert len(out) > 20 and all(r.predicted == y[r.doc_id] for r in out)
    # The sums taken by Spark give the model of all training rows at once.
    rows_ = train.collect()
    a, b = np.array([r.x for r in rows_]), np.array([r.y for r in rows_])
    assert np.allclose(model.means, [a[b == c].mean(axis=0) for c in (0, 1)])
    pooled = sum((b == c).sum() * np.cov(a[b == c].T, bias=True) for c in (0, 1)) / len(b)
    pooled = 0.98 * pooled + 0.02 * np.diag(np.maximum(np.diag(pooled), 1e-6))
    logs = []
    for c in (0, 1):
        s = 0.5 * np.cov(a[b == c].T, bias=True) + 0.5 * pooled
        d = x - a[b == c].mean(axis=0)
        logs.append(np.log((b == c).mean()) - 0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))), atol=1e-6)


def test_quality_of_odd_rows(spark, odd, empty):
    texts, y = labelled(60)
    model = quality.fit(quality.training_rows(spark.createDataFrame(rows(texts), SCHEMA), spark.createDataFrame([*enumerate(y)], "doc_id long, quality int")))
    out = quality.score_documents(odd, model)
    assert out.count() == odd.count() and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.score_documents(empty, model).count() == 0
    none = quality.fit(quality.training_rows(empty, spark.createDataFrame([], "doc_id long, quality int")))
    assert {r.score for r in quality.score_documents(odd, none).collect()} == {0.5}


# -- language-model scores ---------------------------------------------------------------


def slow_losses(texts, target, halves, doc):
    """Mean loss of one document in both models, by counting everything again."""
    split = lambda t: (t or "").lower().split()
    vocab = {w for t in texts.values() for w in split(t)}
    out = []
    for docs in ([i for i in target if halves[i] != halves[doc]], [i for i in texts if i != doc]):
        word, pair = Counter(), Counter()
        for i in docs:
            w = split(texts[i])
            word.update(w)
            pair.update(zip([None, *w], w))
        total, own = word.total(), split(texts[doc])
        losses = []
        for v, w in zip([None, *own], own):
            p = (word[w] + lm.SMOOTH) / (total + lm.SMOOTH * (len(vocab) + 1))
            before = word[v] if v is not None else len(docs)
            losses.append(-np.log((pair[v, w] + lm.BACKOFF * p) / (before + lm.BACKOFF)))
        out.append(np.mean(losses) if losses else 0.0)
    return out


@pytest.mark.parametrize("part_chars, shard_entries, few", [(lm.PART_CHARS, lm.SHARD_ENTRIES, lm.FEW), (400, 60, 0)])
def test_losses_equal_brute_force(spark, monkeypatch, part_chars, shard_entries, few):
    for name, value in (("PART_CHARS", part_chars), ("SHARD_ENTRIES", shard_entries), ("FEW", few)):
        monkeypatch.setattr(lm, name, value)
    texts = {i: prose(30, i, 40) for i in range(24)} | {i: prose(30, i, 15).upper() + " rare%d" % i for i in range(24, 40)}
    texts |= {40: texts[3], 41: "one", 42: "one", 43: None, 44: " ", 45: "w1 " * 200 + "é ü"}
    docs = spark.createDataFrame(rows(list(texts.values())), SCHEMA).select("doc_id", "text").repartition(3)
    target = list(range(24, 40))
    good = spark.createDataFrame([(i,) for i in [*target, None, 999, 30]], "doc_id long")
    found = {r.doc_id: r for r in lm.score(docs, good).collect()}
    halves = {r.doc_id: r.h for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("h")).collect()}
    for i in texts:
        a, b = slow_losses(texts, target, halves, i)
        assert (found[i].loss_target, found[i].loss_background) == pytest.approx((a, b), rel=1e-9), i
        assert found[i].n_tokens == len((texts[i] or "").split()) and found[i].score == pytest.approx(b - a, abs=1e-9)
    assert np.mean([found[i].score for i in target]) > np.mean([found[i].score for i in range(24)])


def test_documents_that_occur_twice_stand_apart(spark):
    """Long prose of a large vocabulary: only the copy tells the background of it."""
    texts = [prose(120, i, 20_000) for i in range(60)]
    texts += texts[:6]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    good = docs.filter("doc_id % 3 = 1").select("doc_id")
    found = {r.doc_id: r.score for r in lm.score(docs, good).collect()}
    twice = [*range(6), *range(60, 66)]
    assert max(found[i] for i in twice) < min(found[i] for i in found if i not in twice)


def test_lm_of_odd_rows(spark, odd, empty):
    good = odd.filter("doc_id IN (5, 6)").select("doc_id")
    out = lm.score(odd, good)
    assert out.count() == odd.count() and out.filter("score IS NULL OR isnan(score)").count() == 0
    assert {(r.n_tokens, r.score) for r in out.filter("n_tokens = 0").collect()} == {(0, 0.0)}
    assert lm.score(empty, good).count() == 0
    assert {r.score for r in lm.score(odd, good.filter("false")).collect()} == {0.0}


# -- embeddings and search ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id long, v string, node string"


def vectors(spark, xs):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 1, 0, "", "") for i, x in xs], VECTORS)


@pytest.fixture(scope="module")
def cloud():
    azar = np.random.default_rng(8)
    centres = azar.normal(size=(12, 16))
    x = np.concatenate([centres[azar.integers(0, 12, 150)] + azar.normal(size=(150, 16)) * azar.choice([0.1, 0.35], (150, 1)), azar.normal(size=(60, 16))])
    x[20:40] = x[19]
    return x.astype(np.float32)


BAD = [(900, None), (901, []), (902, [0.0] * 16), (903, [0.0] * 16), (904, [float("nan")] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [float("inf")] + [1.0] * 15)]


@pytest.mark.parametrize("tile", [16, 2048])
def test_embedding_links_equal_all_pairs(spark, cloud, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    df = vectors(spark, [*enumerate(cloud), *BAD, (907, [1.0, 2.0]), (908, [2.0, 4.0])])
    out = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    u = cloud.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = [(int(i), int(j)) for i, j in zip(*np.nonzero(u @ u.T >= 0.9)) if i != j] + [(907, 908), (908, 907)]
    nodes = [*range(len(cloud)), *[i for i, _ in BAD], 907, 908]
    want = brute_components(nodes, near)
    assert {i: r.component_id for i, r in out.items()} == want
    degree = {i: sum(a == i for a, _ in near) for i in nodes}
    assert {i: r.n_links for i, r in out.items()} == degree
    assert all(r.kept == (i == r.component_id) for i, r in out.items())


def test_embeddings_of_odd_rows(spark):
    twice = vectors(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)])
    out = sorted(((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(twice).collect()), key=str)
    assert out == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 0, None)], key=str)
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("block", [20, 1024])
def test_top_k_equals_all_scores(spark, cloud, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "CHUNK", 4)
    df = vectors(spark, [*enumerate(cloud), *BAD, (950, [3.0, 1.0]), (951, [2.0, 2.0])])
    got = topk.top_k(df, df.filter("vec_id % 10 = 0"), k=5).collect()
    x = np.floor(256 * cloud.astype(float)).astype(int)
    want = set()
    plain = {i: v for i, v in enumerate(x)} | {902: np.zeros(16, int), 903: np.zeros(16, int)}
    for q in [i for i in plain if i % 10 == 0]:
        best = sorted((-int(plain[q] @ v), i) for i, v in plain.items() if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    want.add((950, 1, 951, 256 * 256 * 8))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_of_odd_rows(spark):
    df = vectors(spark, [(50, [1.0]), (50, [1.0]), (None, [1.0]), (2, [1.0]), (2, [1.0]), (1, [1.0])])
    got = sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id = 50")).collect())
    assert got == [(50, 1, 1, 65536), (50, 2, 2, 65536), (50, 3, 2, 65536)]
    none = vectors(spark, [])
    assert topk.top_k(none, none).count() == 0


# -- pipeline ----------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    texts, y = labelled(90)
    texts += [texts[1], texts[2] + " more", None, "", prose(3000, 77)]
    docs = spark.createDataFrame(rows(texts), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(y)), "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in out}
    assert not kept & {i for i in range(90) if not y[i]}
    assert not {90, 91} & kept
    assert len([n for n, _ in corpus_pipeline.STAGES]) == 5
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d.limit(0), str(tmp_path)).columns == d.columns, name
    assert corpus_pipeline.packing_stage(spark, d.limit(0), str(tmp_path)).count() == 0
