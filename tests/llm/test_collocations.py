"""Counting quotient filters and phrase collocations against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, prose, rows

from retalia.llm import collocations, quotient
from retalia.llm.quotient import Code


@pytest.mark.parametrize("words, bits", [(1, 1), (2, 1), (5, 1), (2, 7), (3, 21), (4, 17), (5, 12), (5, 13), (5, 32), (2, 32)])
def test_codes_are_one_to_one(words, bits):
    azar = np.random.default_rng(bits)
    code = Code(words, bits)
    ids = [azar.integers(0, 1 << bits, 500).astype(np.uint64) for _ in range(words)]
    limbs = code.pack(ids)
    assert len(limbs) == code.limbs and all((x >> np.uint64(code.width) == 0).all() or code.width == 64 for x in limbs)
    assert [x.tolist() for x in code.unpack(limbs)] == [x.tolist() for x in ids]
    assert len(set(zip(*map(np.ndarray.tolist, limbs)))) == len(set(zip(*map(np.ndarray.tolist, ids))))


@pytest.mark.parametrize("words, bits", [(2, 3), (3, 20), (5, 13), (5, 25), (4, 16)])
@pytest.mark.parametrize("skip", [0, 3])
def test_filters_hold_what_was_counted(words, bits, skip):
    azar = random.Random(words)
    code = Code(words, bits)
    grams = [tuple(azar.randrange(1, min(1 << bits, 9)) for _ in range(words)) for _ in range(900)]
    merged = []
    for part in (grams[:400], grams[400:]):
        ids = [np.array(x, np.int64) for x in zip(*part)]
        limbs, counts = quotient.combine(code.pack(ids), np.ones(len(part), np.int64))
        counts = np.where(counts == counts.max(), 10**12, counts)
        shard = (limbs[0] >> np.uint64(code.width - skip)).astype(int) if skip else np.zeros(len(counts), int)
        for s in np.unique(shard):
            own = shard == s
            filter_ = quotient.write(code, [x[own] for x in limbs], counts[own], skip)
            back = quotient.read(code, int(s), skip, *filter_)
            assert [x.tolist() for x in back[0]] == [x[own].tolist() for x in limbs] and back[1].tolist() == counts[own].tolist()
        merged.append((limbs, quotient.combine(code.pack(ids), np.ones(len(part), np.int64))[1]))
    limbs, counts = quotient.merge(merged)
    assert dict(zip(zip(*[x.astype(int).tolist() for x in code.unpack(limbs)]), counts.tolist())) == Counter(grams)


def plain(docs, min_count, top, longest=5):
    f = {}
    for lang, text in docs:
        own = f.setdefault(lang or "und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        cand = {p: c for p, c in own.items() if len(p) > 1 and c >= min_count}
        found = []
        for p, a in cand.items():
            if any(b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), (a, own[p[:k]], own[p[k:]], n, score)))
        out += [(lang, i + 1, p.decode(), *rest) for i, (_, _, p, rest) in enumerate(sorted(found)[:top])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize(
    "min_count, top, part_words, id_bits", [(3, 2000, 250_000, None), (3, 40, 7, 13), (2, 2000, 250_000, 32), (10**9, 5, 9, None)]
)
def test_phrases_equal_brute_force(spark, monkeypatch, min_count, top, part_words, id_bits):
    for name, small in (("SLICE", 97), ("ENTRIES", 150), ("SHARD_ENTRIES", 100), ("COUNTED_WORDS", 40), ("MAP_BITS", 9)):
        monkeypatch.setattr(collocations, name, small)
    azar = random.Random(4)
    stock = ["New York city hall", "a  b\ta b a b", "Éte éte x", "to be or not to be", "w\x00x \x1fq z", "one two three four five six"]
    texts = [None, "", " . ,", prose(5000, 1, 30)] + ["".join(azar.choice([*stock, *" .\n;\t", " end", "z"]) for _ in range(azar.randrange(25))) for _ in range(120)]
    texts += [stock[0]] * 40
    docs = rows(texts, lang=lambda i: [None, "en", "en", "fr", "", "und"][i % 6])
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    want = plain([(d[2], d[1]) for d in docs], min_count, top)
    assert got(collocations.collocations(df, min_count=min_count, top=top, part_words=part_words, id_bits=id_bits)) == want
    assert bool(want) == (min_count < 10**9)


def test_products_beyond_64_bits(spark):
    rows_ = [([1, 2], 10**13, "en", 9 * 10**15)]
    frequent = spark.createDataFrame([([1], 3 * 10**15), ([2], 10**13 + 7)], "ids array<int>, f long")
    r = collocations.scored(spark.createDataFrame(rows_, "ids array<int>, a long, lang string, n long"), frequent).first()
    assert r.score == 1000 * 10**13 * 9 * 10**15 // (3 * 10**15 * (10**13 + 7))


def test_no_rows(spark, empty):
    assert collocations.collocations(empty).collect() == []


def test_whole_texts_go_to_python_by_bytes(spark):
    """Rows of 4 kB: ten thousand of them in one batch took executors beyond their memory."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    collocations.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string"))
    texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('ab ', 1400) AS text")

    def sizes(batches):
        for pdf in batches:
            yield pdf.iloc[:1, :0].assign(n=int(pdf["text"].str.len().sum()))

    n = [r.n for r in texts.mapInPandas(sizes, "n long").collect()]
    assert sum(n) == 4000 * 4200 and max(n) <= 4 << 20
