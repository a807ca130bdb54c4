"""Ranked lexical search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, prose, rows

from retalia.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def plain(docs, items, top=20):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text)
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("part_postings, block_bytes", [(lexical.PART_POSTINGS, lexical.BLOCK_BYTES), (50, 300)])
def test_ranks_equal_brute_force(spark, part_postings, block_bytes):
    azar = random.Random(1)
    texts = [" ".join("w%d" % int(azar.paretovariate(0.7)) for _ in range(azar.randrange(60))) for _ in range(300)]
    texts += [None, "", " .;", "ÉÀ w1", "éà w1", "W1-w1_W2\x00w3", prose(40_000, 2, 50)] + [texts[5]] * 60
    docs = rows(texts) + [(None, texts[5], *rows([""])[0][2:]), (2**63 - 1, "w1", *rows([""])[0][2:])]
    items = [(i, " ".join("w%d" % azar.randrange(1, 40) for _ in range(azar.randrange(1, 15)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "É w1 W1 w1"), (None, "w3 w5"), (104, texts[5]), (104, texts[5])]
    want = plain([(d[0], d[1]) for d in docs], list(dict.fromkeys(items)))
    df = spark.createDataFrame(docs, SCHEMA).repartition(7)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, query string")
    assert got(lexical.search_all(df, asked, 20, block_bytes, part_postings)) == want


def test_no_rows(spark, empty):
    asked = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search_all(empty, asked).collect() == []
    docs = spark.createDataFrame(rows(["one", "two"]), SCHEMA)
    assert lexical.search_all(docs, asked.limit(0)).collect() == []


def test_strata_are_left_out_by_their_bound():
    """Strata whose bound is below the bar are not scored."""
    n = 2000
    m = np.sort(np.random.default_rng(1).integers(75, 200, n))
    term = [np.array([0, 1]) if i < 30 else np.array([0]) for i in range(n)]
    strata = lexical._Strata(np.zeros(n, int), np.arange(n), m, term, [np.ones(len(t), int) for t in term], 2)
    scored = []
    strata.doc = Spy(strata.doc, scored)
    best = strata.search(np.array([0, 1]), np.array([3, 900]), np.empty((0, 3), np.int64), 20)
    assert len(best) == 20 and sum(scored) < n / 2


class Spy:
    def __init__(self, array, scored):
        self.array, self.scored = array, scored

    def __getitem__(self, at):
        self.scored.append(at.stop - at.start)
        return self.array[at]
