"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser m form a stratum.  Inside a stratum the postings of a
term are ordered by tf, so an impact, ``(10^9 tf) div (1000 tf + 12 m)``, is computed once for
each tf and not for each posting.  The largest tf of every term bounds what a stratum can add
to a query; strata are visited by falling bound, and the search of a part ends when the bound
falls below the score of the last rank.

Spark counts the terms of whole texts, deals the documents to parts by ranges of m (a stratum
of many documents is cut by document id), lets each part answer all queries of a block, and
merges the parts' ranks.  A task reads its part in stretches of about ``PART_POSTINGS`` postings,
each an index of its strata; what a query has found so far sets the bar for the next stretch.
Queries are taken in blocks of about ``BLOCK_BYTES``; only the terms of a block are indexed for it.

Edge cases: null and empty texts, and texts without a term, are no documents of the index;
rows that repeat are documents of their own; equal scores go by document id, null ids last; a
query without a term, or whose terms no document holds, has no ranks; items that agree in id and
text are one query; a null item id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import stored, table

TOP = 20
PART_POSTINGS = 4_000_000
BLOCK_BYTES = 1 << 20  # text of the queries of one block

# Fixed values of the score.
B_OF_100, SCALE, K_OF_1000 = 25, 1_000_000_000, 12

# Term characters are digits, letters and all above 7F; other bytes separate, A-Z are lowered.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + K_OF_1000 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Queries:
    """A block of queries: the terms they use, and for each query its term numbers with repeats."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, np.ndarray, np.ndarray]]  # item id, term numbers, how often


def queries_of(rows: list) -> Queries:
    vocabulary: dict[bytes, int] = {}
    items = []
    for item, text in rows:
        counts = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms(text))
        items.append((item, np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))))
    return Queries(vocabulary, items)


def term_counts(docs: DataFrame, queries: Queries, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n`` (all terms of the text), ``term`` and ``tf`` (arrays, of the queries' terms only)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)  # bounded by a block's bytes

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = vocabulary.value.get
        for pdf in batches:
            out = []
            for doc, text in pdf.itertuples(index=False):
                words = terms(text)
                own = np.fromiter((k for k in map(get, words) if k is not None), np.int32)
                which, tf = np.unique(own, return_counts=True)
                if words:
                    out.append((doc, len(words), which.astype(np.int32), tf.astype(np.int32)))
            yield pd.DataFrame(out, columns=["id", "n", "term", "tf"])

    # The id goes as a string: pandas would turn longs beside a null into doubles.
    read = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return read.mapInPandas(count, "id string, n long, term array<int>, tf array<int>").withColumn("id", F.col("id").cast("long"))


class _Strata:
    """Index of a stretch of documents in rising m."""

    def __init__(self, null: np.ndarray, ids: np.ndarray, m: np.ndarray, term: list, tf: list, n_terms: int):
        self.null, self.ids, self.n_terms = null, ids, n_terms
        self.m, first = np.unique(m, return_index=True)
        self.rows = np.r_[first, len(m)]
        stratum = np.repeat(np.arange(len(self.m)), np.diff(self.rows))
        doc = np.repeat(np.arange(len(m)), np.fromiter(map(len, term), np.int64, len(term)))
        slot = stratum[doc] * n_terms + np.concatenate(term)  # (stratum, term)
        tf = np.concatenate(tf).astype(np.int64)
        order = np.lexsort((tf, slot))
        slot, tf, self.doc = slot[order], tf[order], doc[order]
        self.slots, first = np.unique(slot, return_index=True)
        self.start = np.r_[first, len(slot)]
        # One impact for each run of equal tf of a term in a stratum.
        runs = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (tf[1:] != tf[:-1])])
        of_run = impact(tf[runs], self.m[slot[runs] // n_terms])
        self.impact = np.repeat(of_run, np.diff(np.r_[runs, len(tf)]))
        self.most = self.impact[self.start[1:] - 1]  # impacts rise with tf: the last posting bounds a term

    def search(self, which: np.ndarray, weights: np.ndarray, best: np.ndarray, top: int) -> np.ndarray:
        """``best`` (score, null id, id) of a query, with what these strata add to it."""
        slots = np.arange(len(self.m))[:, None] * self.n_terms + which
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        held = self.slots[at] == slots
        bounds = np.where(held, self.most[at], 0) @ weights
        for s in np.argsort(-bounds, kind="stable"):
            least = best[-1, 0] if len(best) == top else 1
            if bounds[s] < least:
                break
            lo = self.rows[s]
            total = np.zeros(self.rows[s + 1] - lo, np.int64)
            for t, w in zip(at[s][held[s]], weights[held[s]]):
                a, b = self.start[t], self.start[t + 1]
                total[self.doc[a:b] - lo] += w * self.impact[a:b]  # a document stands once among a term's postings
            own = np.flatnonzero(total >= least)
            if len(own) > top:
                own = own[total[own] >= -np.partition(-total[own], top - 1)[top - 1]]
            best = np.r_[best, np.c_[total[own], self.null[lo + own], self.ids[lo + own]]]
            best = best[np.lexsort((best[:, 2], best[:, 1], -best[:, 0]))[:top]]
        return best


def _answer(
    batches: Iterator[pd.DataFrame], queries: Queries, weights: np.ndarray, top: int, part_postings: int
) -> Iterator[pd.DataFrame]:
    """Best documents of a part for each query."""
    best = [np.empty((0, 3), np.int64) for _ in queries.items]
    waiting, postings = [], 0

    def take() -> None:
        pdf = pd.concat(waiting)
        strata = _Strata(
            pdf["no_id"].to_numpy(np.int64),
            pdf["id"].to_numpy(np.int64),
            pdf["m"].to_numpy(np.int64),
            pdf["term"].tolist(),
            pdf["tf"].tolist(),
            len(weights),
        )
        for q, (_, which, often) in enumerate(queries.items):
            best[q] = strata.search(which, often * weights[which], best[q], top)

    for pdf in batches:
        if len(pdf):
            waiting.append(pdf)
            postings += int(pdf["term"].map(len).sum())
        if postings > part_postings:
            take()
            waiting, postings = [], 0
    if waiting:
        take()
    for q, (item, *_) in enumerate(queries.items):
        if len(best[q]):
            score, null, ids = best[q].T
            names = pd.Series(ids).astype(object).where(null == 0, None)
            item_id = None if item is None else str(item)
            yield pd.DataFrame({"query": q, "item_id": item_id, "doc_id": names.map(str, na_action="ignore"), "score": score})


def search(
    docs: DataFrame,
    queries: Queries,
    top: int = TOP,
    part_postings: int = PART_POSTINGS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the best documents of each query of a block."""
    sc = docs.sparkSession.sparkContext
    counts = stored(term_counts(docs, queries, id_col, text_col), "lexical-counts")
    n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counts.select(F.explode("term").alias("term")).groupBy("term").count()
    weights = np.zeros(len(queries.vocabulary), np.int64)
    for term, held in df.collect():  # at most the terms of a block
        weights[term] = weight(n_docs, held)
    m = F.expr(f"100 - {B_OF_100} + ({B_OF_100} * n * {n_docs}L) div {max(1, n_terms)}L")
    rows = counts.filter(F.size("term") > 0).select(
        F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), m.alias("m"), "term", "tf"
    )
    parts = rows.repartitionByRange("m", "no_id", "id").sortWithinPartitions("m")
    shared = sc.broadcast((queries, weights))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _answer(batches, *shared.value, top, part_postings)

    found = parts.mapInPandas(answer, "query int, item_id string, doc_id string, score long")
    found = found.withColumns({c: F.col(c).cast("long") for c in ("item_id", "doc_id")})
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search_all(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    part_postings: int = PART_POSTINGS,
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Ranks for every row of ``items``, block by block."""
    items = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("said")).distinct()
    length = items.agg(F.sum(F.octet_length("said"))).first()[0] or 0
    blocks = max(1, -(-length // block_bytes))
    own = F.pmod(F.xxhash64("item", "said"), F.lit(blocks))
    found = []
    for block in range(blocks):
        ranks = search(docs, queries_of(items.filter(own == block).collect()), top, part_postings)
        found.append(ranks if blocks == 1 else stored(ranks, "lexical-ranks"))
    return reduce(DataFrame.unionByName, found)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_all(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )


_TERMS = r"""unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

LEXICAL_SQL = f"""
WITH words AS (
    SELECT rid, doc_id, {_TERMS} FROM (SELECT *, row_number() OVER () AS rid FROM documents)
), sizes AS (
    SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY rid
), totals AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), postings AS (
    SELECT rid, term, count(*) AS tf FROM words GROUP BY rid, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term
), asked AS (
    SELECT item_id, term, count(*) AS often FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY item_id, term
), scored AS (
    SELECT item_id, rid, any_value(doc_id) AS doc_id,
        sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (rid), totals
    GROUP BY item_id, rid
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
