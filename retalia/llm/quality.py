"""Document quality by regularised quadratic discriminant analysis.

A text becomes a short vector of statistics (sizes, shares of character kinds, repetition,
word shapes), each brought near a bell shape by a logarithm or a logit.  Mean and covariance
of each class are sums over all labelled training rows, taken by Spark.  A class covariance
is shrunk towards the pooled one and that one towards its diagonal, so that it can always be
inverted; its Cholesky factor is computed once.  The score is the logistic function of the
difference of the two Mahalanobis log densities and the log prior odds.

Features are computed where the text is; nothing but the sums (one row of numbers a class)
reaches the driver.

Edge cases: a null text is an empty one and is scored like any other; null labels and ids
don't train; a label other than 0 or 1 doesn't train; without rows of both classes the score
is the share of class 1 (0.5 without any labels); an empty table gives no rows; other
columns pass through, and columns named ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.llm.common import held_out, stored, table

#: The features, in order.
FEATURES = (
    "log_words", "log_word_size", "upper", "digits", "punctuation", "symbols", "blanks", "wide",
    "log_line_words", "odd_words", "mixed_words", "alpha_words", "distinct_words", "distinct_pairs",
    "copied_lines", "top_word", "sentence_ends", "log_longest_word",
)
ACCEPT = 0.7

_KIND = np.zeros(256, np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 6
_KIND[128:] = 7
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def _logit(share: float, n: float) -> float:
    """Logit of a share, held off 0 and 1 by half a count in n."""
    p = (share * n + 0.5) / (n + 1.0)
    return float(np.log(p / (1.0 - p)))


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    kind = _KIND[np.frombuffer(raw, np.uint8)]
    kinds = np.bincount(kind, minlength=8)
    size = max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts = Counter(words)
    pairs = len(set(pairwise(words)))
    blank = np.r_[True, kind == 6, True]
    starts, ends = np.flatnonzero(blank[:-2] & ~blank[1:-1]), np.flatnonzero(~blank[1:-1] & blank[2:])
    word = np.cumsum(blank[:-2] & ~blank[1:-1]) - 1  # of each byte

    def having(where: np.ndarray) -> int:
        """Words with such a byte."""
        found = np.zeros(n, bool)
        found[word[where]] = True
        return int(found.sum())

    inner_upper = kind == 2
    inner_upper[starts] = False
    mixed = having(inner_upper)
    alpha = len(words) - having((kind == 0) | (kind == 3) | (kind == 5))
    odd = int(((kind[starts] == 5) | (kind[ends] == 5)).sum())
    stops = int(_STOP[np.frombuffer(raw, np.uint8)[ends]].sum())
    return np.array(
        [
            np.log1p(len(words)),
            np.log(size / n),
            _logit(kinds[2] / size, size),
            _logit(kinds[3] / size, size),
            _logit(kinds[4] / size, size),
            _logit(kinds[5] / size, size),
            _logit(kinds[6] / size, size),
            _logit(kinds[7] / size, size),
            np.log1p(len(words) / max(1, len(lines))),
            _logit(odd / n, n),
            _logit(mixed / n, n),
            _logit(alpha / n, n),
            _logit(len(counts) / n, n),
            _logit(pairs / n, n),
            _logit(1.0 - len(set(lines)) / max(1, len(lines)), max(1, len(lines))),
            _logit(max(counts.values(), default=0) / n, n),
            _logit(stops / n, n),
            np.log1p(max(map(len, words), default=0)),
        ]
    )


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    return udf(text)


@dataclass(frozen=True)
class Discriminant:
    """Means and inverse Cholesky factors of the classes 0 and 1, and the log odds between."""

    prior: float
    offset: float = 0.0
    means: np.ndarray | None = None
    whiten: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        far = [np.square((x - m) @ w.T).sum(axis=1) for m, w in zip(self.means, self.whiten)]
        z = self.offset + 0.5 * (far[0] - far[1])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def fit(labelled: DataFrame, shrink: float = 0.5, ridge: float = 0.02) -> Discriminant:
    """``labelled``: ``x`` (array of features) and ``y`` (0 or 1).

    Sums of x and of its products are taken by Spark for every class.
    """
    d = len(FEATURES)
    i, j = np.triu_indices(d)
    names = [f"s{k}" for k in range(d)] + [f"p{k}" for k in range(len(i))]

    def sums(batches):
        total = {0: np.zeros(1 + d + len(i)), 1: np.zeros(1 + d + len(i))}
        for pdf in batches:
            x, y = np.array(pdf["x"].tolist()).reshape(-1, d), pdf["y"].to_numpy()
            for c in total:
                own = x[y == c]
                total[c] += np.r_[len(own), own.sum(axis=0), (own.T @ own)[i, j]]
        yield pd.DataFrame([[c, *v] for c, v in total.items()], columns=["y", "n", *names])

    schema = "y int, n double, " + ", ".join(f"{c} double" for c in names)
    by_class = labelled.mapInPandas(sums, schema).groupBy("y").agg(*[F.sum(c).alias(c) for c in ["n", *names]]).collect()
    got = {r["y"]: np.array(r[1:], float) for r in by_class}
    n = np.array([got[c][0] if c in got else 0.0 for c in (0, 1)])
    if n.sum() == 0:
        return Discriminant(0.5)
    if n.min() < 2:
        return Discriminant(float(n[1] / n.sum()))
    means, scatters = [], []
    for c in (0, 1):
        m = got[c][1 : 1 + d] / n[c]
        s = np.zeros((d, d))
        s[i, j] = s[j, i] = got[c][1 + d :] / n[c]
        means.append(m)
        scatters.append(s - np.outer(m, m))
    pooled = (n[0] * scatters[0] + n[1] * scatters[1]) / n.sum()
    floor = np.diag(np.maximum(np.diag(pooled), 1e-6))
    pooled = (1 - ridge) * pooled + ridge * floor
    factors = [np.linalg.cholesky((1 - shrink) * s + shrink * pooled) for s in scatters]
    logdet = [2 * np.log(np.diag(f)).sum() for f in factors]
    offset = np.log(n[1] / n[0]) + 0.5 * (logdet[0] - logdet[1])
    return Discriminant(float(n[1] / n.sum()), float(offset), np.array(means), np.array([np.linalg.inv(f) for f in factors]))


def score_column(x: Column, model: Discriminant) -> Column:
    @F.pandas_udf("double")
    def udf(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(rows.tolist()).reshape(-1, len(FEATURES))))

    return udf(x)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Features and label of the labelled documents that are not held out."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", "text").join(known, "doc_id")
    return rows.select(feature_column(F.col("text")).alias("x"), "y")


def score_documents(docs: DataFrame, model: Discriminant, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*keep, score_column(feature_column(F.col("text")), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= accept, 1).otherwise(0))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = docs.select("doc_id", feature_column(F.col("text")).alias("x"))
    rows = stored(rows, "quality-features")
    known = labels.filter("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("y"))
    model = fit(rows.filter(~held_out(F.col("doc_id"))).join(known, "doc_id").select("x", "y"))
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))
