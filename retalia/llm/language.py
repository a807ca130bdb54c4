"""Language identification with a byte convolutional network, trained here in numpy.

Bytes fall into classes (small and capital letters together, digits, blanks and other marks one
class each) with trained vectors.  Filters of several widths slide over them; the largest answer
of each filter in a window goes to a softmax over the languages.  Whole texts are cut into
windows of fixed length, and a document gets the mean of its windows' probabilities.

For scoring, vectors and filters are multiplied out into tables, so that a filter of width 4 is
the sum of two look-ups by byte pair.

The network is fitted on a bounded sample of labelled rows: about ``SAMPLE`` documents of each
language (the smallest hashes of their ids), ``WINDOWS`` windows of each.  All texts are scored whole.

Edge cases: a text that is null or has no letter is ``und`` with score 0; null languages and ids
don't train; without training rows everything is ``und``; rows that repeat are scored each; an
empty table gives no rows; other columns pass through, and those named as the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.llm.common import held_out, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
VECTOR = 8
SAMPLE = 500
WINDOWS = 4
STEPS = 900
BATCH = 64
CHUNK = 16  # windows scored at a time: their answers stay in the processor's cache

_WORDLIKE = re.compile(r"[^\W\d_]")  # letters, and signs of numbers such as a half or a Roman eight
_CLASS = np.full(256, 1, np.int32)  # other marks
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(3, 29)
_CLASS[128:] = np.arange(29, 157)
CLASSES = 157


def has_letter(text: str) -> bool:
    """Whether the text has a Unicode letter."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def windows(text: str) -> np.ndarray:
    """Byte classes in rows of ``WINDOW``; the last row is filled up with blanks."""
    got = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    out = np.zeros(-(-len(got) // WINDOW) * WINDOW, np.int32)
    out[: len(got)] = got
    return out.reshape(-1, WINDOW)


class Network:
    """Weights, training and scoring."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        n = len(WIDTHS) * FILTERS
        self.w = {"vector": rng.normal(0, 0.5, (CLASSES, VECTOR)), "out": rng.normal(0, 0.1, (n, len(languages))), "bias": np.zeros(len(languages))}
        for width in WIDTHS:
            self.w[f"filter{width}"] = rng.normal(0, 1 / np.sqrt(width * VECTOR), (width * VECTOR, FILTERS))
            self.w[f"shift{width}"] = np.zeros(FILTERS)

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the cross-entropy of single windows; every language is drawn equally often."""
        rng = np.random.default_rng(seed)
        rows = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1):
            lang = rng.integers(0, len(rows), BATCH)
            batch = np.array([rng.choice(rows[k]) for k in lang])
            for k, g in self._gradients(x[batch], lang).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
                self.w[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, g = self.w, {}
        inputs = w["vector"][x]
        pooled, kept = [], []
        for width in WIDTHS:
            spans = x.shape[1] - width + 1
            cols = np.concatenate([inputs[:, j : j + spans] for j in range(width)], axis=2)
            answers = cols @ w[f"filter{width}"] + w[f"shift{width}"]
            at = answers.argmax(axis=1)
            pooled.append(np.take_along_axis(answers, at[:, None, :], 1)[:, 0])
            kept.append((cols, at))
        hidden = np.concatenate(pooled, axis=1)
        active = np.maximum(hidden, 0)
        p = _softmax(active @ w["out"] + w["bias"])
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        g["out"], g["bias"] = active.T @ p + 1e-4 * w["out"], p.sum(axis=0)
        back = (p @ w["out"].T) * (hidden > 0)
        g["vector"] = np.zeros_like(w["vector"])
        for k, width in enumerate(WIDTHS):
            cols, at = kept[k]
            d = back[:, k * FILTERS : (k + 1) * FILTERS]
            picked = cols[np.arange(len(y))[:, None], at]
            g[f"filter{width}"] = np.einsum("bfi,bf->if", picked, d)
            g[f"shift{width}"] = d.sum(axis=0)
            to_inputs = d[:, :, None] * w[f"filter{width}"].T[None]
            for j in range(width):
                classes = x[np.arange(len(y))[:, None], at + j]
                np.add.at(g["vector"], classes, to_inputs[:, :, j * VECTOR : (j + 1) * VECTOR])
        return g

    def compiled(self) -> Scorer:
        single = {w: [(self.w["vector"] @ self.w[f"filter{w}"][j * VECTOR : (j + 1) * VECTOR]) for j in range(w)] for w in WIDTHS}
        tables = {}
        for w in WIDTHS:
            parts = single[w]
            pairs = [(parts[j][:, None] + parts[j + 1][None]).reshape(-1, FILTERS).astype(np.float32) for j in range(0, w - 1, 2)]
            tables[w] = (pairs, parts[-1].astype(np.float32) if w % 2 else None)
        shift = np.concatenate([self.w[f"shift{w}"] for w in WIDTHS])
        return Scorer(self.languages, tables, shift, self.w["out"], self.w["bias"])


class Scorer:
    """Probabilities of the languages for a text, by look-ups."""

    def __init__(self, languages, tables, shift, out, bias):
        self.languages, self.tables, self.shift, self.out, self.bias = languages, tables, shift, out, bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """For each window."""
        hidden = np.empty((len(x), len(self.shift)), np.float32)
        for start in range(0, len(x), CHUNK):
            part = x[start : start + CHUNK]
            pair = part[:, :-1] * CLASSES + part[:, 1:]
            for k, width in enumerate(WIDTHS):
                pairs, last = self.tables[width]
                spans = WINDOW - width + 1
                answers = pairs[0].take(pair[:, :spans], axis=0)
                for j, more in enumerate(pairs[1:], 1):
                    answers += more.take(pair[:, 2 * j : 2 * j + spans], axis=0)
                if last is not None:
                    answers += last.take(part[:, width - 1 :], axis=0)
                hidden[start : start + CHUNK, k * FILTERS : (k + 1) * FILTERS] = answers.max(axis=1)
        return _softmax(np.maximum(hidden + self.shift, 0) @ self.out + self.bias)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0
        p = self.probabilities(windows(text)).mean(axis=0)
        return self.languages[int(p.argmax())], float(min(1.0, p.max()))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_windows(rows: DataFrame, sample: int = SAMPLE, per_text: int = WINDOWS) -> pd.DataFrame:
    """``lang`` and ``x`` (byte classes) of a bounded number of windows from ``rows`` (doc_id, text, lang)."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # the classes
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, float(sample) / n)]) if counts else None
    some = rows.filter(place < share[F.col("lang")] if counts else F.lit(False))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if has_letter(text):
                    x = windows(text)
                    out += [(lang, row) for row in x[np.linspace(0, len(x) - 1, min(per_text, len(x))).astype(int)].astype(np.int16)]
            yield pd.DataFrame(out, columns=["lang", "x"])

    got = some.select("lang", "text").mapInPandas(cut, "lang string, x array<short>")
    return got.toPandas().sort_values(["lang", "x"], key=lambda c: c.map(str)).reset_index(drop=True)


def fit(rows: DataFrame) -> Scorer:
    got = training_windows(rows)
    languages = sorted(got["lang"].unique())
    network = Network(languages)
    if len(got):
        x = np.stack(got["x"].to_numpy()).astype(np.int32)
        network.train(x, got["lang"].map(languages.index).to_numpy())
    return network.compiled()


def predict_column(text: Column, scorer: Scorer) -> Column:
    @F.pandas_udf("lang_pred string, score double")
    def udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang_pred", "score"])

    return udf(text)


def identify(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*keep, predict_column(F.col("text"), scorer).alias("_found"))
    return out.select(*keep, "_found.lang_pred", "_found.score")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scorer = fit(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), scorer)
    return found.select("doc_id", "held_out", "lang_pred", "score")
