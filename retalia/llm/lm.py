"""Language-model scoring by cross-entropy difference.

Two bigram models of words, one of a target (good documents) and one of the background (all
documents), share one vocabulary: all words of the corpus.  In either model a token costs

    -log P(w | v),  P(w | v) = (n(v w) + BACKOFF P(w)) / (n(v) + BACKOFF),
                    P(w) = (n(w) + SMOOTH) / (n + SMOOTH (words of the vocabulary + 1)),

where v is the word before, or the start of the text, and what P(. | v) leaves over is the end
of a text.  A document's score is the mean difference of these losses over its tokens:
background less target, so that a higher score is nearer to the target.  No document is scored
with counts of its own: its own are taken off the background, and the target is counted in two
halves by id, each scoring the documents of the other.

Nothing of the counts is held in one place, and none is left out, however large the vocabulary:

1. Documents are dealt by hash into parts of about ``PART_CHARS``.  A part counts its words and
   pairs of words and writes them as sorted filters (``quotient``), one for each shard of keys.
2. A shard adds up the filters of all parts and answers each of them: the counts of its keys
   over the corpus, in its own order, so neither keys nor documents are sent back.  A key that
   occurs once is known without an answer.
3. A part counts its keys once more, which puts the answers in place, and scores its documents.

Words and pairs are known by ``KEY_BITS`` of a 64-bit hash; two of n agree with a probability of
about n^2 / 2^(KEY_BITS + 1), and then share their counts.

Edge cases: a text without words (null, empty, blanks) has 0 tokens and score 0; target ids that
are null or have no document count nothing; rows that repeat are counted and scored each; without
target documents all scores are 0; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.llm import quotient
from retalia.llm.common import stored, table
from retalia.llm.quotient import Code
from retalia.llm.words import coded, mixed

BACKOFF = 20.0  # weight of the word frequencies against what is counted after a word
SMOOTH = 0.1
KEY_BITS = 48
PART_CHARS = 8 << 20
SHARD_ENTRIES = 2_000_000
FEW = 500_000  # counted target ids: small enough to broadcast

_START = np.uint64(0x5851F42D4C957F2D)  # stands for the word before the first; any odd number will do
_PAIR = np.uint64(0xD1342543DE82EF95)  # odd multiplier of the first word of a pair
_CODE = Code(1, KEY_BITS)
_COUNTS = "unary binary, rests binary, counts binary, t0 binary, t1 binary"


class Keys:
    """Words and pairs of some texts: their different keys in order, and which ones the tokens have."""

    def __init__(self, texts: list[str | None]):
        codes, self.sizes = coded(texts)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.first = np.r_[True, self.doc[1:] != self.doc[:-1]][: len(codes)]
        before = np.r_[_START, codes[:-1]][: len(codes)]
        before[self.first] = _START
        # The last bit of a key tells words from pairs.
        word = codes >> np.uint64(64 - KEY_BITS) | np.uint64(1)
        pair = mixed(before * _PAIR + codes) >> np.uint64(64 - KEY_BITS) & ~np.uint64(1)
        self.keys, at = np.unique(np.r_[word, pair], return_inverse=True)
        self.word, self.pair = at[: len(codes)], at[len(codes) :]

    def sums(self, docs: np.ndarray) -> np.ndarray:
        """Occurrences of each key in the documents that ``docs`` marks."""
        own = docs[self.doc]
        return np.bincount(np.r_[self.word[own], self.pair[own]], minlength=len(self.keys))

    def own(self, at: np.ndarray) -> np.ndarray:
        """How often each token's key occurs in its own document."""
        _, back, count = np.unique(self.doc * len(self.keys) + at, return_inverse=True, return_counts=True)
        return count[back]


def _sparse(values: np.ndarray) -> bytes:
    """Which values are above 0, and these."""
    some = values > 0
    return np.packbits(some).tobytes() + quotient.varints(values[some])


def _dense(raw: bytes, n: int) -> np.ndarray:
    size = -(-n // 8)
    some = np.unpackbits(np.frombuffer(raw, np.uint8, size), count=n).astype(bool)
    out = np.zeros(n, np.int64)
    out[some] = quotient.from_varints(raw[size:])
    return out


def _whole_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each part of a partition that is sorted by part."""
    rest = None
    for pdf in batches:
        pdf = pd.concat([rest, pdf], ignore_index=True) if rest is not None else pdf
        if not len(pdf):
            continue
        cuts = np.r_[0, np.flatnonzero(np.diff(pdf["part"].to_numpy())) + 1]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[cuts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _filters(batches: Iterator[pd.DataFrame], skip: int) -> Iterator[pd.DataFrame]:
    for pdf in _whole_parts(batches):
        k = Keys(pdf["text"].tolist())
        if not len(k.keys):
            continue
        half, good = pdf["half"].to_numpy(), pdf["good"].to_numpy(bool)
        counts = [k.sums(np.ones(len(pdf), bool)), *(k.sums(good & (half == h)) for h in (0, 1))]
        shard = k.keys >> np.uint64(KEY_BITS - skip) if skip else np.zeros(len(k.keys), np.uint64)
        cuts = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(shard)]
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            filter_ = quotient.write(_CODE, [k.keys[a:b]], counts[0][a:b], skip)
            out.append((pdf["part"].iloc[0], int(shard[a]), *filter_, *(_sparse(c[a:b]) for c in counts[1:])))
        yield pd.DataFrame(out, columns=["part", "shard", "quotient_bits", "unary", "rests", "counts", "t0", "t1"])


def _answers(batches: Iterator[pd.DataFrame], skip: int) -> Iterator[pd.DataFrame]:
    """Filters sorted by shard to an answer for each, and a row (part -1) of the shard's totals."""
    names = ["part", "shard", "n", "b", "t0", "t1"]

    def answer(shard: int, rows: list) -> pd.DataFrame:
        keys, own = [], [[], [], []]
        for _, bits, unary, rests, counts, t0, t1 in rows:
            (limb,), b = quotient.read(_CODE, shard, skip, bits, unary, rests, counts)
            keys.append(limb)
            for to, x in zip(own, (b, _dense(t0, len(b)), _dense(t1, len(b)))):
                to.append(x)
        all_keys = np.concatenate(keys)
        order = np.argsort(all_keys, kind="stable")
        in_order = all_keys[order]
        first = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]])
        group = np.zeros(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        b, t0, t1 = (np.add.reduceat(np.concatenate(x)[order], first) for x in own)
        word = in_order[first] & np.uint64(1) == 1
        out = [(-1, shard, int(word.sum()), *(quotient.varints(x[word].sum(keepdims=True)) for x in (b, t0, t1)))]
        at = 0
        for (part, *_), limb in zip(rows, keys):
            g = group[at : at + len(limb)]
            at += len(limb)
            more = b[g] > 1
            out.append((part, shard, len(g), _sparse(np.where(more, b[g], 0)), *(_sparse(np.where(more, x[g], 0)) for x in (t0, t1))))
        return pd.DataFrame(out, columns=names)

    now, rows = None, []
    for pdf in batches:
        for part, shard, *rest in pdf.itertuples(index=False):
            if rows and shard != now:
                yield answer(now, rows)
                rows = []
            now = shard
            rows.append((part, *rest))
    if rows:
        yield answer(now, rows)


class Totals:
    """Tokens of the background and of both halves of the target, their documents, and the vocabulary."""

    def __init__(self, tokens: list[int], docs: list[int], words: int):
        self.tokens, self.docs, self.words = tokens, docs, words


def losses(k: Keys, half: np.ndarray, counts: list[np.ndarray], totals: Totals) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each token in the target and the background; ``counts``: of each key in background, half 0, half 1."""
    other = 1 - half[k.doc]  # the half of the target that scores the document

    def loss(n_pair, n_before, n_word, n, n_docs) -> np.ndarray:
        n_before = np.where(k.first, n_docs, np.r_[0, n_before[:-1]])
        p_word = (n_word + SMOOTH) / (n + SMOOTH * (totals.words + 1))
        return -np.log((n_pair + BACKOFF * p_word) / (n_before + BACKOFF))

    own = k.own(k.word)
    background = loss(
        counts[0][k.pair] - k.own(k.pair),
        counts[0][k.word] - own,
        counts[0][k.word] - own,
        totals.tokens[0] - k.sizes[k.doc],
        totals.docs[0] - 1,
    )
    of_half = [np.where(other == 0, counts[1][at], counts[2][at]) for at in (k.pair, k.word)]
    n, n_docs = (np.where(other == 0, x[1], x[2]) for x in (totals.tokens, totals.docs))
    return loss(of_half[0], of_half[1], of_half[1], n, n_docs), background


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, loss_target and loss_background (means in nats), score (their difference).

    ``docs``: doc_id, text; ``target_ids``: doc_id.
    """
    spark = docs.sparkSession
    good = target_ids.filter("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("good", F.lit(True))
    good = stored(good, "lm-target")
    few = good.count() <= FEW
    flagged = docs.select("doc_id", "text").join(F.broadcast(good) if few else good, "doc_id", "left")
    half, text_chars = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"), F.sum(F.length("text"))
    flagged = flagged.select("doc_id", "text", half.alias("half"), F.coalesce("good", F.lit(False)).alias("good"))
    of_half = [F.count_if(F.col("good") & (F.col("half") == h)) for h in (0, 1)]
    *n_docs, chars = flagged.agg(F.count("*"), *of_half, text_chars).first()
    chars = chars or 0
    skip = min(16, (chars // 5 // SHARD_ENTRIES).bit_length())
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-chars // PART_CHARS))))
    # As a string: pandas would turn longs beside a null into doubles.
    rows = flagged.withColumns({"part": part, "doc_id": F.col("doc_id").cast("string")})
    found = rows.select("part", "text", "half", "good").repartition("part").sortWithinPartitions("part")
    found = found.mapInPandas(lambda it: _filters(it, skip), f"part long, shard int, quotient_bits int, {_COUNTS}")
    found = found.repartition("shard").sortWithinPartitions("shard")
    answers = found.mapInPandas(lambda it: _answers(it, skip), "part long, shard int, n int, b binary, t0 binary, t1 binary")
    answers = stored(answers, "lm-answers")
    tokens, words = [0, 0, 0], 0
    for n, *sums in answers.filter("part = -1").select("n", "b", "t0", "t1").collect():  # a row for each shard
        words += n
        tokens = [t + int(quotient.from_varints(bytes(x))[0]) for t, x in zip(tokens, sums)]
    totals = Totals(tokens, n_docs, words)

    def work(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        k, half = Keys(texts["text"].tolist()), texts["half"].to_numpy()
        counts = [np.concatenate([np.zeros(0, np.int64)] + [_dense(x, n) for x, n in zip(answers[c], answers["n"])]) for c in ("b", "t0", "t1")]
        counts[0] = np.maximum(counts[0], 1)  # without an answer: one occurrence
        target, background = losses(k, half, counts, totals)
        means = [np.bincount(k.doc, x, len(texts)) / np.maximum(k.sizes, 1) for x in (target, background)]
        scored = (k.sizes > 0) & np.array([tokens[2 - h] > 0 for h in half])  # a target to compare with
        target, background = (np.where(scored, x, 0.0) for x in means)
        return pd.DataFrame({"doc_id": texts["doc_id"], "n_tokens": k.sizes, "loss_target": target, "loss_background": background})

    both = rows.drop("good").groupBy("part").cogroup(answers.filter("part >= 0").groupBy("part"))
    out = both.applyInPandas(
        lambda a, b: work(a, b.sort_values("shard")), "doc_id string, n_tokens long, loss_target double, loss_background double"
    )
    out = out.withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.withColumn("score", F.col("loss_background") - F.col("loss_target"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled good and not toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return score(docs, good)
