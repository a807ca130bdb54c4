"""Best-fit packing of token pieces into sequences, in bulk-synchronous sweeps.

Documents become token ids and a closing id; only documents longer than a sequence are cut.
Piece lengths and gaps are whole numbers up to the sequence length L, so the range sort is a
counting sort: Spark counts the pieces of every length in every part of the input, and the
running sums over the parts give each piece its rank among the pieces of its length.  Equal
lengths are interchangeable, so a length with a range of ranks, and a gap with a range of
sequences, stand for all of their members.

A sweep runs over the at most L lengths in falling order and finds for each the successor among
the gaps, the smallest gap that is large enough; conflicts over a gap are settled by rank: the
k-th piece takes the k-th sequence, and what is left goes on to the next larger gap.  At the
end of a sweep all gaps are updated at once, and the next sweep starts.  When no piece fits any
gap, new sequences are opened with the longest pieces left, as many as the tokens left need at
least, and the sweeps go on.

The sweeps work on counts (at most L lengths, gap ranges that grow with L but not with the
rows); what grows with the corpus, tokenizing, ranks and the final place of each piece, is done
by Spark.  The place of a piece is a search for its rank among the ranges of its length.

Edge cases: a null or empty text has no ids but the closing one, so each document has at least
one piece; rows that repeat are packed each; a null doc_id is packed like any other; an empty
table gives no rows; the operator reads the id and text columns and passes no others on.
"""

from __future__ import annotations

import array
import os
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import handing_back, stored, table

LENGTH = 2048
CLOSING_ID = 0
WORDS_KEPT = 300_000  # words whose ids a task remembers
MARKS = ".,!?;:%&$#*"  # marks that are split off the end of a word before it is tokenized

_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch  # lower-case letters that no normalizer changes


def _parts(word: str) -> tuple[str, str]:
    """A word as what is tokenized alone and the marks behind it; the ids are those of both, in order.

    The tokenizer parts marks from letters and digits, and it lowers case.
    """
    stem = word.rstrip(MARKS)
    if not stem or not stem[-1].lower().isalnum():
        stem = word
    return (stem.lower() if max(stem, default="") < "\u0100" else stem), word[len(stem) :]


def _closing(tokenizer) -> np.ndarray:
    """Of each id, whether its token closes a word; of none, if the vocabulary does not mark that."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    vocabulary = tokenizer.get_vocab()
    closing = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
    if suffix:
        closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return closing


def _encoded(tokenizer, closing: np.ndarray, words: list[str]) -> Iterator[tuple[str, bytes]]:
    """Each of the words with its ids.

    Words of plain letters go to the tokenizer as one text: it merges inside words only, and the
    last token of each word says that it closes one.  The others go one by one.
    """
    plain = [w for w in words if _PLAIN(w)] if closing.any() else []
    if plain:
        ids = np.array(tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(closing[ids]) + 1)
        if len(ends) == len(plain) and ends[-1] == 4 * len(ids):
            raw, start = ids.tobytes(), 0
            for w, end in zip(plain, ends.tolist()):
                yield w, raw[start:end]
                start = end
            words = [w for w in words if not _PLAIN(w)]
    for w, e in zip(words, tokenizer.encode_batch_fast(words, add_special_tokens=False)):
        ids = array.array("I", e.ids)
        if sys.byteorder == "big":
            ids.byteswap()
        yield w, ids.tobytes()


def _ids_of(tokenizer_file: str, words_kept: int = WORDS_KEPT):
    """Text to little-endian 32-bit ids.

    The tokenizer drops white space before it merges, so ids of a text are those of its words
    one after another; words met before are not tokenized again.  Words are kept in two
    generations: when the newer one is full, the words not used since it began are dropped.
    Tokenizer and words last as long as the returned function, a task: workers are reused by
    other stages, which need the memory.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    closing = _closing(tokenizer)
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def ids(text: str) -> bytes:
        nonlocal known, older
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        parts = {}
        for w in set(words).difference(known):
            if w in older:
                known[w] = older[w]
            else:
                parts[w] = _parts(w)
        if parts:
            new = {p for both in parts.values() for p in both}.difference(known)
            known.update([(p, older[p]) for p in new if p in older])
            known.update(_encoded(tokenizer, closing, list(new.difference(older))))
            for w, (stem, marks) in parts.items():
                known[w] = known[stem] + known[marks]
        out = b"".join(map(known.__getitem__, words))
        if len(known) > words_kept // 2:
            known, older = {}, known
        return out

    return ids


def pieces(
    docs: DataFrame,
    tokenizer_file: str,
    length: int = LENGTH,
    closing_id: int = CLOSING_ID,
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its rank in its part and length."""
    end = np.array([closing_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids_of(tokenizer_file, words_kept)
        seen = np.zeros(length + 1, np.int64)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                raw = ids(text) + end if text else end
                for k, at in enumerate(range(0, len(raw), 4 * length)):
                    part = raw[at : at + 4 * length]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if not out:
                continue
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            by_length = frame.groupby("length")["piece"]
            frame["rank"] = by_length.cumcount() + seen[frame["length"]]
            counts = by_length.size()
            seen[counts.index.to_numpy()] += counts.to_numpy()
            yield frame

    # As a string: pandas would turn longs beside a null into doubles.
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, rank long"
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = read.mapInPandas(handing_back(cut), schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    # The part's number goes along with the rows: ranks count within a part.
    return out.withColumn("part", F.spark_partition_id())


def sweeps(counts: np.ndarray, length: int) -> np.ndarray:
    """Where each range of pieces goes.

    ``counts[s]``: pieces of length s.  Returns rows (size, first rank, number, first sequence,
    offset): the k-th piece of the range goes to the k-th sequence from the first on.
    """
    left, rank = counts.astype(np.int64).copy(), np.zeros(length + 1, np.int64)
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap: ranges [first sequence, number]
    opened = 0
    while left.any():
        sizes = np.flatnonzero(left)
        tokens = int((sizes * left[sizes]).sum())
        new, tall = -(-tokens // length), int(left[length // 2 + 1 :].sum())
        new = max(new, tall)  # pieces of more than half a sequence never share one
        for size in sizes[::-1]:
            n = int(min(left[size], new))
            if not n:
                break
            plan.append((int(size), int(rank[size]), n, opened, 0))
            gaps.setdefault(length - int(size), []).append([opened, n])
            rank[size] += n
            left[size] -= n
            opened, new = opened + n, new - n
        placed = True
        while placed:
            placed = False
            after: dict[int, list[list[int]]] = {}
            open_gaps = sorted(g for g in gaps if g)
            for size in np.flatnonzero(left)[::-1]:
                size = int(size)
                for gap in open_gaps[int(np.searchsorted(open_gaps, size)) :]:
                    ranges = gaps[gap]
                    while left[size] and ranges:
                        first, number = ranges[-1]
                        n = int(min(number, left[size]))
                        plan.append((size, int(rank[size]), n, first, length - gap))
                        after.setdefault(gap - size, []).append([first, n])
                        rank[size] += n
                        left[size] -= n
                        placed = True
                        if n == number:
                            ranges.pop()
                        else:
                            ranges[-1] = [first + n, number - n]
                    if not left[size]:
                        break
                open_gaps = [g for g in open_gaps if gaps[g]]
            for gap, ranges in after.items():
                gaps.setdefault(gap, []).extend(ranges)
            gaps = {g: _merged(r) for g, r in gaps.items() if r}
    return np.array(plan, np.int64).reshape(-1, 5)


def _merged(ranges: list[list[int]]) -> list[list[int]]:
    """Ranges of sequences that touch become one."""
    out: list[list[int]] = []
    for first, number in sorted(ranges):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1][1] += number
        else:
            out.append([first, number])
    return out


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    length: int = LENGTH,
    closing_id: int = CLOSING_ID,
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for every piece.

    ``words_kept`` is the memory of a task (about 200 bytes a word) against its time.
    """
    cut = stored(pieces(docs, tokenizer_file, length, closing_id, words_kept), "pack-pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    counts = np.zeros(length + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        counts[row["length"]] = row["n"]
    plan = sweeps(counts, length)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        # One sorted key for (length, rank): ranks stay below 2**40.
        firsts = (plan[:, 0] << 40) + plan[:, 1]
        at = np.searchsorted(firsts, (size.to_numpy() << 40) + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": plan[at, 3] + rank.to_numpy() - plan[at, 1], "offset": plan[at, 4]})

    ranked = cut.join(stored(before, "pack-ranks"), ["part", "length"])
    ranked = ranked.withColumn("at", place("length", F.col("rank") + F.col("ahead")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary; every executor has the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), words_kept=1_000_000)
