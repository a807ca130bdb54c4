"""Phrase collocations from lossless counting quotient filters.

Words are counted for each language; those with at least ``min_count`` occurrences get ids,
and texts become sequences of ids in which 0 stands for a rarer word or the end of a piece
(no phrase that counts can hold either).  Phrases are counted length by length: a phrase is
counted only where both phrases one word shorter may be frequent, which a bit map of the length
before says (it errs on one side only, so nothing frequent is left out).  Every task keeps a
counting quotient filter (``quotient``) of the n-grams it meets and writes it in shards of
quotients; a shard's filters, already sorted, are merged and its frequent entries read back.

A phrase of at least ``min_count`` occurrences has parts of as many, so all counts of the score
stand in the frequent tables.  Cuts, scores, dropped phrases and ranks are joins and windows.

What is sent to tasks is bounded: bit maps of at most ``2**MAP_BITS`` bits, and the vocabulary
in parts of ``VOCABULARY_PART`` words, one pass over the texts for each part.

Edge cases: a null text is empty; a null language is ``und``; rows that repeat count each; a
language without candidates has no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm import quotient
from retalia.llm.common import stored, table, text_batches
from retalia.llm.quotient import Code
from retalia.operators.skew import join_repartido

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN_LANGUAGE = "und"

VOCABULARY_PART = 250_000
COUNTED_WORDS = 100_000  # different words that a task holds before it writes their counts
ENTRIES = 500_000  # entries of a task's filter before it is written
SLICE = 1 << 19  # words whose n-grams are packed at once
SHARD_ENTRIES = 1_000_000
MAP_BITS = 26

_BREAK = b"\xff"  # in no UTF-8 text
_FOLD = bytes(
    255 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with a break for each mark or line end between pieces."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(_BREAK, b" \xff ").split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``f``."""

    def rows(counts: dict[str, Counter]) -> pd.DataFrame:
        out = [(lang, w.decode("utf-8", "surrogatepass"), f) for lang, own in counts.items() for w, f in own.items()]
        return pd.DataFrame(out, columns=["lang", "word", "f"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter] = {}
        for pdf in batches:
            for lang, text in pdf.itertuples(index=False):
                own = counts.setdefault(lang, Counter())
                own.update(tokens(text))
                own.pop(_BREAK, None)
                if sum(map(len, counts.values())) > COUNTED_WORDS:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    found = docs.mapInPandas(count, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``id`` from 1, without gaps."""
    placed = stored(df.withColumn("_at", F.monotonically_increasing_id()), "phrases-vocabulary")  # part in the upper bits
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    offsets, before = [], 1
    for p, rows in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each part
        offsets.append((p, before))
        before += rows
    offsets = df.sparkSession.createDataFrame(offsets, "_part long, _from long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn("id", (F.col("_from") + at).cast("int")).drop("_at", "_part", "_from")


def _look_up(docs: DataFrame, ids: dict[str, dict[bytes, int]], last: bool) -> DataFrame:
    """``docs`` (lang, text, and ids of an earlier pass) with the ids of this part of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            out = []
            for lang, text, *before in pdf.itertuples(index=False):
                get = known.get(lang, {}).get
                own = np.array([get(w, 0) for w in tokens(text)], np.int32)
                out.append(np.where(own == 0, before[0], own) if before else own)
            pdf = pdf[["lang", "text"]] if not last else pdf[[]]
            yield pdf.assign(ids=pd.Series(out, pdf.index, dtype=object))

    return docs.mapInPandas(code, "ids array<int>" if last else "lang string, text string, ids array<int>")


def encoded(docs: DataFrame, vocabulary: DataFrame, words: int, part_words: int = VOCABULARY_PART) -> DataFrame:
    """``ids`` of each text."""
    parts = max(1, -(-words // part_words))
    for p in range(parts):
        own = vocabulary.filter((F.col("id") > p * part_words) & (F.col("id") <= (p + 1) * part_words))
        ids: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(*own.select("lang", "word", "id").toArrow().to_pydict().values()):
            ids.setdefault(lang, {})[word.encode()] = number
        docs = stored(_look_up(docs, ids, p == parts - 1), "phrases-ids")
    return docs


def _slices(batches: Iterator[pd.DataFrame], words: int) -> Iterator[np.ndarray]:
    """Ids of texts in a row, a 0 between texts, in stretches that share ``words - 1`` ids."""
    for pdf in batches:
        flat = []
        for own in pdf["ids"]:
            flat += [own, [0]]
        x = np.concatenate(flat) if flat else np.empty(0)
        for at in range(0, len(x), SLICE):
            yield x[at : at + SLICE + words - 1].astype(np.int64)


def _windows(x: np.ndarray, words: int) -> list[np.ndarray]:
    return [x[i : len(x) - words + 1 + i] for i in range(words)]


def filters(coded: DataFrame, code: Code, skip: int, shorter: tuple[Code, int, np.ndarray] | None) -> DataFrame:
    """Filters of each task's n-grams by shard.  ``shorter``: code, bits and map of the frequent (n-1)-grams."""
    shared = coded.sparkSession.sparkContext.broadcast(shorter)
    names = ["shard", "quotient_bits", "unary", "rests", "counts"]

    def rows(limbs: list[np.ndarray], counts: np.ndarray) -> pd.DataFrame:
        shard = limbs[0] >> np.uint64(code.width - skip) if skip else np.zeros(len(counts), np.uint64)
        cuts = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(counts)]
        out = [
            (int(shard[a]), *quotient.write(code, [x[a:b] for x in limbs], counts[a:b], skip))
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
        return pd.DataFrame(out, columns=names)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, limit = [], 0, ENTRIES
        for x in _slices(batches, code.words):
            if len(x) < code.words:
                continue
            windows = _windows(x, code.words)
            keep = np.logical_and.reduce([w > 0 for w in windows])
            if shared.value is not None:
                short, bits, frequent = shared.value
                own = short.pack(_windows(x, short.words))[0] >> np.uint64(short.width - bits)
                may = _held(frequent, own)
                keep &= may[:-1] & may[1:]
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            limbs = code.pack([w[at] for w in windows])
            held.append(quotient.combine(limbs, np.ones(len(at), np.int64)))
            size += len(held[-1][1])
            if size > limit:
                held = [quotient.merge(held)]
                size = len(held[0][1])
                if size > ENTRIES:
                    yield rows(*held[0])
                    held, size = [], 0
                limit = ENTRIES + size  # merged again when as much has come as may be kept
        if held:
            yield rows(*quotient.merge(held))

    return coded.mapInPandas(count, "shard int, quotient_bits int, unary binary, rests binary, counts binary")


def _held(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the map ``bits`` (64 to a number) has the places ``at``."""
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def merged(written: DataFrame, code: Code, skip: int, min_count: int) -> DataFrame:
    """Frequent n-grams of merged filters: ``ids``, ``f``, and ``place`` (leading bits, for a bit map)."""
    map_bits = min(MAP_BITS, code.width)

    def rows(shard: int, parts: list) -> pd.DataFrame:
        limbs, counts = quotient.merge(parts)
        own = np.flatnonzero(counts >= min_count)
        limbs, counts = [x[own] for x in limbs], counts[own]
        ids = np.array(code.unpack(limbs)).astype(np.int32).T.reshape(len(own), code.words)
        place = (limbs[0] >> np.uint64(code.width - map_bits)).astype(np.int64)
        return pd.DataFrame({"ids": pd.Series(list(ids), dtype=object), "f": counts, "place": place})

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, parts, size = None, [], 0
        for pdf in batches:
            for shard, *filter_ in pdf.itertuples(index=False):
                if parts and shard != now:
                    yield rows(now, parts)
                    parts, size = [], 0
                now = shard
                parts.append(quotient.read(code, shard, skip, *filter_))
                size += len(parts[-1][1])
                if size > 2 * len(parts[0][1]) + SHARD_ENTRIES:
                    parts = [quotient.merge(parts)]
                    size = len(parts[0][1])
        if parts:
            yield rows(now, parts)

    sorted_ = written.repartition("shard").sortWithinPartitions("shard")
    return sorted_.mapInPandas(join, "ids array<int>, f long, place long")


def _bit_map(frequent: DataFrame, code: Code) -> tuple[int, np.ndarray] | None:
    """Places of the frequent n-grams, 32 bits or more for each as far as the map goes; None without any."""
    n = frequent.count()
    if not n:
        return None
    most = min(MAP_BITS, code.width)
    bits = max(min(6, code.width), min(most, (32 * n - 1).bit_length()))
    place = F.shiftrightunsigned("place", most - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    got = frequent.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return bits, out.view(np.uint64)


def frequent_phrases(coded: DataFrame, words: int, total: int, longest: int, min_count: int, id_bits: int | None = None) -> list[DataFrame]:
    """``ids`` and ``f`` of the frequent phrases of 2 words and more, a table for each length."""
    bits = id_bits or max(1, words.bit_length())
    out, shorter = [], None
    for n in range(2, longest + 1):
        code = Code(n, bits)
        skip = min(code.width, max(0, total // SHARD_ENTRIES).bit_length(), 20)
        found = stored(merged(filters(coded, code, skip, shorter), code, skip, min_count), f"phrases-{n}")
        out.append(found.select("ids", "f"))
        held = _bit_map(found, code) if n < longest else None
        if held is None:
            break
        shorter = (code, *held)
    return out


def scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Candidates (ids, a, lang, n) with l, r and score of their lowest cut."""
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"left": F.expr("slice(ids, 1, k)"), "right": F.expr("slice(ids, k + 1, size(ids))")}
    )
    for side, f in (("left", "l"), ("right", "r")):
        cuts = join_repartido(cuts, frequent.select(F.col("ids").alias(side), F.col("f").alias(f)), side, ["ids"])
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "n", "l", "r")}  # products of 38 digits at most
    over = (wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).alias("over")
    cuts = cuts.select("*", over, (wide["l"] * wide["r"]).alias("under"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    return cuts.groupBy("ids", "a", "lang", "n").agg(lowest).select("ids", "a", "lang", "n", "low.l", "low.r", "low.score")


def kept(candidates: DataFrame) -> DataFrame:
    """Candidates (ids, a) that no longer one with as many occurrences holds.

    A phrase inside a longer one is inside those between, which occur no less often than the
    longer and no more often than the phrase: one word more at either end decides.
    """
    size = F.size("ids")
    inside = F.explode(F.array(F.slice("ids", 1, size - 1), F.slice("ids", 2, size - 1)))
    covered = candidates.filter(size > 2).select(inside.alias("ids"), "a").distinct()
    return candidates.join(covered, ["ids", "a"], "left_anti")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
    part_words: int = VOCABULARY_PART,
    id_bits: int | None = None,
) -> DataFrame:
    """Best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    text_batches(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col), F.lit(UNKNOWN_LANGUAGE))
    docs = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    counts = stored(word_counts(docs), "phrases-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = stored(_numbered(counts.filter(F.col("f") >= min_count)), "phrases-ids-of-words")
    words = vocabulary.count()
    total = counts.agg(F.sum("f")).first()[0] or 0
    coded = encoded(docs, vocabulary, words, part_words)
    by_length = frequent_phrases(coded, words, total, longest, min_count, id_bits)
    frequent = vocabulary.select(F.array("id").alias("ids"), "f")
    for found in by_length:
        frequent = frequent.unionByName(found)

    candidates = frequent.filter(F.size("ids") > 1).withColumnRenamed("f", "a")
    first = vocabulary.join(totals, "lang").select(F.col("id").alias("first"), "lang", "n")
    candidates = join_repartido(kept(candidates).withColumn("first", F.col("ids")[0]), first, "first", ["ids"])
    best = scored(candidates.drop("first"), frequent)
    spelled = best.select("ids", F.posexplode("ids").alias("at", "id"))
    spelled = join_repartido(spelled, vocabulary.select("id", "word"), "id", ["ids"])
    spelled = spelled.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))  # five at most
    phrase = F.concat_ws(" ", F.col("w.word"))
    out = best.join(spelled.select("ids", phrase.alias("phrase")), "ids")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


COLLOCATIONS_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, len, array_to_string(w[i:i + len - 1], ' ') AS phrase
    FROM (SELECT lang, w, l.len, unnest(range(1, len(w) - l.len + 2)) AS i FROM split, range(1, {LONGEST + 1}) AS l(len))
), freq AS (
    SELECT lang, len, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM freq WHERE len = 1 GROUP BY lang
), candidates AS (
    SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE len > 1 AND f >= {MIN_COUNT}
), cuts AS (
    SELECT *, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:len], ' ') AS rp
    FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates)
), scores AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN freq x ON x.lang = c.lang AND x.phrase = lp AND x.len = k
    JOIN freq y ON y.lang = c.lang AND y.phrase = rp AND y.len = c.len - k
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT DISTINCT lang, array_to_string(w[i:j], ' ') AS phrase, a
    FROM (SELECT lang, len, w, a, i, unnest(range(i + 1, len + 1)) AS j
          FROM (SELECT *, unnest(range(1, len)) AS i FROM candidates))
    WHERE j - i + 1 < len
)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INTEGER AS rank,
    phrase, a, l, r, n, score::BIGINT AS score
FROM lowest
WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = lowest.lang AND i.phrase = lowest.phrase AND i.a >= lowest.a)
QUALIFY rank <= {TOP}
"""
