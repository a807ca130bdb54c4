"""Near-duplicates, passages, packing, sharding, mixing: brute force on small data, and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_data import SCHEMA, brute_components, prose, rows

from retalia.llm import bits, mixing, packing, sharding, simhash, substrings


def slow_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def edited(text, seed, share):
    azar = random.Random(seed)
    return " ".join("edit%d" % azar.randrange(99) if azar.random() < share else w for w in text.split())


# -- SimHash -----------------------------------------------------------------------------


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
@pytest.mark.parametrize("n", [5, 64, 333])
def test_bit_sliced_links_equal_all_pairs(n, radius):
    azar = np.random.default_rng(n + radius)
    fp = azar.integers(0, 1 << 63, (max(2, n // 4), 1), dtype=np.uint64)[azar.integers(0, max(2, n // 4), n)]
    for _ in range(4):
        fp ^= np.uint64(1) << azar.integers(0, 64, (n, 1)).astype(np.uint64)
    near = [(i, j) for i in range(n) for j in range(i) if bin(int(fp[i, 0] ^ fp[j, 0])).count("1") <= radius]
    want = brute_components(range(n), near)
    lag, block = np.arange(n), np.arange(n)
    bits.link_neighbours(fp, np.zeros(n, np.int64), n, radius, lag)
    bits.link_blocks(np.arange(n), np.arange(n), fp, radius, block)
    assert lag.tolist() == block.tolist() == [want[i] for i in range(n)]


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)  # large buckets are cut
    base = prose(60, 5)
    texts = [edited(base, s, 0.02) for s in range(60)] + [prose(60, 100 + s) for s in range(30)] + [base, base, None, ""]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = {r.id: r for r in simhash.near_duplicates(docs).collect()}
    fp = {i: slow_fingerprint(t, 4) for i, t in enumerate(texts)}
    assert {i: r.fp[0] & (1 << 64) - 1 for i, r in found.items()} == fp
    near = [(i, j) for i in fp for j in fp if i < j and bin(fp[i] ^ fp[j]).count("1") <= 4]
    assert {i: r.first_id for i, r in found.items()} == brute_components(fp, near)


def test_one_of_each_group_stays(spark):
    texts = [prose(300, s) for s in range(12)]
    texts += [edited(texts[0], 1, 0.01), texts[1], edited(texts[2], 3, 0.5)]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 14]


def test_simhash_of_odd_rows(spark, odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    zero = {r.first_id for r in found if r.fp == [0]}
    assert zero == {0}
    kept = [r.doc_id for r in simhash.keep_first(odd).collect()]
    assert sorted(kept) == [0, 3, 5, 6, 8, 9]  # the null ids are copies of 0 and 3
    assert simhash.near_duplicates(empty).count() == simhash.keep_first(empty).count() == 0


# -- passages ----------------------------------------------------------------------------


def test_passages_are_found_and_cut(spark):
    passage = prose(80, 9, 5000)
    texts = [prose(150, 10 + s, 5000) for s in range(8)]
    for i in (1, 3, 5):
        words = texts[i].split()
        texts[i] = " ".join(words[:70] + edited(passage, i, 0.04).split() + words[70:])
    texts.append(texts[0])
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = substrings.find_passages(docs).collect()
    hit = {r.doc_id for r in found} | {r.ref_id for r in found if r.doc_id != 8}
    assert hit == {1, 3, 5, 8}
    for r in found:
        if r.doc_id == 8:
            assert (r.start, r.end, r.ref_id, r.identity) == (0, 150, 0, 1.0)
        else:
            assert abs(r.start - 70) <= 3 and abs(r.end - 150) <= 3 and r.identity >= 0.8
    out = {r.doc_id: r.text for r in substrings.remove_passages(docs).collect()}
    assert sorted(out) == list(range(8))
    sizes = Counter(len(out[i].split()) for i in (1, 3, 5))
    assert sizes[230] == 1 and all(n <= 156 for n in sizes if n != 230)
    assert all(out[i] == texts[i] for i in (0, 2, 4, 6, 7))


def test_chain_prefers_order_and_near_segments():
    pos = np.array([0, 10, 20, 30, 40, 5])
    ref = np.array([100, 110, 120, 131, 141, 900])
    assert substrings.chain(pos, ref)[0] == (0, 45, 100, 146)
    assert substrings.chain(np.array([0, 500]), np.array([0, 530])) == [(0, 5, 0, 5), (500, 505, 530, 535)]


def test_passages_of_odd_rows(spark, odd, empty):
    found = substrings.find_passages(odd).collect()
    assert [(r.doc_id, r.ref_id) for r in found] == [(7, 6)]
    out = substrings.remove_passages(odd)
    assert out.columns == odd.columns
    assert out.count() == odd.count() - 2  # document 7, twice
    assert substrings.find_passages(empty).count() == substrings.remove_passages(empty).count() == 0
    assert substrings.cut_out("a  b\nc d ", [(1, 3)]) == "a d "


def exact_windows(texts, n=50):
    """Words of each text that stand in a window of ``n`` words which a text of smaller hash holds too."""
    first = {}
    for h, t in sorted(texts.items()):
        w = t.split()
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), h)
    want = {}
    for h, t in texts.items():
        w = t.split()
        want[h] = {i + k for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] != h for k in range(n)}
    return want


def test_passages_of_stock_sentences_are_found(spark):
    azar = random.Random(21)
    stock = [prose(12, 4000 + s, 5000) for s in range(8)]
    alone = [" ".join([prose(40, 5000 + 50 * s + k, 5000), stock[s], prose(40, 7000 + 50 * s + k, 5000)]) for s in range(8) for k in range(30)]
    held = [" ".join([prose(60, 9000 + k, 5000), *stock[2 * (k % 2) : 2 * (k % 2) + 6], prose(60, 9500 + k, 5000)]) for k in range(6)]
    texts = alone + held
    azar.shuffle(texts)
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = substrings.find_passages(docs).collect()
    hashes = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(text) AS h").collect()}
    want = exact_windows({hashes[i]: t for i, t in enumerate(texts)})
    assert sum(map(len, want.values())) >= 4 * 72
    for i in range(len(texts)):
        covered = {k for r in found if r.doc_id == i for k in range(r.start, r.end)}
        assert want[hashes[i]] <= covered, i


def test_alignments_go_on_beyond_their_blocks(spark):
    chains = spark.createDataFrame([(1, 2, 700, 730, 710, 740, 5)], substrings.CHAIN + ", chain long")
    passage = prose(1500, 31, 5000)
    texts = [" ".join([prose(100 + 10 * k, 40 + k, 5000), passage, prose(90, 50 + k, 5000)]) for k in range(2)]
    texts = spark.createDataFrame([(k + 1, t) for k, t in enumerate(texts)], "h long, text string")
    (near,) = substrings._align_all(texts, chains, 64).collect()
    (far,) = substrings._align_all(texts, chains, 4096).collect()
    assert near.more and not far.more and (far.s, far.e, far.rs, far.re) == (100, 1600, 110, 1610)


def test_stretches_leave_out_what_differs():
    assert sorted(substrings.stretches([(0, 0, 60), (100, 100, 3), (140, 140, 55)])) == [(0, 60, 0, 60, 1.0), (140, 195, 140, 195, 1.0)]


@pytest.mark.parametrize("identity, least", [(0.8, 0.95), (0.85, 0.97), (0.9, 0.97)])
@pytest.mark.parametrize("size", [50, 80, 120])
def test_edited_passages_are_found(size, identity, least):
    """One edited passage in two texts, by seeds, chains and alignments; all of them are passages as a whole."""
    azar = np.random.default_rng(size)
    new = lambda n: azar.integers(1 << 40, 1 << 60, n).astype(np.uint64)
    hits = 0
    for _ in range(100):
        passage = new(size)
        other = passage.copy()
        n = round(size * (1 - identity))
        other[azar.choice(size, n, replace=False)] = new(n)
        a, b = np.r_[new(150), passage, new(150)], np.r_[new(157), other, new(150)]
        (ha, pa), (hb, pb) = substrings.seeds(a), substrings.seeds(b)
        _, i, j = np.intersect1d(ha, hb, return_indices=True)
        frame = pd.DataFrame({"h": 1, "ref": 2, "pos": pa[i], "ref_pos": pb[j]}).sort_values("pos", ignore_index=True)
        chains = substrings._chains_of(frame) if len(frame) else frame
        found = [x for c in chains.itertuples() for x in substrings.align(a, b, c.s, c.rs, (False,) * 4)]
        assert all(x[0] >= 150 - 10 and x[1] <= 150 + size + 10 and x[4] >= 0.8 - 1e-9 for x in found)
        hits += any(x[1] - x[0] >= 50 for x in found)
    assert hits >= 100 * least


# -- packing -----------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_sweeps_place_every_piece_once(seed):
    azar = np.random.default_rng(seed)
    counts = np.bincount(np.minimum(azar.geometric(0.02, 800), 100), minlength=101)
    plan = packing.sweeps(counts, 100)
    filled, taken = Counter(), Counter()
    for size, rank, n, first, offset in plan[np.lexsort((plan[:, 4], plan[:, 3]))]:
        taken[size] += n
    by_bin = [(first + k, offset, size) for size, _, n, first, offset in plan for k in range(n)]
    for b, offset, size in sorted(by_bin):
        assert filled[b] == offset
        filled[b] += size
    assert taken == Counter({s: int(c) for s, c in enumerate(counts) if c}) and max(filled.values()) <= 100
    assert len(filled) <= 1.03 * (counts * np.arange(101)).sum() / 100 + 1


def test_packing_keeps_every_token(spark, odd, empty):
    from tokenizers import Tokenizer

    path = packing.tokenizer_file()
    plain = Tokenizer.from_file(path)
    out = packing.pack(odd, path, length=256).collect()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    want = Counter()
    for doc, text in [(r.doc_id, r.text) for r in odd.collect()]:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want[doc, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want and texts
    at = Counter()
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert at[r.sequence_id] == r.offset
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 256
    assert packing.pack(empty, path).count() == 0


@pytest.mark.parametrize("text", ["The CAT, sat.. don't!%%%", "É!! İ. ǆ, A'S 12,3;;", "<|endoftext|>%%% x<|startoftext|>..", "é.. ̸= a b\x85,"])
def test_ids_by_word_are_those_of_the_text(text):
    from tokenizers import Tokenizer

    path = packing.tokenizer_file()
    got = np.frombuffer(packing._ids_of(path)(text), "<u4").tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


# -- sharding ----------------------------------------------------------------------------


def test_shards_have_near_equal_bytes(spark):
    azar = random.Random(3)
    texts = ["copy of one text " * 3] * 700 + [prose(azar.randrange(1, 60), s) for s in range(1400)]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    out = sharding.shard_documents(docs, 8).collect()
    total = Counter()
    for r in out:
        assert r.size == len(texts[r.doc_id].encode()) + 1
        total[r.shard] += r.size
    mean = sum(total.values()) / 8
    assert len(total) == 8 and all(abs(t - mean) <= 400 for t in total.values())
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    held = Counter((texts[r.doc_id], r.shard) for r in out)
    assert len(held) <= len(set(texts)) + 7  # only a splitter cuts a group of copies


def test_shards_of_odd_rows(spark, odd, empty):
    out = sharding.shard_documents(odd, 4)
    assert set(out.columns) == {*odd.columns, "shard", "slot"}
    assert out.count() == odd.count() and out.filter("text IS NULL AND size <> 1").count() == 0
    assert sharding.shard_documents(empty).count() == 0


# -- mixing ------------------------------------------------------------------------------


def slow_targets(sizes, weights, cap):
    left, room = dict.fromkeys(sizes), sum(sizes.values())
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    out = {}
    while True:
        unit = room / sum(w[s] for s in left)
        over = [s for s in left if unit * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: unit * w[s] for s in left}
        for s in over:
            out[s] = cap * sizes[s]
            room -= out[s]
            del left[s]


def test_sources_meet_their_targets(spark):
    azar = random.Random(4)
    names = [None, "a", "b", "c", "d", "e", "tiny"]
    data = [(i, prose(azar.randrange(1, 40), i), azar.choice(names[:6]) if i % 3 else "b") for i in range(1500)]
    data += [(9000, "just four words here", "tiny"), (9001, None, "a"), (9002, "", "none")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in out:
        assert r.size == len((r.text or "").split()) and 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    want = slow_targets({s: sizes[s] for s in {x[2] for x in data}}, (1, 2, 3), 3)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 41, s
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in out}


def test_mixing_of_odd_rows(spark, odd, empty):
    out = mixing.mix(odd)
    assert out.count() == odd.count() and out.filter("copies IS NULL OR copies > 3").count() == 0
    assert mixing.mix(empty).count() == 0


def test_ranges_of_near_copies_are_asked_once_for_each_pair(spark, monkeypatch):
    """A row for each text and each it is aligned with, however many words and chains they share."""
    text = prose(900, 3).split()
    texts = [(i, " ".join([*(f"own{i}x{k}" for k in range(4)), *text[: 400 + i], f"mid{i}", *text[400 + i :]])) for i in range(12)]
    asked, write = [], substrings.stored

    def stored(df, name):
        out = write(df, name)
        asked.extend([out] if name == "chain-blocks" else [])
        return out

    monkeypatch.setattr(substrings, "stored", stored)
    found = substrings.passages(spark.createDataFrame(texts, "h long, text string"), 12 * 905).collect()
    assert asked and all(x.count() == x.select("of", "own").distinct().count() for x in asked)
    longest = {i: max((r.e - r.s for r in found if r.h == i), default=0) for i in range(1, 12)}
    assert min(longest.values()) >= 850
