"""The near-duplicate stage by SimHash tries: its links against all pairs, crowds in one node, and refused links."""

import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from riskloom.llm import simhash_similar
from riskloom.llm.simhash_trie import simhash


def jaccard(a, b):
    x, y = ({" ".join(t.lower().split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def lowest(count, pairs):
    low = list(range(count))
    for _ in range(count):
        was = low[:]
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
        if low == was:
            return low


def changed(rng, base, times):
    copy = base[:]
    for at in rng.sample(range(len(base)), times):
        copy[at] = f"w{rng.randrange(10**6)}"
    return copy


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def kept(spark, texts):
    return sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, texts), "").collect())


def test_the_stage_has_its_links_from_the_tries(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(changed(rng, base, 2)), "something else of more than five words"]
    assert kept(spark, texts) == [0, 2]
    joined = simhash_similar._joined
    monkeypatch.setattr(simhash_similar, "_joined", lambda entries, similar: joined(entries, similar).limit(0))
    assert kept(spark, texts) == [0, 1, 2]


def test_a_fingerprint_bit_is_the_majority_of_its_hashes():
    own = np.random.default_rng(1).integers(0, 1 << 63, 700, dtype=np.uint64)
    bits = lambda shingles: np.unpackbits(np.frombuffer(simhash_similar.wide_simhash(shingles, 2048), np.uint8))
    words = lambda h: ((h ^ simhash_similar.FLIPS) * simhash_similar.FACTORS)
    mixed = words(np.concatenate([own, own ^ simhash_similar.SECOND])[:, None])
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    each = np.unpackbits((mixed ^ (mixed >> np.uint64(29))).view(np.uint8), axis=1).astype(int)
    assert (bits(own) == (2 * each.sum(axis=0) > len(each))).all() and 0.48 < each.mean() < 0.52
    assert simhash_similar.wide_simhash(own, 2048).startswith(simhash_similar.wide_simhash(own, 320))


@pytest.mark.parametrize("both, left, right", [(4, 0, 1), (5, 0, 1), (8, 1, 1), (16, 2, 2), (80, 10, 10), (800, 0, 200)])
def test_sets_of_four_fifths_differ_in_the_bits_expected(both, left, right):
    rng, off = np.random.default_rng(2), []
    for _ in range(60):
        own = rng.integers(0, 1 << 63, both + left + right, dtype=np.uint64)
        a, b = (np.unpackbits(np.frombuffer(simhash_similar.wide_simhash(np.sort(s), 320), np.uint8)) for s in (own[:both + left], np.concatenate([own[:both], own[both + left:]])))
        off.append((a != b).sum())
    assert np.mean(off) < 320 * 0.16 and max(off) <= simhash_similar.bit_budget(320, 0.8, simhash_similar.SLACK[320])


def crowd(rng, count):
    """Fingerprints of two loose groups and some others, sorted as a node has them."""
    centre = rng.integers(0, 2, (2, 320))
    rows = [centre[k % 2] ^ (rng.random(320) < rng.choice([0.01, 0.08, 0.16])) for k in range(count)] + [rng.integers(0, 2, 320) for _ in range(count // 4)]
    prints = np.packbits(np.array(rows, np.uint8), axis=1)
    parts = simhash_similar._parts(prints)
    order = np.argsort(parts[:, 0], kind="stable")
    return np.ascontiguousarray(prints[order]).view(np.uint64), parts[order]


@pytest.mark.parametrize("pairs", [40, 1 << 20])
def test_a_node_connects_what_all_its_pairs_connect(monkeypatch, pairs):
    monkeypatch.setattr(simhash_similar, "PAIRS", pairs)
    rng = np.random.default_rng(5)
    prints, parts = crowd(rng, 300)
    part = parts[:, 0]
    marks = rng.permutation(len(part)) * 7
    budget = simhash_similar.bit_budget(320, 0.8, simhash_similar.SLACK[320])
    off = lambda i, j: int(np.bitwise_count(prints[i] ^ prints[j]).sum())
    first = lambda i, j: next((k for k, m in enumerate(simhash_similar.BLOCKS) if not (part[i] ^ part[j]) & m), None)
    near = [(i, j) for i in range(len(part)) for j in range(i) if int(part[i] ^ part[j]).bit_count() <= 2 and off(i, j) <= budget]
    got = []
    for block in range(len(simhash_similar.BLOCKS)):
        links = simhash_similar.forest_links(marks, prints, part, block, 0.8)
        links = [(x, y) for left, right, _ in links for x, y in zip(left.tolist(), right.tolist())]
        assert all(off(x, y) <= budget for x, y in links) and len(links) < len(part)
        got += links
        roots = np.arange(len(part)) % 3
        across = simhash_similar.open_links(roots, prints, parts, 0, block, 0.8)
        found = {(max(x, y), min(x, y)) for left, right, _ in across for x, y in zip(left.tolist(), right.tolist())}
        assert {(i, j) for i, j in near if first(i, j) == block and roots[i] != roots[j]} == found
    low, want = lowest(len(part), got), lowest(len(part), near)
    assert all(low[i] == low[j] for i in range(len(part)) for j in [want[i]])


def test_stage_equals_all_pairs_where_many_links_are_refused(spark):
    """Similarities on both sides of four fifths within one crowd: forests have links that the exact check refuses."""
    rng = random.Random(6)
    texts = []
    for group in range(4):
        base = [f"g{group}x{i}" for i in range(150)]
        texts += [" ".join(changed(rng, base, rng.randrange(6))) for _ in range(40)]
    texts += ["", " \n", *(" ".join(f"short{i}" for i in range(n)) for n in range(1, 12))]
    worded = [i for i, t in enumerate(texts) if len(t.split()) > 4]
    pairs = [(i, j) for i in worded for j in worded if j < i and jaccard(texts[i], texts[j]) >= 0.8] + [(161, 160)]
    low = lowest(len(texts), pairs)
    assert kept(spark, texts) == sorted(set(low)) and 10 < len(set(low)) < 160


def test_a_large_group_of_near_copies_costs_links_in_its_size(spark):
    base = [f"h{i}" for i in range(300)]
    texts = [" ".join(base[:k % 290] + [f"x{k}"] + base[k % 290 + 1:]) for k in range(600)]
    table = frame(spark, texts)
    signed = table.select(simhash_similar._signatures(table["text"], 5).alias("s")).select("s.*").distinct().cache()
    few = simhash_similar._joined(signed.limit(300), 0.8).count()
    assert simhash_similar._joined(signed, 0.8).count() <= 3 * few <= 3 * 20 * 300
    assert kept(spark, texts) == [0]


def test_a_crowd_just_below_the_similarity_costs_no_pairs(spark, monkeypatch):
    """Texts of two changed words share about three quarters with each other; texts of one change connect with some of them."""
    rng = random.Random(8)
    base = [f"c{i}" for i in range(150)]
    texts = [" ".join(changed(rng, base, 2 if k % 20 else 1)) for k in range(240)]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    low = lowest(len(texts), pairs)
    checked, confirmed = [], simhash_similar._confirmed
    monkeypatch.setattr(simhash_similar, "_confirmed", lambda found, sets, similar: checked.append(found.count()) or confirmed(found, sets, similar))
    assert kept(spark, texts) == sorted(set(low))
    assert len(checked) == 2 and checked[1] <= 2 * len(texts)


def crossing(rng, both, left, right):
    own = rng.integers(0, 1 << 63, both + left + right, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, both + left + right, dtype=np.uint64)
    return np.sort(own[:both + left]), np.sort(np.concatenate([own[:both], own[both + left:]]))


@pytest.mark.parametrize("nbytes", [100, 1 << 24])
def test_bins_refuse_no_pair_of_the_similarity(monkeypatch, nbytes):
    monkeypatch.setattr(simhash_similar, "BIN_BYTES", nbytes)
    rng = np.random.default_rng(4)
    # (shared, only left, only right): the last have widths of one bin count and its double
    shapes = [(4, 0, 1), (4, 1, 0), (1, 0, 0), (8, 1, 1), (80, 10, 10), (800, 200, 0), (4000, 500, 500), (64, 0, 16), (60, 0, 10), (250, 6, 56)]
    sets = [s for _ in range(20) for shape in shapes for s in crossing(rng, *shape)]
    bins, sizes = [simhash_similar.binned(s) for s in sets], np.array([len(s) for s in sets])
    left = np.arange(0, len(sets), 2)
    assert simhash_similar.allowed(bins, sizes, left, left + 1, 0.8).all() and simhash_similar.allowed(bins, sizes, left + 1, left, 0.8).all()
    assert not simhash_similar.allowed(bins, sizes, left[:-1], left[:-1] + 3, 0.8).any()  # sets of other draws
    below = [s for _ in range(50) for s in crossing(rng, 126, 20, 20)]  # 0.76
    bins, sizes, left = [simhash_similar.binned(s) for s in below], np.array([len(s) for s in below]), np.arange(0, len(below), 2)
    assert simhash_similar.allowed(bins, sizes, left, left + 1, 0.8).mean() < 0.3
    assert len(simhash_similar.allowed(bins, sizes, left[:0], left[:0], 0.8)) == 0


def test_parts_of_a_trie_join_leave_op7_as_it_is():
    text = "one two three four five"
    own = [xxhash.xxh64_intdigest(s, 42) for s in (b"one two three", b"two three four", b"three four five")]
    assert simhash(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > 3)
