"""Near-duplicates of a wanted similarity by SimHash: wide fingerprints, trie joins over parts of them, an exact check, components.

Two sets of shingles of Jaccard similarity s differ in a share of arccos(2s / (1 + s)) / pi of their SimHash bits at most: 0.15 at 0.8,
too many for a budget of two in one trie of 64 bits. So a fingerprint has TRIES parts of BITS bits, each part has its own trie, and
each trie is joined with itself within BUDGET differing bits, entered as in simhash_trie at the nodes that fix one of three blocks.
Two texts of similarity 0.8 meet in one trie with probability 0.4, in none with 0.0003. Where they meet, the whole fingerprints
are compared; their budget lies some standard deviations above the share, random texts differ in half.

A node gives a spanning forest of its near entries, so a large group costs links in its size, and each link is confirmed by the
exact similarity. Where one is refused, entries of the forest may still be linked some other way: all near pairs between
entries that are not connected yet are then compared in a second join by wider fingerprints. No met pair is left out.

A crowd of texts just below the similarity has such pairs in the square of its size, so they are settled inside the node: each entry
brings the bins of its shingles, and every bin in which two sets differ proves a shingle that only one of them has. A pair that has
more of these than the similarity allows gives no row; that refuses no pair of the similarity, whatever the shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship, slices
from riskloom.llm.near_copies import _confirmed, _sets, _Tables, shingles
from riskloom.llm.simhash_trie import _thirds, components, linked, one_row_each, row_marks
from riskloom.session import settle

WORDS, SIMILAR, SEED = 5, 0.8, 42
#: Bits of a part are few enough for one level of nodes; both widths are whole 64-bit words.
TRIES, BITS, BUDGET = 16, 20, 2
NARROW, WIDE = TRIES * BITS, 2048
BLOCKS = _thirds(0, BITS)
#: Standard deviations a budget lies above the expected bits, by width, and those of the first word, which is compared alone before the rest.
SLACK, FIRST_SLACK = {NARROW: 5, WIDE: 4}, 6
#: Entry pairs compared at once; nodes with more pairs than this first take off the balls around their commonest entries.
PAIRS = 1 << 20
#: Least number of bins of a set, and bytes of bins compared at once.
BINS, BIN_BYTES = 64, 1 << 24
_RNG = np.random.default_rng(SEED)
FLIPS = _RNG.integers(0, 1 << 63, WIDE // 64, dtype=np.uint64)
SECOND = np.uint64(0xD1B54A32D192ED03)
FACTORS = _RNG.integers(0, 1 << 63, WIDE // 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bit_budget(bits: int, similar: float, slack: float) -> int:
    """Differing bits of two texts of the wanted similarity, so many standard deviations above the mean."""
    p = math.acos(2 * similar / (1 + similar)) / math.pi
    return int(bits * p + slack * math.sqrt(bits * p * (1 - p)))


def wide_simhash(own: np.ndarray, bits: int) -> bytes:
    """SimHash of a set of shingle hashes: bit by bit, whether more than half of the hashes drawn from them have it set.

    Two hashes are drawn from each shingle. With one, sets of four and five shingles would differ in 0.19 of their bits for chance ties.
    """
    words, ones = bits // 64, np.zeros(bits, np.int64)
    own = np.concatenate([own, own ^ SECOND])
    for k in range(0, len(own), 255):  # sums of at most 255 bits fit the bytes of a 64-bit word, eight are added at once
        h = (own[k:k + 255, None] ^ FLIPS[:words]) * FACTORS[:words]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        ones += np.unpackbits(h.view(np.uint8), axis=1).view(np.uint64).sum(axis=0).view(np.uint8)
    return np.packbits(2 * ones > len(own)).tobytes()


_SIGNED = pa.struct([("mark", pa.int64()), ("print", pa.binary())])


def _signatures(text: Column, words: int) -> Column:
    """A text's entry and its fingerprint (none without words); texts with the same set of shingles are one entry."""
    @F.arrow_udf("struct<mark:bigint,print:binary>")
    def signed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, parts in slices(columns):
            rows = []
            for part in parts:
                for t in part:
                    own = shingles(t.as_py(), words)
                    mark = np.array(xxhash.xxh64_intdigest(own.tobytes(), SEED), np.uint64).view(np.int64)
                    rows.append({"mark": int(mark), "print": wide_simhash(own, NARROW) if len(own) else None})
            yield pa.array(rows, _SIGNED)

    return signed(text)


def _wider(sets: Column) -> Column:
    @F.arrow_udf("binary")
    def wide(column: pa.Array) -> pa.Array:
        return pa.array([wide_simhash(own.values.to_numpy().view(np.uint64), WIDE) for own in column], pa.binary())

    return wide(sets)


def binned(own: np.ndarray) -> bytes:
    """A byte for each bin, as many as a power of two that is not below the shingles: the exclusive or of a byte of each hash in it.

    Halves of the bins laid over each other by exclusive or are the bins of half the number.
    """
    bins = np.zeros(max(BINS, 1 << (len(own) - 1).bit_length()), np.uint8)
    np.bitwise_xor.at(bins, (own & np.uint64(len(bins) - 1)).astype(np.int64), (own >> np.uint64(56)).astype(np.uint8))
    return bins.tobytes()


def _binned(sets: Column) -> Column:
    @F.arrow_udf("binary")
    def bins(column: pa.Array) -> pa.Array:
        return pa.array([binned(own.values.to_numpy().view(np.uint64)) for own in column], pa.binary())

    return bins(sets)


def allowed(bins: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similar: float) -> np.ndarray:
    """Whether pairs of sets may have the similarity s: at most (1 - s) / (1 + s) of their sizes' sum are shingles of one set only.

    Each differing bin holds one of these at least, so a pair that is not allowed is not similar.
    """
    most = (sizes[left] + sizes[right]) * (1 - similar) / (1 + similar) + 1e-6
    good = np.abs(sizes[left] - sizes[right]) <= most
    widths = np.array([len(b) for b in bins])
    common = np.minimum(widths[left], widths[right])
    for width in np.unique(common[good]).tolist():
        pairs = np.flatnonzero(good & (common == width))
        held, place = np.unique(np.concatenate([left[pairs], right[pairs]]), return_inverse=True)
        folded = np.array([np.bitwise_xor.reduce(np.frombuffer(bins[k], np.uint8).reshape(-1, width), axis=0) for k in held.tolist()])
        x, y = place.reshape(2, -1)
        step = max(1, BIN_BYTES // width)
        for k in range(0, len(pairs), step):
            off = np.count_nonzero(folded[x[k:k + step]] != folded[y[k:k + step]], axis=1)
            good[pairs[k:k + step]] = off <= most[pairs[k:k + step]]
    return good


def _parts(prints: np.ndarray, tries: slice = slice(TRIES)) -> np.ndarray:
    """The number each part of a fingerprint (a row of bytes) makes, a column for each trie."""
    bits = np.unpackbits(prints, axis=1)[:, :NARROW].reshape(len(prints), TRIES, BITS)[:, tries]
    return bits @ (1 << np.arange(BITS, dtype=np.int64))


def _entered(entries: DataFrame) -> DataFrame:
    """Each entry below the nodes it is under: by trie, block and the bits of the block."""
    @F.arrow_udf("array<bigint>")
    def keys(column: pa.Array) -> pa.Array:
        parts = _parts(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1))
        entry = np.arange(TRIES * len(BLOCKS)).reshape(TRIES, -1) << BITS
        out = entry | (parts[:, :, None] & np.array(BLOCKS))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * entry.size, pa.int32()), pa.array(out.reshape(-1)))

    return entries.withColumn("node", F.explode(keys("print")))


def _leaf_pairs(part: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, start, stop): entry i of a node sorted by part is to be compared with the entries from start to stop.

    A pair that agrees on several blocks is compared at the first of them only.
    """
    leaves, first, count = np.unique(part, return_index=True, return_counts=True)
    x, y = linked(leaves.astype(np.uint64), BUDGET, BITS)
    own = np.arange(len(leaves))
    x, y = np.concatenate([x, own]), np.concatenate([y, own])
    differ = leaves[x] ^ leaves[y]
    here = np.ones(len(x), bool)
    for earlier in BLOCKS[:block]:
        here &= (differ & earlier) != 0
    x, y = x[here], y[here]
    left = np.repeat(first[x] - (np.cumsum(count[x]) - count[x]), count[x]) + np.arange(count[x].sum())
    x, y = np.repeat(x, count[x]), np.repeat(y, count[x])
    return left, np.where(x == y, left + 1, first[y]), first[y] + count[y]


def _differing(prints: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[left] ^ prints[right]).sum(axis=-1, dtype=np.int64)


def _compared(prints: np.ndarray, ranges: tuple[np.ndarray, np.ndarray, np.ndarray], similar: float, roots: np.ndarray | None = None) -> Iterator[tuple]:
    """(left, right, bits) of the pairs of the ranges within the budget, piece by piece; with roots only of unequal ones."""
    i, start, stop = ranges
    size = stop - start
    bits = prints.shape[1] * 64
    whole, first = bit_budget(bits, similar, SLACK[bits]), bit_budget(64, similar, FIRST_SLACK)
    ends = np.cumsum(size)
    at = 0
    while at < len(i):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        n = size[at:to]
        left = np.repeat(i[at:to], n)
        right = np.repeat(start[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        likely = np.bitwise_count(prints[left, 0] ^ prints[right, 0]) <= first
        if roots is not None:
            likely &= roots[left] != roots[right]
        left, right = left[likely], right[likely]
        bits_off = _differing(prints, left, right)
        near = bits_off <= whole
        yield left[near], right[near], bits_off[near]
        at = to


def _spanning(marks: np.ndarray, edges: list[tuple]) -> list[tuple]:
    """A minimum spanning forest; ties go by the marks, so that all nodes choose alike."""
    if not edges:
        return []
    left, right, bits = (np.concatenate([e[k] for e in edges]) for k in range(3))
    root = list(range(len(marks)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    high, low = np.maximum(marks[left], marks[right]), np.minimum(marks[left], marks[right])
    order, chosen = np.lexsort((high, low, bits)), []
    for k, x, y in zip(order.tolist(), left[order].tolist(), right[order].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            chosen.append(k)
    return [(left[chosen], right[chosen], bits[chosen])]


def _ball(prints: np.ndarray, alive: np.ndarray, pivot: int, similar: float) -> tuple[np.ndarray, list[tuple]]:
    """Entries near a pivot, and links: the pivot with each of them, and each entry outside with the nearest of them.

    Entries further from the pivot than the ball's radius and the budget together are further than the budget from all within.
    """
    bits = prints.shape[1] * 64
    radius, budget = bit_budget(bits, similar, -1), bit_budget(bits, similar, SLACK[bits])
    off = _differing(prints, alive, np.array([pivot]))
    within, ring = off <= radius, alive[(off > radius) & (off <= radius + budget)]
    ball = alive[within]
    others = ball != pivot
    links = [(np.full(others.sum(), pivot), ball[others], off[within][others])]
    step = max(1, PAIRS // max(1, len(ball)))
    for k in range(0, len(ring), step):
        some = ring[k:k + step]
        between = sum(np.bitwise_count(prints[some, None, w] ^ prints[None, ball, w]).astype(np.int64) for w in range(prints.shape[1]))
        nearest = between.argmin(axis=1)
        least = between[np.arange(len(some)), nearest]
        links.append((some[least <= budget], ball[nearest[least <= budget]], least[least <= budget]))
    return within, links


def forest_links(marks: np.ndarray, prints: np.ndarray, part: np.ndarray, block: int, similar: float) -> list[tuple]:
    """Links of one node, sorted by part and mark: near entries are connected over them."""
    alive, links = np.arange(len(marks)), []
    while True:
        ranges = _leaf_pairs(part[alive], block)
        if (ranges[2] - ranges[1]).sum() <= PAIRS:
            break
        leaves, first, count = np.unique(part[alive], return_index=True, return_counts=True)
        within, found = _ball(prints, alive, alive[first[count.argmax()]], similar)
        if within.sum() < max(32, len(alive) // 64):
            break  # a crowd of unlike texts: all are compared
        links += found
        alive = alive[~within]
    edges, held = [], 0
    for left, right, bits in _compared(prints[alive], ranges, similar):
        edges.append((alive[left], alive[right], bits))
        held += len(left)
        if held > PAIRS:
            edges = _spanning(marks, edges)
            held = len(edges[0][0])
    return _spanning(marks, links + edges)


def open_links(roots: np.ndarray, prints: np.ndarray, parts: np.ndarray, trie: int, block: int, similar: float) -> list[tuple]:
    """All near pairs of one node between entries of unequal roots, each only in the first trie and block where it meets."""
    ranges = _leaf_pairs(parts[:, trie], block)
    names, of, count = np.unique(roots, return_inverse=True, return_counts=True)
    rest = np.flatnonzero(of != count.argmax())
    if len(rest) * len(roots) < (ranges[2] - ranges[1]).sum():  # a large group and a few others
        ranges = rest, np.zeros(len(rest), np.int64), np.full(len(rest), len(roots))
    found = []
    for left, right, bits in _compared(prints, ranges, similar, roots):
        differ = parts[left] ^ parts[right]
        here = (np.bitwise_count(differ[:, trie]) <= BUDGET) & (differ[:, trie] & BLOCKS[block] == 0)
        here &= (np.bitwise_count(differ[:, :trie]) > BUDGET).all(axis=1)
        for earlier in BLOCKS[:block]:
            here &= differ[:, trie] & earlier != 0
        found.append((left[here], right[here], bits[here]))
    return found


def _joined(entries: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) with a > b of (mark, print) entries that meet in a trie.

    Of (mark, print, root, bins, size) entries all pairs of unequal roots whose bins allow the similarity.
    """
    rooted = "root" in entries.columns

    def pairs(node: pa.Table) -> pa.Table:
        a = b = np.zeros(0, np.int64)
        if node.num_rows > 1:
            entry = node.column("node")[0].as_py() >> BITS
            marks = node.column("mark").to_numpy()
            prints = np.frombuffer(b"".join(node.column("print").to_pylist()), np.uint8).reshape(len(marks), -1)
            trie, block = divmod(entry, len(BLOCKS))
            parts = _parts(prints) if rooted else _parts(prints, slice(trie, trie + 1))
            order = np.lexsort((marks, parts[:, trie if rooted else 0]))
            marks, prints, parts = marks[order], np.ascontiguousarray(prints[order]).view(np.uint64), parts[order]
            if rooted:
                found = open_links(node.column("root").to_numpy()[order], prints, parts, trie, block, similar)
                bins, sizes = node.column("bins").take(order).to_pylist(), node.column("size").to_numpy()[order]
                found = [tuple(f[allowed(bins, sizes, *link[:2], similar)] for f in link) for link in found]
            else:
                found = forest_links(marks, prints, parts[:, 0], block, similar)
            if found:
                x, y = (marks[np.concatenate([f[k] for f in found])] for k in range(2))
                a, b = np.maximum(x, y), np.minimum(x, y)
        return pa.table({"a": a, "b": b})

    return _entered(entries).groupBy("node").applyInArrow(pairs, "a bigint, b bigint").distinct()


def _open_roots(refused: DataFrame, linked_entries: DataFrame) -> DataFrame:
    """Roots with a refused link to another root. The forests connect all near entries, so no other root has a near entry outside it."""
    root = lambda end: linked_entries.select(F.col("a").alias(end), F.col("b").alias(f"{end}_root"))
    ends = refused.join(root("a"), "a", "left").join(root("b"), "b", "left")
    ends = ends.select(F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y")).filter("x != y")
    return ends.select(F.explode(F.array("x", "y")).alias("root")).distinct()


def stars(docs: DataFrame, table: DataFrame, text_col: str, words: int, similar: float) -> DataFrame:
    """(a, b): the smallest entry b of the component of each entry a that is not it. ``table`` has row marks, entries, fingerprints."""
    tables = _Tables()
    entries = table.filter(F.col("print").isNotNull()).groupBy("mark").agg(F.first("print").alias("print"), F.min(F.struct("k1", "k2")).alias("row"))
    entries = tables.settle(entries, "entries")
    pairs = tables.settle(_joined(entries.select("mark", "print"), similar), "trie-links")
    # Only entries of a pair need their shingles; of equal rows one is read for all.
    asked = pairs.select(F.col("a").alias("mark")).union(pairs.select("b")).distinct()
    wanted = entries.join(asked, "mark", "left_semi").select("row.k1", "row.k2", "mark")
    k1, k2 = row_marks(docs)
    sets = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("t")).join(wanted, ["k1", "k2"])
    sets = tables.settle(sets.dropDuplicates(["mark"]).select("mark", _sets(F.col("t"), words).alias("own")), "shingle-sets")
    found = tables.settle(_confirmed(pairs, sets, similar), "confirmed")
    refused = tables.settle(pairs.join(found, ["a", "b"], "left_anti"), "refused")
    linked_entries = components(found)
    if not refused.isEmpty():
        rooted = sets.join(linked_entries.select(F.col("a").alias("mark"), F.col("b").alias("root")), "mark", "left")
        rooted = rooted.select("mark", "own", F.coalesce("root", "mark").alias("root"))
        # Written first, so that Spark can split the join at the root of a large group.
        opened = rooted.join(tables.settle(_open_roots(refused, linked_entries), "open-roots"), "root", "left_semi")
        opened = opened.select("mark", "root", _wider(F.col("own")).alias("print"), _binned(F.col("own")).alias("bins"), F.size("own").alias("size"))
        opened = tables.settle(opened, "open-entries")
        more = tables.settle(_joined(opened, similar).join(refused, ["a", "b"], "left_anti"), "open-links")
        # The stars stand for the links found before: they connect the same entries.
        linked_entries = components(linked_entries.unionByName(_confirmed(more, sets, similar)))
    tables.discard(docs.sparkSession)
    return linked_entries


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """One row of each component of texts whose shingle sets have at least the given Jaccard similarity, with all its columns.

    The row with the smallest id stays, nulls last. A null text counts as empty; all wordless texts are one component.
    """
    ship(docs.sparkSession)
    k1, k2 = row_marks(docs)
    table = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), _signatures(F.col(text_col), words).alias("s"))
    table = settle(table.select("doc_id", "k1", "k2", "s.*"), "signatures")
    return one_row_each(docs, table.select("doc_id", "k1", "k2", "mark"), stars(docs, table, text_col, words, similar))
