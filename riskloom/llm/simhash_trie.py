"""Near-duplicates by SimHash: fingerprints, a binary trie self-join within an error budget, and linked components.

Distinct fingerprints only are joined, so copies cost nothing. With a budget of two differing bits, two linked fingerprints agree
wholly on at least one of three blocks of bits: the trie is entered at the nodes that fix one block, once per block, and those
nodes are spread over the cluster. Within a node pairs of subtrees are followed together, differing bits added up, and a pair is
left as soon as it has more than the budget. A node with too many fingerprints is entered again three times, each time with one of
three blocks of its remaining bits fixed as well; that loses no link and ends, as a node with few free bits has few fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, ship, slices
from riskloom.session import settle

WORDS, BITS, BUDGET, SEED = 3, 64, 2, 42
#: Fingerprints in one node of the distributed trie, and pairs of subtrees followed at once.
NODE, FRONTIER = 4096, 1 << 18
#: A fingerprint with more than one row in this many is joined in parts.
HOT_SHARE, SALTS = 1000, 64


def simhash(text: str, words: int = WORDS) -> int:
    """Fingerprint of one text: bit by bit, whether more than half of its shingles' hashes have it set."""
    tokens = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not tokens:
        return 0
    data = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts.tolist(), ends[words - 1:].tolist()) if len(tokens) >= words else [(0, len(data))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(data[a:b], SEED) for a, b in spans], ">u8")
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The fingerprint of a text column as a signed 64-bit number; null counts as empty."""
    @F.arrow_udf("bigint")
    def prints(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, parts in slices(columns):
            values = [simhash(t.as_py(), words) for part in parts for t in part]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return prints(text)


def linked(prints: np.ndarray, budget: int = BUDGET, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of distinct sorted fingerprints of so many bits within the budget, as positions, by following pairs of trie nodes.

    A node is a range of the sorted array. A pair of two single fingerprints is settled by counting their differing bits.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start = np.zeros((1, 5), np.int64)
    start[0] = 0, len(prints), 0, len(prints), 0
    todo = [(start, bits - 1)]
    while todo:
        pairs, bit = todo.pop()
        while len(pairs):
            a, b = pairs[:, 0], pairs[:, 2]
            single = (pairs[:, 1] - a == 1) & (pairs[:, 3] - b == 1)
            if single.any():
                x, y = a[single], b[single]
                near = (x != y) & (np.bitwise_count(prints[x] ^ prints[y]) <= budget)
                found.append((x[near], y[near]))
                pairs = pairs[~single]
            if not len(pairs) or bit < 0:
                break
            if len(pairs) > FRONTIER:
                half = len(pairs) // 2
                todo.append((pairs[half:], bit))
                pairs = pairs[:half]
                continue
            pairs, bit = _children(prints, pairs, bit, budget), bit - 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _children(prints: np.ndarray, pairs: np.ndarray, bit: int, budget: int) -> np.ndarray:
    one, above = np.uint64(1 << bit), np.uint64(((1 << BITS) - 1) ^ ((1 << (bit + 1)) - 1))
    cut = lambda lo: np.searchsorted(prints, (prints[lo] & above) | one)  # noqa: E731  first with the bit set
    a0, a2, b0, b2, errors = pairs.T
    a1, b1 = np.clip(cut(a0), a0, a2), np.clip(cut(b0), b0, b2)
    same = a0 == b0
    out = [np.stack([a0, a1, b0, b1, errors], 1), np.stack([a1, a2, b1, b2, errors], 1), np.stack([a0, a1, b1, b2, errors + 1], 1),
           np.stack([a1, a2, b0, b1, errors + 1], 1)[~same]]
    out = np.concatenate(out)
    return out[(out[:, 0] < out[:, 1]) & (out[:, 2] < out[:, 3]) & (out[:, 4] <= budget)]


def forest(count: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """(position, smallest position it is linked with, directly or not) for all that are linked with a smaller one."""
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(left.tolist(), right.tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in range(count) if root[x] != x]


def _thirds(mask: int, bits: int = BITS) -> list[int]:
    """The mask with one of three blocks of the free bits fixed as well, for each block."""
    free = [1 << b for b in range(bits) if not mask >> b & 1]
    n = len(free)
    return [mask | sum(free[n * k // (BUDGET + 1):n * (k + 1) // (BUDGET + 1)]) for k in range(BUDGET + 1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _nodes(prints: DataFrame, limit: int) -> DataFrame:
    """(mask, node, fps): the fingerprints below each entered trie node, in nodes of bounded size."""
    masks = _thirds(0)
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    rows = rows.withColumn("node", F.col("fp").bitwiseAND(F.col("mask")))
    done = []
    while True:
        fixed = min(m.bit_count() for m in masks)
        if 1 << (BITS - fixed) <= limit:
            done.append(rows)
            break
        hot = settle(rows.groupBy("mask", "node").count().filter(F.col("count") > limit).select("mask", "node"), "hot-nodes")
        if hot.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(hot, ["mask", "node"], "left_anti"))
        table = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(t)) for t in _thirds(m)]))])
        rows = (rows.join(hot, ["mask", "node"], "left_semi")
                .select("fp", F.explode(table[F.col("mask")]).alias("mask"))
                .withColumn("node", F.col("fp").bitwiseAND(F.col("mask"))).distinct())
        rows = settle(rows, "split-nodes")
        masks = sorted({t for m in masks for t in _thirds(m)})  # two ways may fix the same bits
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.groupBy("mask", "node").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)


def links(prints: DataFrame, limit: int = NODE) -> DataFrame:
    """(a, b) with a > b: for every two fingerprints within the budget a path of links, as a forest of each trie node."""
    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def pairs(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for one in column:
                own = np.unique(np.array(one.as_py(), np.int64).view(np.uint64))
                signed = own.view(np.int64).tolist()
                out.append([(max(signed[x], signed[y]), min(signed[x], signed[y])) for x, y in forest(len(own), *linked(own))])
            yield pa.array([[{"a": a, "b": b} for a, b in o] for o in out], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return _nodes(prints, limit).select(F.explode(pairs("fps")).alias("l")).select("l.a", "l.b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): the smallest member b of the component of each a that is not it. Large and small stars in turn until nothing moves."""
    edges = settle(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a != b").distinct())
        edges = settle(small, "stars")
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if now == state:
            return edges
        state = now


def near_groups(prints: DataFrame, limit: int = NODE) -> DataFrame:
    """(doc_id, fp, component_id) for each row of a settled (doc_id, fp) table."""
    groups = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "fingerprints")
    stars = components(links(groups.select("fp"), limit))
    rooted = groups.join(stars.withColumnRenamed("a", "fp"), "fp", "left").withColumn("root", F.coalesce("b", "fp"))
    rooted = settle(rooted.select("fp", "low", "n", "root"), "roots")
    moved = rooted.filter("fp != root").select("root").distinct()
    lows = rooted.join(moved, "root", "left_semi").groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "root", "left").select("fp", "n", F.coalesce("component_id", "low").alias("component_id"))
    # Rows of a very common fingerprint are joined in parts: at most HOT_SHARE fingerprints can be that common.
    total = rooted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = [r.fp for r in rooted.filter(F.col("n") * HOT_SHARE > total).select("fp").collect()]
    is_hot = F.col("fp").isin(hot) if hot else F.lit(False)
    salted = named.withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    rows = prints.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    return rows.join(salted.drop("n"), ["fp", "salt"]).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = NODE) -> DataFrame:
    """Fingerprint and component of every row: the smallest id that can be reached over links, its own included.

    A null or wordless text has fingerprint zero and is linked like any other; null ids do not count for the smallest id, and a
    component without any id has a null one; repeated rows stay; other columns are not read.
    """
    ship(docs.sparkSession)
    prints = settle(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fp")), "prints")
    return near_groups(prints, limit).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_marks(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a whole row; rows that are equal in all columns have the same."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    nulls = [c.isNull() for c in plain]  # a null does not change the hash of a row
    return F.xxhash64(*plain, *nulls), F.xxhash64(F.lit(SEED), *nulls, *plain)


def one_row_each(docs: DataFrame, table: DataFrame, stars: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` for each component: the smallest by id (nulls last), mark and row hashes.

    ``table`` has (doc_id, mark, k1, k2) of every row of ``docs``, ``stars`` the components (a, b) of marks. Minima are taken per mark
    first, so copies of a hot mark collapse before anything is joined.
    """
    names = docs.columns
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "k1", "k2")).alias("best")
    first = table.groupBy("mark").agg(best).join(stars.withColumnRenamed("a", "mark"), "mark", "left")
    stay = settle(first.groupBy(F.coalesce("b", "mark").alias("root")).agg(F.min("best").alias("best")).select("best.k1", "best.k2"), "stay")
    one, two = fresh(names, "mark_one"), fresh(names, "mark_two")
    k1, k2 = row_marks(docs)
    tagged = docs.withColumns({one: k1, two: k2})
    here = lambda keys: keys.select(F.col("k1").alias(one), F.col("k2").alias(two))
    counted = table.groupBy("k1", "k2").agg(F.count("*").alias("n"))
    repeated = settle(counted.filter("n > 1").join(stay, ["k1", "k2"], "left_semi"), "repeated")
    gone = counted.join(stay, ["k1", "k2"], "left_anti")
    kept = tagged.join(here(gone), [one, two], "left_anti")
    if not repeated.isEmpty():
        twice = kept.join(here(repeated), [one, two], "left_semi").dropDuplicates([one, two])
        kept = kept.join(here(repeated), [one, two], "left_anti").unionByName(twice)
    return kept.select(*[F.col(f"`{c}`") for c in names])


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of linked fingerprints, with all its columns: the smallest id's, rows without an id last."""
    ship(docs.sparkSession)
    k1, k2 = row_marks(docs)
    prints = settle(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("mark"), k1.alias("k1"), k2.alias("k2")), "prints")
    return one_row_each(docs, prints, components(links(prints.select(F.col("mark").alias("fp")).distinct())))
