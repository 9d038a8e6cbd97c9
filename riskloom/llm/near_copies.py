"""Near copies by shared word shingles: banded minimum hashes find candidates, the exact Jaccard similarity confirms them.

Texts with the same set of shingles are one entry. Entries that agree on all minima of a band share a bucket; two of similarity 0.8
share none of BANDS buckets with probability (1 - 0.8 ** ROWS) ** BANDS, below 0.0004. Only buckets of at most SMALL entries are paired
out. In a larger one all entries meet its first; those whose minima agree in four fifths with the first are done there, as that
pair tells their component. The others are keyed again by REKEY further minima, in REPEATS ways, and so on until all buckets are
small: unlike texts that share a passage part quickly, and a bucket's rows do not grow in number (3 x 0.8 ** 5 < 1). Work is
linear in the entries. Pairs are compared exactly only where the share of equal minima is not much below the similarity.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship, slices
from riskloom.llm.simhash_trie import components, one_row_each, row_marks
from riskloom.session import discard, settle, shared_path

WORDS, SIMILAR, BANDS, ROWS, SEED = 5, 0.8, 20, 5, 42
#: Likely pairs agree in the wanted similarity less SLACK of their minima (five standard deviations).
SMALL, REKEY, REPEATS, SLACK = 16, 5, 3, 0.2
_RNG = np.random.default_rng(SEED)
FLIPS = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
FACTORS = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles hashed at once for all minima.
CHUNK = 2048


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle, a wordless one has none."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    data = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts.tolist(), ends[words - 1:].tolist()) if len(tokens) >= words else [(0, len(data))]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(data[a:b], SEED) for a, b in spans], np.uint64))


def minima(own: np.ndarray) -> np.ndarray:
    """The minima of all hash functions over a set of shingles."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(own), CHUNK):
        low = np.minimum(low, ((own[None, k:k + CHUNK] ^ FLIPS) * FACTORS).min(axis=1))
    return low


def bands(low: np.ndarray) -> list[int]:
    """A hash of each band's minima, as signed numbers."""
    hashes = [xxhash.xxh64_intdigest(part.tobytes(), i) for i, part in enumerate(low.reshape(BANDS, ROWS))]
    return np.array(hashes, np.uint64).view(np.int64).tolist()


_SIGNED = pa.struct([("mark", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _signatures(text: Column, words: int) -> Column:
    """A text's entry, its shingles, the last byte of each minimum, and its bands (none without words)."""
    @F.arrow_udf("struct<mark:bigint,n:bigint,sketch:binary,bands:array<bigint>>")
    def signed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, parts in slices(columns):
            rows = []
            for part in parts:
                for t in part:
                    own = shingles(t.as_py(), words)
                    mark = np.array(xxhash.xxh64_intdigest(own.tobytes(), SEED), np.uint64).view(np.int64)
                    low = minima(own)
                    rows.append({"mark": int(mark), "n": len(own), "sketch": (low >> np.uint64(32)).astype(np.uint8).tobytes(), "bands": bands(low) if len(own) else []})
            yield pa.array(rows, _SIGNED)

    return signed(text)


def _sets(text: Column, words: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def sets(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, parts in slices(columns):
            yield pa.array([shingles(t.as_py(), words).view(np.int64) for part in parts for t in part], pa.list_(pa.int64()))

    return sets(text)


class _Tables:
    """Tables written on the way, to be deleted together."""

    def __init__(self):
        self.paths: list[str] = []

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(shared_path(df.sparkSession, name))
        df.write.parquet(self.paths[-1])
        return df.sparkSession.read.schema(df.schema).parquet(self.paths[-1])

    def discard(self, spark) -> None:
        for path in self.paths:
            discard(spark, path)
        self.paths.clear()


_PAIRS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _within(members: DataFrame, similar: float) -> DataFrame:
    """Likely pairs (a, b) with a > b of small buckets: enough equal minima, and sizes that allow the similarity."""
    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def pairs(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for one in column:
                held = one.values
                mark, n = held.field("mark").to_numpy(), held.field("n").to_numpy().astype(float)
                sketch = np.frombuffer(b"".join(held.field("sketch").to_pylist()), np.uint8).reshape(len(mark), -1)
                x, y = np.triu_indices(len(mark), 1)
                good = (np.minimum(n[x], n[y]) >= similar * np.maximum(n[x], n[y])) & ((sketch[x] == sketch[y]).mean(axis=1) >= similar - SLACK) & (mark[x] != mark[y])
                x, y = mark[x[good]], mark[y[good]]
                out.append([{"a": a, "b": b} for a, b in zip(np.maximum(x, y).tolist(), np.minimum(x, y).tolist())])
            yield pa.array(out, _PAIRS)

    lists = members.groupBy("bucket").agg(F.collect_list(F.struct("mark", "n", "sketch")).alias("own"))
    return lists.select(F.explode(pairs("own")).alias("p")).select("p.a", "p.b").distinct()


def _equal_minima(x: str, y: str) -> Column:
    """The share of minima that two sketches have in common."""
    @F.arrow_udf("double")
    def share(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), BANDS * ROWS) for c in (left, right))
        return pa.array((a == b).mean(axis=1))

    return share(F.col(x), F.col(y))


def _keyed_again(rows: DataFrame, turn: int) -> DataFrame:
    """Each row in REPEATS buckets of its old one: by REKEY of its minima, places drawn by the bucket."""
    @F.arrow_udf("array<bigint>")
    def keys(bucket: pa.Array, sketch: pa.Array) -> pa.Array:
        own = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(sketch), BANDS * ROWS)
        out = np.empty((len(own), REPEATS), np.int64)
        of = bucket.to_numpy().view(np.uint64)
        for repeat in range(REPEATS):
            key = np.full(len(own), np.uint64(repeat + 1 + REPEATS * turn)) ^ of
            for k in range(REKEY):
                draw = (of + np.uint64(k + REKEY * (repeat + REPEATS * turn) + 1)) * np.uint64(0x9E3779B97F4A7C15)
                place = ((draw ^ (draw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(BANDS * ROWS)
                key = (key ^ (own[np.arange(len(own)), place.astype(np.int64)].astype(np.uint64) + np.uint64(1))) * np.uint64(0x94D049BB133111EB)
                key ^= key >> np.uint64(31)
            out[:, repeat] = key.view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * REPEATS, pa.int32()), pa.array(out.reshape(-1)))

    return rows.select(F.explode(keys("bucket", "sketch")).alias("bucket"), "mark", "n", "sketch")


def candidates(members: DataFrame, similar: float, tables: _Tables) -> DataFrame:
    """Likely pairs (a, b) of (bucket, mark, n, sketch) rows; see the head of the module."""
    found, turn, older = [], 0, _Tables()
    while True:
        newer = _Tables()
        # A bucket of a very common passage is counted, not gathered: one short row per bucket and task.
        sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("mark").alias("h"), "mark", "n", "sketch")).alias("first"))
        sizes = older.settle(sizes.filter("size > 1"), "bucket-sizes")
        small = members.join(sizes.filter(F.col("size") <= SMALL).select("bucket"), "bucket", "left_semi")
        found.append(tables.settle(_within(small, similar), "likely-pairs"))
        large = sizes.filter(F.col("size") > SMALL).select("bucket", "first.*").drop("h").withColumnsRenamed({"mark": "p", "n": "p_n", "sketch": "p_sketch"})
        if large.isEmpty():
            older.discard(members.sparkSession)
            return functools.reduce(DataFrame.unionByName, found)
        met = members.join(large, "bucket").filter("mark != p").withColumn("agree", _equal_minima("sketch", "p_sketch"))
        met = older.settle(met.drop("p_sketch"), "met-first")
        likely = met.filter((F.col("agree") >= similar - SLACK) & (F.least("n", "p_n") >= F.lit(similar) * F.greatest("n", "p_n")))
        found.append(tables.settle(likely.select(F.greatest("mark", "p").alias("a"), F.least("mark", "p").alias("b")).distinct(), "likely-pairs"))
        members = newer.settle(_keyed_again(met.filter(F.col("agree") < similar).select("bucket", "mark", "n", "sketch"), turn), "keyed-again")
        older.discard(members.sparkSession)
        older, turn = newer, turn + 1


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    left = pairs.join(sets.select(F.col("mark").alias("a"), F.col("own").alias("x")), "a")
    both = left.join(sets.select(F.col("mark").alias("b"), F.col("own").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= F.lit(similar) * (F.size("x") + F.size("y") - shared)).select("a", "b")


def stars(docs: DataFrame, table: DataFrame, text_col: str, words: int, similar: float) -> DataFrame:
    """(a, b): the smallest entry b of the component of each entry a that is not it. ``table`` has row marks, entries and bands."""
    tables = _Tables()
    entries = table.filter(F.size("bands") > 0).groupBy("mark").agg(
        F.first("bands").alias("bands"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("k1", "k2")).alias("row"))
    entries = tables.settle(entries, "entries")
    rows = entries.select("mark", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket")
    members = rows.join(shared, "bucket", "left_semi").join(entries.select("mark", "n", "sketch"), "mark")
    members = tables.settle(members.select("bucket", "mark", "n", "sketch"), "buckets")
    pairs = tables.settle(candidates(members, similar, tables).distinct(), "pairs")
    # Only entries of a pair need their shingles; of equal rows one is read for all.
    asked = pairs.select(F.col("a").alias("mark")).union(pairs.select("b")).distinct()
    wanted = entries.join(asked, "mark", "left_semi").select("row.k1", "row.k2", "mark")
    k1, k2 = row_marks(docs)
    sets = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("t")).join(wanted, ["k1", "k2"])
    sets = tables.settle(sets.dropDuplicates(["mark"]).select("mark", _sets(F.col("t"), words).alias("own")), "shingle-sets")
    linked = components(_confirmed(pairs, sets, similar))
    tables.discard(docs.sparkSession)
    return linked


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """One row of each component of texts whose shingle sets have at least the given Jaccard similarity, with all its columns.

    The row with the smallest id stays, nulls last. A null text counts as empty; all wordless texts are one component.
    """
    ship(docs.sparkSession)
    k1, k2 = row_marks(docs)
    table = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), _signatures(F.col(text_col), words).alias("s"))
    table = settle(table.select("doc_id", "k1", "k2", "s.*"), "signatures")
    return one_row_each(docs, table.select("doc_id", "k1", "k2", "mark"), stars(docs, table, text_col, words, similar))
