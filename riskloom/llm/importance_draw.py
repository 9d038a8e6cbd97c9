"""Draw documents towards a target distribution: hashed n-gram importance weights, Gumbel keys, distributed quickselect.

A pass counts features by hash bucket over all documents, and another over the target texts; the gain of each bucket is a fixed
array. A second pass adds up the gains of each document's features. The draw is the k highest keys: random pivot keys cut the rows
still in question, exact counts below, at and above each pivot tell which cut holds the k-th key, and only winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_blocks, ship, slices
from riskloom.session import settle

BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: Random pivots of a round of the selection.
PIVOTS = 16

#: A-Z lowered, other ASCII characters but digits and letters to spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts of a column without nulls, and the text that each is in."""
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    raw = memoryview(texts.buffers()[2] or b"")[ends[0]:ends[-1]].tobytes().translate(_PLAIN)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(raw))
    split = pc.split_pattern(plain, " ")
    offsets = split.offsets.to_numpy()
    parts = split.values.slice(offsets[0], offsets[-1] - offsets[0])
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    held = pc.greater(pc.binary_length(parts), 0)
    return parts.filter(held), text[held.to_numpy(zero_copy_only=False)]


def features(texts: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the text of each, and the words of each text."""
    words, text = _words(texts)
    found, of = [], []
    run, owner = words, text
    for n in range(1, longest + 1):
        if n > 1:
            whole = text[n - 1:] == text[:len(text) - n + 1]
            run = pc.binary_join_element_wise(run.slice(0, len(whole)), words.slice(n - 1), " ")
            owner = text[:len(whole)]
        coded = run.dictionary_encode()
        crc = np.array([zlib.crc32(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.int64) % buckets
        own = crc[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        inside = whole if n > 1 else np.ones(len(own), bool)
        found.append(own[inside])
        of.append(owner[inside])
    return np.concatenate(found), np.concatenate(of), np.bincount(text, minlength=len(texts))


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket. The driver gets one number for each bucket."""
    ship(texts.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, parts in slices([batch.column(0)]):
                for part in parts:
                    total += np.bincount(features(part, buckets, longest)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = texts.select(F.col(text_col)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share of each bucket, one added to every count, rounded down."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_source + n) / ((float(s) + 1) * (all_target + n))))
                     for s, t in zip(source, target)], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw from the seed and the id, rounded down; a null id counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, n_features, n_words, weight and score of each row: the mean gain, and that plus the row's Gumbel draw."""
    ship(docs.sparkSession)
    kind = pa.struct([("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64())])

    @F.arrow_udf("struct<n_features:bigint,n_words:bigint,weight:bigint>")
    def weigh(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def block(texts: pa.Array):
            found, of, words = features(texts, len(gain), longest)
            n = np.bincount(of, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, of, gain[found])
            return n, words, total // np.maximum(n, 1)

        yield from in_blocks(columns, block, kind)

    rows = docs.select(F.col(id_col).alias("doc_id"), weigh(F.col(text_col)).alias("w")).select("doc_id", "w.*")
    return rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def _key(score: Column, doc_id: Column) -> Column:
    """Orders rows by falling score, then rising id, null ids last."""
    return F.struct((-score).alias("a"), doc_id.isNull().alias("b"), doc_id.alias("c"))


def kth_key(rows: DataFrame, k: int) -> tuple | None:
    """(score, id) of the k-th row by falling score and rising id, null ids last; None if there are fewer.

    Every round is one scan: each row still in question is counted below, at or above the round's pivots, and the random pivots of
    the next round are drawn in the same scan from each of the cuts. The driver gets at most 2 x 16 + 1 cuts of 16 rows.
    """
    kind = rows.schema["doc_id"].dataType
    literal = lambda key: _key(F.lit(key[0]).cast("long"), F.lit(key[1]).cast(kind))
    own = _key(F.col("score"), F.col("doc_id"))
    low = high = None
    pivots: list[tuple] = []
    left, turn = k, 0
    while True:
        held = rows
        if low is not None:
            held = held.filter(own > literal(low))
        if high is not None:
            held = held.filter(own < literal(high))
        cut = F.lit(0)
        for p in pivots:
            cut = cut + F.when(own > literal(p), 2).when(own == literal(p), 1).otherwise(0)
        draw = F.xxhash64("doc_id", "score", F.lit(turn))
        cuts = (held.groupBy(cut.alias("cut"), F.pmod(draw, F.lit(PIVOTS)).alias("slot"))
                .agg(F.count("*").alias("n"), F.min_by(F.struct("score", "doc_id"), draw).alias("pivot")).collect())
        sizes: dict[int, int] = {}
        for r in cuts:
            sizes[r["cut"]] = sizes.get(r["cut"], 0) + r["n"]
        for c in sorted(sizes):
            if left <= sizes[c]:
                break
            left -= sizes[c]
        else:
            return None
        if c % 2:
            return pivots[c // 2]
        low, high = (pivots[c // 2 - 1] if c else low), (pivots[c // 2] if c // 2 < len(pivots) else high)
        found = {(r["pivot"]["score"], r["pivot"]["doc_id"]) for r in cuts if r["cut"] == c}
        nulls = [p for p in found if p[1] is None]
        pivots = sorted(nulls + sorted(p for p in found if p[1] is not None), key=lambda p: (-p[0], p[1] is None))
        turn += 1


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """Rows with ``rank``: 1 to k by falling score and rising id, null ids last, null for all others.

    ``rows`` must be a written table, as it is read several times. Of rows that equal the k-th in score and id, as many get a rank
    as are left. Winners are range-partitioned and numbered by partition; rows of one key may fill several partitions.
    """
    spark = rows.sparkSession
    last = kth_key(rows.filter("eligible"), k) if k > 0 else None
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    own = _key(F.col("score"), F.col("doc_id"))
    wins = F.col("eligible") & (own <= _key(F.lit(last[0]).cast("long"), F.lit(last[1]).cast(rows.schema["doc_id"].dataType)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    sorted_ = rows.filter(wins).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(sorted_.withColumn("row", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("row", 33)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row for each partition
    before, bases = 0, []
    for r in counts:
        bases.append((r["part"], before))
        before += r["count"]
    table = spark.createDataFrame(bases, "part long, base long")
    rank = F.col("base") + F.col("row") - F.shiftleft(F.col("part"), 33) + 1
    winners = placed.withColumn("part", part).join(F.broadcast(table), "part").withColumn("rank", F.when(rank <= k, rank))
    return winners.select(*rows.columns, "rank").unionByName(rows.filter(~wins).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
          longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``, drawn towards the texts of ``target``.

    A null text has no features and weight 0. Of the rows with ``least_words`` words or more, ``percent`` in a hundred (rounded down)
    get a rank; equal scores go to the smaller id, null ids come last; repeated rows take part each. An empty target counts as one
    feature in every bucket; empty ``docs`` give no rows. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    rows = weighted(docs, gain, longest, seed, id_col, text_col)
    rows = settle(rows.withColumn("eligible", F.col("n_words") >= least_words), "importance")
    k = rows.filter("eligible").count() * percent // 100
    return ranked(rows, k).select("doc_id", "n_features", "weight", "score", "rank")
