"""Quality classifier on learned subword vectors.

A document is the mean of the vectors of its features: words, and character n-grams of words with their borders, all hashed into a
fixed number of buckets, and a mark for a word that repeats the one before. A softmax layer reads the mean. Vectors and layer are
learned together by stochastic gradient descent in numpy on a bounded sample of labelled documents. As the layer is linear, each
bucket's vector is multiplied by it once after training, so scoring adds up one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import fold, fresh, in_blocks, ship

#: log2 of the buckets for words and for n-grams; n-gram lengths in bytes; vector length.
BITS, GRAMS, SIZE = 16, (3, 4), 8
#: The training sample: documents, and characters of each (longer ones: a window at a hashed place).
SAMPLE_DOCS, SAMPLE_CHARS, ROWS_OF_ID = 2400, 8000, 4
EPOCHS, RATE, SEED, ACCEPT = 6, 0.5, 11, 0.7
PART_BYTES = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
AGAIN = (1 + len(GRAMS)) << BITS
BUCKETS = AGAIN + 1
#: An odd multiplier and its powers' inverses hash words of any length in one running sum.
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


class Model(NamedTuple):
    weight: np.ndarray  # per bucket, what it adds to the logit of class 1 over class 0
    bias: float
    learned: bool = True  # False: there was no usable label


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(count + 1, BASE, np.uint64), np.full(count + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def features(data: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(byte position, bucket) of all features of texts that lie one after the other in ``data``; ``edges`` are their ends."""
    n = len(data)
    if not n:
        return
    space = SPACE[data]
    begins = np.zeros(n + 1, bool)
    begins[edges[edges < n]] = True
    begins[0] = True
    letter = ~space
    first = letter & (begins[:n] | np.concatenate([[True], space[:-1]]))
    final = letter & (begins[1:] | np.concatenate([space[1:], [True]]))
    final[-1] = letter[-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        running = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n])])
        words = (running[ends] - running[starts]) * down[starts]
        yield starts, ((words * MIX) >> np.uint64(64 - BITS)).astype(np.int64)
    if len(words) > 1:
        doc = np.searchsorted(edges, starts, "right")
        same = np.flatnonzero((words[1:] == words[:-1]) & (doc[1:] == doc[:-1])) + 1
        yield starts[same], np.full(len(same), AGAIN)
    folded = np.where(space, np.uint8(32), data).astype(np.uint64)
    for k, length in enumerate(GRAMS):
        if n < length:
            continue
        packed, ok = folded[:n - length + 1].copy(), np.ones(n - length + 1, bool)
        for i in range(1, length):
            packed = (packed << np.uint64(8)) | folded[i:n - length + 1 + i]
            ok &= ~begins[i:n - length + 1 + i]  # within one text
            if i < length - 1:
                ok &= letter[i:n - length + 1 + i]  # white space at the ends only: the border of a word
        at = np.flatnonzero(ok)
        with np.errstate(over="ignore"):
            yield at, ((packed[at] * MIX) >> np.uint64(64 - BITS)).astype(np.int64) + ((k + 1) << BITS)


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probability of class 1 for each text."""
    out, start = [], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (size < PART_BYTES or stop == start):
            size += len(texts[stop])
            stop += 1
        data, edges = _flat(texts[start:stop])
        total, count = np.zeros(stop - start), np.zeros(stop - start)
        owner = np.repeat(np.arange(stop - start), np.diff(edges, prepend=0))
        for at, bucket in features(data, edges):
            doc = owner.take(at)
            total += np.bincount(doc, model.weight.take(bucket), stop - start)
            count += np.bincount(doc, minlength=stop - start)
        out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -30, 30))))
        start = stop
    return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Stochastic gradient descent, one document a step, the rate falling to zero. The same sample gives the same model."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE))
    layer, bias = np.zeros((SIZE, 2)), np.zeros(2)
    if labels:
        bias += np.log((np.bincount(labels, minlength=2) + 1) / (len(labels) + 2))
    rows = []
    for text in texts:
        found = [b for _, b in features(*_flat([text]))]
        bucket, count = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        rows.append((bucket, count / max(1, count.sum())))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            bucket, share = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[bucket]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            # The mean spreads a step over all of a text's features; as many steps again make up for it.
            vectors[bucket] -= (rate * np.minimum(1.0, 100 * share))[:, None] * back
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]), bool(labels))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from at most SAMPLE_DOCS labelled documents outside the held-out fold, drawn by hashes of id and text.

    What reaches the driver is bounded whatever repeats: repeated labels and equal rows are collapsed, at most twice SAMPLE_DOCS ids
    are drawn, and ROWS_OF_ID rows of each.
    """
    ship(docs.sparkSession)
    learn = (labels.filter((fold(id_col, 4) != 2) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y")))
    span, n = 1 << 30, learn.count()
    draw = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(span))
    drawn = learn.withColumn("draw", draw).filter(F.col("draw") < F.lit(min(span, span * 5 * SAMPLE_DOCS // (4 * max(n, 1)))))
    drawn = drawn.distinct().orderBy("draw", "key", "y").limit(2 * SAMPLE_DOCS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.pmod(F.col("draw"), F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    rows = (docs.join(F.broadcast(drawn), F.col(id_col) == F.col("key"))
            .select("draw", "key", "y", F.xxhash64("key", text).alias("h"), F.substr(text, place.cast("int"), F.lit(SAMPLE_CHARS)).alias("t")))
    # Spark cuts each task's rows of an id before they are shuffled.
    order = F.row_number().over(Window.partitionBy("key", "y").orderBy("h"))
    rows = rows.withColumn("k", order).filter(F.col("k") <= ROWS_OF_ID).drop("k").distinct().collect()
    rows = sorted(rows, key=lambda r: (r.draw, str(r.key), r.y, r.t))[:SAMPLE_DOCS]
    return fit([r.t.encode() for r in rows], [r.y for r in rows])


def score(model: Model, text: Column) -> Column:
    """Score of a text column; null counts as empty."""
    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for one in in_blocks(columns, lambda part: [scores(model, [t.encode() for t in part.to_pylist()])], pa.struct([("s", pa.float64())])):
            yield one.field(0)

    return scored(text)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score and verdict of every row of ``docs``, from the text alone.

    A null or empty text has no features and gets the score of the bias alone; without any usable label every score is 0.5. A null id
    counts as the empty text for the fold; repeated rows stay; other columns are not read.
    """
    ship(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 4) == 2).alias("held_out"), score(model, F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= ACCEPT).cast("int")))


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns; all rows if it had no usable label to learn from."""
    if not model.learned:
        return docs
    ship(docs.sparkSession)
    tag = fresh(docs.columns, "score")
    return docs.withColumn(tag, score(model, F.col(text_col))).filter(F.col(tag) >= ACCEPT).select(*[F.col(f"`{c}`") for c in docs.columns])
