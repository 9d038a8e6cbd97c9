"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a word after its predecessor, of the word alone, and a uniform floor. The weights
depend on how often the predecessor occurs, in buckets of powers of two, and are learned by expectation-maximisation on counts of
documents whose own counts are deleted from the estimates; the final estimates use all learning documents.

Texts are read once, into blocks: the distinct words of some megabytes of text and its tokens as numbers. Counts are exact over all
learning documents: each block sends its distinct words and word pairs with their counts, pre-aggregated, to buckets of their hashes,
and gets the totals back in the same order. A word or pair that fills a third of all text is one entry of a block like any other.
Words go by 64 hash bits; pairs by 40 bits within their bucket, and the number of buckets follows the input, so the share of pairs
that meet by chance (about one in a million) does not grow with it. Rows that travel are as many as blocks times buckets: for very
large inputs give larger blocks and buckets, which cost memory in proportion.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.common import fold, ship, slices
from riskloom.session import settle

FOLDS, TEST, DELETED = 7, 2, 3
#: Bytes of text in a block, tokens in a bucket.
BLOCK, BUCKET_TOKENS = 4 << 20, 2_000_000
LEVELS, ROUNDS = 24, 8
#: Hashes of the two marks, as if they were words; no word has white space.
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(m)) for m in (b" end", b" begin"))
WORD_BITS, PAIR_BITS = 64, 40


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words by falling frequency, the words of all texts as places in them, and each text's number of words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = split.offsets.to_numpy().astype(np.int64)
    words = split.values.slice(offsets[0], offsets[-1] - offsets[0])
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    counts = np.diff(before[offsets - offsets[0]])
    coded = words.filter(real).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w.as_buffer()) for w in coded.dictionary], np.uint64)
    uses = np.bincount(coded.indices.to_numpy(), minlength=len(hashes))
    order = np.argsort(-uses, kind="stable")  # frequent words first: small numbers
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return hashes[order], place[coded.indices.to_numpy()].astype(np.int32), counts


class Grams:
    """Distinct words and word pairs of a block, sorted by hash, and where each token finds its own."""

    def __init__(self, words: bytes, places: bytes, counts: list[int]):
        words, places = np.frombuffer(words, np.uint64), unpacked(places)
        sizes = np.array(counts, np.int64)
        n = int(sizes.sum()) + len(sizes)
        self.edges = np.concatenate([[0], np.cumsum(sizes + 1)])
        current = np.full(n, len(words), np.int64)  # the end mark
        inner = np.ones(n, bool)
        inner[self.edges[1:] - 1] = False
        current[inner] = places
        previous = np.empty(n, np.int64)
        previous[1:] = current[:-1]
        previous[self.edges[:-1]] = len(words) + 1  # the begin mark
        hashes = np.concatenate([words, [END, BEGIN]])
        self.words, back = np.unique(hashes[:-1], return_inverse=True)
        self.token = back[current]
        # The begin mark stands before as many tokens as there are ends.
        self.context = np.append(back, back[-1])[previous]
        with np.errstate(over="ignore"):
            keys = _mix(hashes[previous] * np.uint64(0x9E3779B97F4A7C15) + _mix(hashes[current]))
        self.pairs, self.pair = np.unique(keys, return_inverse=True)
        self.doc = np.repeat(np.arange(len(sizes)), sizes + 1)


def _filled(words: np.ndarray, pairs: np.ndarray, bits: int) -> Iterator[tuple[int, slice, slice]]:
    """The buckets that hold any of these sorted keys, with their words and pairs: a bucket is the leading bits."""
    heads = [keys >> np.uint64(64 - bits) for keys in (words, pairs)]
    buckets = np.union1d(*heads)
    edges = [np.searchsorted(head, buckets, side).tolist() for head in heads for side in ("left", "right")]
    for bucket, w, w_end, p, p_end in zip(buckets.tolist(), *edges):
        yield bucket, slice(w, w_end), slice(p, p_end)


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes as the largest needs, byte by byte, compressed."""
    wide = np.ascontiguousarray(numbers, "<u8")
    width = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    raw = wide.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    width, size = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[9:], size), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _sent(keys: np.ndarray, bits: int, wanted: int) -> bytes:
    """Sorted keys of one bucket: differences of the ``wanted`` hash bits (bucket's own left out)."""
    left = (keys << np.uint64(bits)) >> np.uint64(64 - min(wanted, 64 - bits))
    return packed(np.diff(left, prepend=np.uint64(0)))


def _received(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw))


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), fold(id_col, FOLDS).cast("int").alias("fold"))
    kind = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(source.schema["doc_id"].dataType)),
                         T.StructField("folds", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
                         T.StructField("tokens", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("places", T.BinaryType())])
    arrow = to_arrow_schema(kind)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for texts in next(slices([batch.column(1)], block_bytes))[1]:
                folds = batch.column(2).slice(at, len(texts)).to_numpy(zero_copy_only=False)
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                for deleted in (False, True):  # documents of the deleted part are blocks of their own, with odd numbers
                    rows = pa.array(np.flatnonzero((folds == DELETED) == deleted))
                    if not len(rows):
                        continue
                    words, places, counts = tokenised(texts.take(rows))
                    values = [number + deleted, ids.take(rows).to_pylist(), folds[rows.to_numpy()].tolist(), counts.tolist(),
                              int(counts.sum()) + len(rows), words.tobytes(), packed(places)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)
                number += 2

    return settle(source.mapInArrow(cut, kind), "lm-blocks")


@contextmanager
def _few_rows(spark: SparkSession, rows: int = 2):
    """Blocks are rows of megabytes: a batch of two keeps what lies between the executor and Python small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def _requests(blocks: DataFrame, bits: int) -> DataFrame:
    """A row for each block and bucket: its distinct words and pairs, with their counts in learning documents."""
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                g = Grams(r["words"], r["places"], r["counts"])
                learn = (np.array(r["folds"]) != TEST)[g.doc]
                words, pairs = (np.bincount(at[learn], minlength=len(keys)) for at, keys in ((g.token, g.words), (g.pair, g.pairs)))
                for b, ws, ps in _filled(g.words, g.pairs, bits):
                    yield pa.RecordBatch.from_pydict({
                        "bucket": pa.array([b], pa.int32()), "block": pa.array([r["block"]], pa.int64()),
                        "words": pa.array([_sent(g.words[ws], bits, WORD_BITS)], pa.binary()),
                        "pairs": pa.array([_sent(g.pairs[ps], bits, PAIR_BITS)], pa.binary()),
                        "word_counts": pa.array([packed(words[ws])], pa.binary()), "pair_counts": pa.array([packed(pairs[ps])], pa.binary())})

    return blocks.select("block", "folds", "counts", "words", "places").mapInArrow(
        ask, "bucket int, block long, words binary, pairs binary, word_counts binary, pair_counts binary")


def _totals(keys: list[np.ndarray], counts: list[bytes], deleted: list[bool]) -> tuple[list[bytes], np.ndarray]:
    """Totals for each sender's keys, in its order, and the totals of the distinct keys, of kept and of deleted documents.

    A block of the deleted part is told both totals, any other their sum.
    """
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    back = np.split(back, np.cumsum([len(k) for k in keys])[:-1])
    sums = np.zeros((2, len(distinct)), np.int64)
    for at, count, of_deleted in zip(back, counts, deleted):
        np.add.at(sums[int(of_deleted)], at, unpacked(count).astype(np.int64))
    total = sums.sum(axis=0)
    return [packed(sums[:, at].ravel() if of_deleted else total[at]) for at, of_deleted in zip(back, deleted)], sums


def _answers(requests: DataFrame) -> DataFrame:
    """Totals for every request; in row -1 of a bucket its distinct words and tokens of kept and of all learning documents."""
    kind = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("word_counts", pa.binary()), ("pair_counts", pa.binary()),
                      ("kept", pa.int64()), ("learned", pa.int64()), ("distinct", pa.int64())])

    def add(table: pa.Table) -> pa.Table:
        raw = {n: table.column(n).to_pylist() for n in table.column_names}
        deleted = [b % 2 == 1 for b in raw["block"]]
        words, sums = _totals([_received(w) for w in raw["words"]], raw["word_counts"], deleted)
        pairs, _ = _totals([_received(p) for p in raw["pairs"]], raw["pair_counts"], deleted)
        n = len(words)
        total = sums.sum(axis=0)
        return pa.table({"block": pa.array([*raw["block"], -1], pa.int64()), "bucket": pa.array([*raw["bucket"], raw["bucket"][0]], pa.int32()),
                         "word_counts": pa.array([*words, b""], pa.binary()), "pair_counts": pa.array([*pairs, b""], pa.binary()),
                         "kept": pa.array([0] * n + [int(sums[0].sum())]), "learned": pa.array([0] * n + [int(total.sum())]),
                         "distinct": pa.array([0] * n + [int((total > 0).sum())])}, schema=kind)

    counted = requests.groupBy("bucket").applyInArrow(add, "block long, bucket int, word_counts binary, pair_counts binary, kept long, learned long, distinct long")
    return settle(counted, "lm-counts")


def _joined(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    told = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "word_counts", "pair_counts")).alias("told"))
    # Block numbers are unique, and a block's totals are small beside it: hash those, and the large rows are not sorted.
    return blocks.join(told.hint("shuffle_hash"), "block")


def _counts(r: dict, g: Grams, kept_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: counts of its pair, of its context and of itself."""
    out = []
    for name in ("word_counts", "pair_counts"):
        parts = [unpacked(t[name]).astype(np.int64) for t in sorted(r["told"], key=lambda t: t["bucket"])]
        if r["block"] % 2:
            parts = [p.reshape(2, -1)[0] if kept_only else p.reshape(2, -1).sum(axis=0) for p in parts]
        out.append(np.concatenate(parts))
    return out[1][g.pair], out[0][g.context], out[0][g.token]


def _level(context: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for unseen, then by powers of two."""
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), LEVELS - 1)


def _estimates(pair, context, word, tokens: int, distinct: int) -> np.ndarray:
    """The three estimates for each token: after its predecessor, alone, uniform."""
    return np.stack([pair / np.maximum(context, 1), word / max(tokens, 1), np.full(len(word), 1 / (distinct + 1))])


def _evidence(joined: DataFrame, kept: int, distinct: int) -> DataFrame:
    """Estimates of the deleted part's tokens from kept counts, equal ones together with their number."""
    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                g = Grams(r["words"], r["places"], r["counts"])
                triples, times = np.unique(np.stack(_counts(r, g, True)), axis=1, return_counts=True)
                p = _estimates(*triples, kept, distinct)
                yield pa.RecordBatch.from_pydict({"level": pa.array([_level(triples[1]).astype(np.int8).tobytes()], pa.binary()),
                                                  "estimates": pa.array([p[:2].tobytes()], pa.binary()),
                                                  "times": pa.array([times.astype(np.int64).tobytes()], pa.binary())})

    return settle(joined.select("block", "words", "places", "counts", "told").mapInArrow(gather, "level binary, estimates binary, times binary"), "lm-evidence")


def learn_weights(evidence: DataFrame, distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights (LEVELS, 3) by expectation-maximisation: each round adds up the parts' shares over all tokens, and one each."""
    weights = np.full((LEVELS, 3), 1 / 3)
    for _ in range(rounds):
        now = weights

        def shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((LEVELS, 3))
            for batch in batches:
                for r in _rows(batch):
                    level, times = np.frombuffer(r["level"], np.int8), np.frombuffer(r["times"], np.int64)
                    two = np.frombuffer(r["estimates"], np.float64).reshape(2, -1)
                    p = np.concatenate([two, np.full((1, len(level)), 1 / (distinct + 1))]) * now[level].T
                    p *= times / p.sum(axis=0)
                    for j in range(3):
                        total[:, j] += np.bincount(level, p[j], LEVELS)
            yield pa.RecordBatch.from_pydict({"level": pa.array(range(LEVELS), pa.int32()), **{f"s{j}": pa.array(total[:, j]) for j in range(3)}})

        sums = (evidence.mapInArrow(shares, "level int, s0 double, s1 double, s2 double").groupBy("level")
                .agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(3)]).collect())
        found = np.ones((LEVELS, 3))
        for s in sums:
            found[s["level"]] += (s.s0, s.s1, s.s2)
        weights = found / found.sum(axis=1, keepdims=True)
    return weights


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK,
              bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Tokens, known tokens, add-one unigram score and interpolated score (log10) of every row of ``docs``.

    A null or empty text is its end alone. A null id counts as the empty text for the folds; repeated rows count as often as they
    occur; other columns are not read; with nothing to learn from, only the uniform floor is left.
    """
    ship(docs.sparkSession)
    blocks = _blocks(docs, id_col, text_col, block_bytes)
    with _few_rows(docs.sparkSession):
        return _scores(blocks, docs.schema[id_col].dataType, bucket_tokens)


def _scores(blocks: DataFrame, id_type: T.DataType, bucket_tokens: int) -> DataFrame:
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    bits = max(3, int(tokens // bucket_tokens).bit_length())
    answers = _answers(_requests(blocks, bits))
    told = answers.filter("block >= 0")
    kept, learned, distinct = answers.filter("block < 0").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("kept", "learned", "distinct")]).first()
    deleted = _joined(blocks.filter("block % 2 = 1"), told.filter("block % 2 = 1"))
    weights = learn_weights(_evidence(deleted, kept, distinct), distinct)
    kind = T.StructType([T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()),
                         *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
                         T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(kind)

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                g = Grams(r["words"], r["places"], r["counts"])
                pair, context, word = _counts(r, g, False)
                parts = weights[_level(context)]
                p = parts[:, 0] * (pair / np.maximum(context, 1)) + parts[:, 1] * (word / max(learned, 1)) + parts[:, 2] / (distinct + 1)
                n = len(r["ids"])
                per_doc = lambda x: np.bincount(g.doc, x, n)
                values = [r["ids"], [f == TEST for f in r["folds"]], np.diff(g.edges), per_doc(word > 0).astype(np.int64),
                          np.full(n, learned), per_doc(np.log10((word + 1) / (learned + distinct + 1))), per_doc(np.log10(p))]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)

    rated = _joined(blocks, told).select("block", "ids", "folds", "counts", "words", "places", "told").mapInArrow(rate, kind)
    return settle(rated, "lm-scores")
