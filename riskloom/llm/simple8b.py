"""Token ids as word-aligned binary files: Simple-8b words, block offsets, documents in id order.

A file is a run of frames; a frame holds whole documents. Everything in it is little-endian 64-bit words:

    magic, id kind, part, ids before it in its part, documents, ids, blocks, words of each section
    document ids: 64-bit integers, or coded lengths and UTF-8 text; a bitmap of null ids
    coded token counts of the documents
    coded words of each block: the running sum is the block's offset
    the blocks: 1024 ids each, every block from a new word
    last word: crc32 of all before it, three letters, and the line feed that Spark's text writer puts after each row

So frames are written by Spark's own writer, with its commit protocol, to any store it reaches, and read by its binary file source.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import fresh, ship, slices
from riskloom.llm.harmonic import Encoder
from riskloom.llm.prefix_bpe import Units
from riskloom.session import settle, shared_path

TOKENIZER, END = "byte_bpe_50k.json", 2

# fixed values: values and bits of each selector; the last one is the escape, a single value of up to 60 bits
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BLOCK = 1024
#: A block and the zeros behind it, so that no selector looks past its block.
STRIDE = BLOCK + int(COUNTS[0])
#: Ids after which a frame is closed, and frames to a file (about 16 MB).
FRAME_IDS, FILE_FRAMES = 1 << 16, 128
MAGIC, LETTERS = b"S8FRAME1", b"S8B"
HEADER = 11
#: Units (words with the space before them) a worker remembers.
MAX_UNITS = 800_000

_LIMITS = np.uint64(1) << WIDTHS[1:-1].astype(np.uint64)  # values below the k-th fit selector k + 1
_CLASS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _classes(values: np.ndarray) -> np.ndarray:
    """For each value, how many of the selectors' limits it reaches."""
    if values.max(initial=0) < len(_CLASS):
        return _CLASS[values]
    return np.searchsorted(_LIMITS, values.astype(np.uint64), "right").astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values (below 2^60), and how many words each block of 1024 values takes."""
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros((blocks, STRIDE), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:len(values)] = values
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    padded = padded.reshape(-1)
    # The highest class within the next n values, for each n in rising order; wider windows only while any of them fits.
    top, size, best = _classes(padded), 1, np.full(len(padded), len(COUNTS) - 1, np.uint8)
    for s in range(len(COUNTS) - 2, -1, -1):
        shift = int(COUNTS[s]) - size
        wider = top.copy()
        np.maximum(top[:-shift], top[shift:], out=wider[:-shift])
        top, size = wider, int(COUNTS[s])
        fits = top <= max(s - 1, 0)
        if not fits.any():
            break
        best[fits] = s
    step, starts = COUNTS[best].tolist(), []
    for first in range(0, len(padded), STRIDE):
        at, stop = first, first + min(BLOCK, len(values) - first // STRIDE * BLOCK)
        while at < stop:
            starts.append(at)
            at += step[at]
    starts = np.array(starts, np.int64)
    selector = best[starts]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        rows, width = np.flatnonzero(selector == s), int(WIDTHS[s])
        if width:
            own, packed = starts[rows], np.zeros(len(rows), np.uint64)
            # Behind the last place of the array there are only zeros.
            for k in range(int(COUNTS[s])):
                packed |= padded[np.minimum(own + k, len(padded) - 1)] << np.uint64(k * width)
            words[rows] |= packed
    return words, np.bincount(starts // STRIDE, minlength=blocks)


def decode(words: np.ndarray, per_block: np.ndarray, length: int) -> np.ndarray:
    """The values of consecutive blocks: their words, how many words each has, and how many values there are."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts, first = COUNTS[selector], np.cumsum(per_block) - per_block
    begin = np.cumsum(counts) - counts
    filled = first < len(words)
    begin += np.repeat(np.arange(len(per_block))[filled] * STRIDE - begin[first[filled]], per_block[filled])
    out = np.zeros(len(per_block) * STRIDE + int(COUNTS[0]), np.uint64)
    for s in np.unique(selector):
        width = int(WIDTHS[s])
        if width:
            rows, mask = np.flatnonzero(selector == s), np.uint64((1 << width) - 1)
            own, at = words[rows], begin[rows]
            for k in range(int(COUNTS[s])):
                out[at + k] = (own >> np.uint64(k * width)) & mask
    return out[:len(per_block) * STRIDE].reshape(-1, STRIDE)[:, :BLOCK].reshape(-1)[:length]


def _coded(values: np.ndarray) -> bytes:
    """A short list of values: its block sizes, its words."""
    words, per_block = encode(values)
    return np.concatenate([per_block.astype(np.uint64), words]).astype("<u8").tobytes()


def _read_coded(words: np.ndarray, length: int) -> np.ndarray:
    blocks = -(-length // BLOCK)
    return decode(words[blocks:], words[:blocks].astype(np.int64), length).astype(np.int64)


def frame(doc_ids: list, counts: np.ndarray, ids: np.ndarray, part: int, before: int) -> bytes:
    """One frame of whole documents, without the line feed that the writer adds. ``doc_ids`` are integers or texts, or null."""
    as_text = any(isinstance(d, str) for d in doc_ids)
    nulls = np.packbits(np.array([d is None for d in doc_ids], bool), bitorder="little").tobytes()
    if as_text:
        raw = [(d or "").encode() for d in doc_ids]
        name = _coded(np.array([len(r) for r in raw], np.uint64)) + _whole(b"".join(raw))
    else:
        name = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    words, per_block = encode(ids)
    sections = [name, _whole(nulls), _coded(counts.astype(np.uint64)), _coded(per_block.astype(np.uint64)), words.astype("<u8").tobytes()]
    head = np.array([int(as_text), part, before, len(doc_ids), len(ids), *[len(s) // 8 for s in sections]], "<i8").tobytes()
    body = MAGIC + head + b"".join(sections)
    return body + zlib.crc32(body).to_bytes(4, "little") + LETTERS


def _whole(raw: bytes) -> bytes:
    """Bytes up to a whole number of words."""
    return raw + bytes(-len(raw) % 8)


class Frame:
    """A frame read back. Ids are decoded on demand, by blocks."""

    def __init__(self, data: memoryview):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("No frame starts here")
        head = np.frombuffer(data[8:8 * HEADER], "<i8")
        self.part, self.before, self.documents, self.length = (int(x) for x in head[1:5])
        edges = HEADER + np.concatenate([[0], np.cumsum(head[5:])])
        self.size = 8 * int(edges[-1]) + 8
        tail = bytes(data[self.size - 8:self.size])
        if len(tail) != 8 or tail[4:] != LETTERS + b"\n" or zlib.crc32(data[:self.size - 8]) != int.from_bytes(tail[:4], "little"):
            raise ValueError("A frame is damaged or cut off")
        name, nulls, counts, per_block, self.words = (np.frombuffer(data[8 * a:8 * b], "<u8") for a, b in zip(edges, edges[1:]))
        null = np.unpackbits(nulls.view(np.uint8), count=self.documents, bitorder="little").astype(bool)
        self.counts = _read_coded(counts, self.documents)
        self.per_block = _read_coded(per_block, -(-self.length // BLOCK))
        self.offsets = np.concatenate([[0], np.cumsum(self.per_block)])
        if head[0]:
            blocks = -(-self.documents // BLOCK)
            used = blocks + int(name[:blocks].sum())
            ends = np.cumsum(_read_coded(name[:used], self.documents))
            raw, starts = name[used:].tobytes(), np.concatenate([[0], ends])
            self.doc_ids = [None if n else raw[a:b].decode() for n, a, b in zip(null, starts, ends)]
        else:
            self.doc_ids = [None if n else d for n, d in zip(null, name.view("<i8").tolist())]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids [start, stop) of the frame; only the blocks they lie in are decoded."""
        stop = self.length if stop is None else min(stop, self.length)
        if start >= stop:
            return np.zeros(0, np.uint64)
        a, b = start // BLOCK, -(-stop // BLOCK)
        words = self.words[self.offsets[a]:self.offsets[b]]
        return decode(words, self.per_block[a:b], min(b * BLOCK, self.length) - a * BLOCK)[start - a * BLOCK:stop - a * BLOCK]


def frames_of(data: memoryview) -> Iterator[Frame]:
    at = 0
    while at < len(data):
        found = Frame(data[at:])
        at += found.size
        yield found


_ENCODERS: dict[str, Encoder] = {}


def _units(tokenizer: str) -> Units:
    """One encoder for each worker process, with room for more words than elsewhere: few are met only once."""
    if tokenizer not in _ENCODERS:
        found = Encoder(public_tokenizers.path(tokenizer))
        found.units = Units(found._encode, MAX_UNITS)
        _ENCODERS[tokenizer] = found
    return _ENCODERS[tokenizer].units


def _with_end(ids: np.ndarray, edges: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the end id behind each document, and the documents' counts."""
    counts = np.diff(edges) + 1
    stops = np.cumsum(counts) - 1
    out, own = np.empty(len(ids) + len(counts), np.uint64), np.ones(len(ids) + len(counts), bool)
    own[stops] = False
    out[own], out[stops] = ids, end
    return out, counts


def write_ids(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, each with ``end`` behind it, to files under ``path``, in ascending id order (nulls last).

    Rows that share an id follow each other in the order of a hash of their text. A null or empty text is the end id alone; other
    columns are not read; an empty table gives files without frames. Ids that are not integers are stored as text. One range
    shuffle of the texts: a partition is one or more files, a part of the order; rows of one id may be spread over several.
    """
    ship(docs.sparkSession)
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    source = docs.select(F.col(id_col).cast("long" if whole else "string").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("at"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("at")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids, row = batch.column(0).to_pylist(), 0
            for texts in next(slices([batch.column(1)]))[1]:
                ids, counts = _with_end(*_units(tokenizer).tokens(texts), end)
                ends, done, out = np.cumsum(counts), 0, []
                while done < len(counts):
                    base = int(ends[done - 1]) if done else 0
                    stop = max(done + 1, int(np.searchsorted(ends, base + FRAME_IDS, "right")))
                    upto = int(ends[stop - 1])
                    out.append(frame(doc_ids[row + done:row + stop], counts[done:stop], ids[base:upto], part, before))
                    before, done = before + upto - base, stop
                row += len(counts)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    ordered.mapInArrow(write, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", FILE_FRAMES).text(path)


def _scan(spark: SparkSession, path: str, work: Callable[[Frame], Iterable[pa.Array]], schema: str) -> DataFrame:
    """``work`` on each frame of each file: columns of equal length."""
    ship(spark)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for found in frames_of(memoryview(content.as_buffer())):
                    columns = list(work(found))
                    yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))]).rename_columns(names)

    names = T._parse_datatype_string(schema).names
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, schema)


def _places(found: Frame, id_type: str) -> list[pa.Array]:
    """Id, part, place in the part and count of each document of a frame."""
    n, ends = found.documents, np.cumsum(found.counts)
    return [pa.array(found.doc_ids, pa.int64() if id_type == "long" else pa.string()), pa.array(np.full(n, found.part, np.int64)),
            pa.array(found.before + ends - found.counts), pa.array(found.counts)]


def read_ids(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Documents of files that :func:`write_ids` wrote: doc_id, part, place in the part, n_tokens, and the ids as an array."""

    def arrays(found: Frame) -> list[pa.Array]:
        edges = np.concatenate([[0], np.cumsum(found.counts)])
        return [*_places(found, id_type), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(found.ids().astype(np.int64)))]

    return _scan(spark, path, arrays, f"doc_id {id_type}, part long, place long, n_tokens long, ids array<bigint>")


def read_digests(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """As :func:`read_ids`, with the crc32 of the ids in place of the ids."""

    def digests(found: Frame) -> list[pa.Array]:
        raw = memoryview(found.ids().astype("<u4").tobytes())
        edges = (4 * np.concatenate([[0], np.cumsum(found.counts)])).tolist()
        return [*_places(found, id_type), pa.array([zlib.crc32(raw[a:b]) for a, b in zip(edges, edges[1:])], pa.int64())]

    return _scan(spark, path, digests, f"doc_id {id_type}, part long, place long, n_tokens long, ids_crc32 long")


def with_starts(documents: DataFrame) -> DataFrame:
    """``start``, the ids before a document in the whole order, in place of its part and place. The frame is read twice."""
    spark = documents.sparkSession
    totals = documents.groupBy("part").agg(F.max(F.col("place") + F.col("n_tokens")).alias("ids")).orderBy("part").collect()
    base, bases = 0, []
    for row in totals:  # one row for each part
        bases.append((row["part"], base))
        base += row["ids"]
    before = fresh(documents.columns, "before")
    table = spark.createDataFrame(bases, f"part long, {before} long")
    return documents.join(F.broadcast(table), "part").withColumn("start", F.col("place") + F.col(before)).drop("part", "place", before)


def round_trip(docs: DataFrame, **given) -> DataFrame:
    """Write the ids of ``docs`` to files in the shared folder and read them back: doc_id, start, n_tokens, ids_crc32.

    One row for each row of ``docs``; see :func:`write_ids` for nulls, repeated rows and empty tables.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "token-ids")
    write_ids(docs, path, **given)
    kind = docs.schema[given.get("id_col", "doc_id")].dataType
    found = settle(read_digests(spark, path, "long" if isinstance(kind, T.IntegralType) else "string"), "token-digests")
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")
