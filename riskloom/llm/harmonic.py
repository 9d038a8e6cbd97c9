"""Harmonic packing: pieces in reciprocal-capacity classes, a fixed number of pieces to each bin of a class.

A text's ids are cut into full sequences and a rest; the rest is cut into lengths capacity/2, capacity/4, ... (one of each at
most). Class k holds the lengths capacity/k, k a power of two, and k pieces of it fill a bin exactly, so every worker packs its own
rows without looking at others and without padding. What is left open at the end of a task, under one bin per class, is laid out
longest first: power-of-two lengths fill whole sequences in that order, and the last open one is ended at powers of two.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship, slices
from riskloom.llm.prefix_bpe import Units

TOKENIZER, CAPACITY, END = "byte_bpe_50k.json", 2048, 1
#: Bits of a sequence id below the task's number.
TASK_BITS = 36


class Encoder:
    """Ids of texts by the tokenizers library, as little-endian 32-bit bytes. Units are encoded once, many in one call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self.units = Units(self._encode)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str], words: bool, together: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            ids = self._ids(texts)
            return np.concatenate(ids), np.array([len(i) for i in ids])
        # Words after a space, many in one text: each starts at a token that starts with a space, and no other token does.
        groups = self._ids(["".join(texts[i:i + together]) for i in range(0, len(texts), together)])
        ids = np.concatenate(groups)
        starts = np.flatnonzero(self.spaced[ids])
        assert len(starts) == len(texts)
        return ids, np.diff(np.append(starts, len(ids)))


def cuts(tokens: int, capacity: int) -> Iterator[int]:
    """Lengths of a text's pieces in order: full sequences, then the powers of two of the rest, longest first."""
    yield from [capacity] * (tokens // capacity)
    rest, part = tokens % capacity, capacity
    while rest:
        part //= 2
        if rest >= part:
            yield part
            rest -= part


class Bins:
    """Open bins of one task. A piece is a tuple whose last two places, sequence and offset, are filled in here."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}

    def _sequence(self, pieces: list[tuple], length: int) -> list[tuple]:
        number, self.next = self.next, self.next + 1
        return [(*p, number, i * length) for i, p in enumerate(pieces)]

    def add(self, piece: tuple, length: int) -> list[tuple]:
        """The pieces this one completes a bin with, if it does."""
        waiting = self.open.setdefault(length, [])
        waiting.append(piece)
        if len(waiting) < self.capacity // length:
            return []
        self.open[length] = []
        return self._sequence(waiting, length)

    def close(self) -> list[tuple]:
        """Open pieces, longest first, into sequences; the last one is ended wherever its fill is about to pass a power of two."""
        out, fill, number = [], 0, self.next
        left = [(n, p) for n in sorted(self.open, reverse=True) for p in self.open[n]]
        total = sum(n for n, _ in left)
        room = self._room(total)
        for n, piece in left:
            if fill == room:
                total, fill, number = total - room, 0, number + 1
                room = self._room(total)
            out.append((*piece, number, fill))
            fill += n
        self.next, self.open = number + 1, {}
        return out

    def _room(self, total: int) -> int:
        """The next sequence's length: the capacity, or else the largest power of two that the rest fills."""
        return self.capacity if total >= self.capacity else 1 << max(0, total.bit_length() - 1)


@functools.cache
def encoder(name: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(public_tokenizers.path(name))


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end: int = END, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row for each piece: its place in its document and in its sequence, and the crc32 of its ids.

    Every id, the end id after each text included, lies in exactly one piece. A null or empty text is the end id alone. A null
    id stays null; repeated rows are packed each; other columns are not read. Each task packs its own rows: nothing is shuffled,
    and sequence ids are the task's number and a counter, so a task that runs again gives the same rows. ``capacity`` must be a
    power of two.
    """
    ship(docs.sparkSession)
    if capacity & (capacity - 1):
        raise ValueError("The capacity must be a power of two")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId() << TASK_BITS)
        stop = np.array([end], "<u4").tobytes()
        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            for texts in next(slices([batch.column(1)]))[1]:
                rows: list[tuple] = []
                ids, edges = encoder(tokenizer).units.tokens(texts)
                ids = ids.astype("<u4").tobytes()
                for a, b in zip((4 * edges).tolist(), (4 * edges[1:]).tolist()):
                    raw = ids[a:b] + stop
                    doc_id, tokens, start = doc_ids[at], len(raw) // 4, 0
                    at += 1
                    for n in cuts(tokens, capacity):
                        crc = zlib.crc32(raw[4 * start:4 * (start + n)])
                        rows += bins.add((doc_id, start, n, crc, tokens), n)
                        start += n
                yield from _batch(rows)
        yield from _batch(bins.close())

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(pack, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)
