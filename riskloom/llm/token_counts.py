"""Exact token counts at every prefix of a text, without encoding it again for each question."""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_blocks, ship
from riskloom.llm.prefix_bpe import PieceEncoder, Prefixes, Splitter, Units, Vocabulary

TOKENIZER, LIMIT = "byte_bpe_50k.json", 1024


class Counter:
    """Counts of a byte-level tokenizer file. Its added tokens, where a text spells them, are one token each."""

    def __init__(self, path: str):
        self.v, added = Vocabulary.from_json(path)
        self.split, self.prefixes = Splitter(public_tokenizers.PATTERN), Prefixes(self.v)
        self.added = frozenset(added)
        self.cutter = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.units = Units(PieceEncoder(self.v, lambda text: list(self.pieces(text)), self.added))

    def pieces(self, text: str) -> Iterator[str]:
        for part in self.cutter.split(text) if self.cutter else [text]:
            if part in self.added:
                yield part
            elif part:
                yield from self.split(part)

    def measures(self, texts: pa.Array, limit: int = LIMIT):
        """Bytes, tokens, whether over the limit, and the bytes the first ``limit`` tokens hold: an array of each.

        Tokens of whole units are the last entries of their prefix tables; only in the unit that the limit falls into are the
        entries within looked up.
        """
        numbers, offsets = self.units.column(texts)
        counts = self.units.ends[numbers + 1] - self.units.ends[numbers]
        running = np.concatenate([[0], np.cumsum(counts)])
        tokens = running[offsets[1:]] - running[offsets[:-1]]
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        held = size.copy()
        for doc in np.flatnonzero(tokens > limit):
            text = texts[int(doc)].as_py()
            units = text.split(" ") if offsets[doc + 1] - offsets[doc] > 1 else [text]
            whole = int(np.searchsorted(running[offsets[doc]:offsets[doc + 1] + 1], running[offsets[doc]] + limit, "right")) - 1
            left = limit - int(running[offsets[doc] + whole] - running[offsets[doc]])
            rest = (" " if whole else "") + units[whole]
            held[doc] = len(" ".join(units[:whole]).encode()) + self.table(rest).first(left)
        return size, tokens, tokens > limit, held

    def piece(self, piece: str) -> int:
        return 1 if piece in self.added else Prefixes(self.v, piece.encode()).count[-1]

    def table(self, text: str) -> Table:
        return Table(self, text)


class Table:
    """Token counts of every prefix of one text: a running count per piece, and the prefix counts within each piece."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text = counter, text
        self.pieces = list(counter.pieces(text))
        self.ends = list(accumulate(len(p.encode()) for p in self.pieces))
        self.within, counts = [], []
        for piece in self.pieces:
            if piece in counter.added:
                self.within.append(None)
                counts.append(1)
            else:
                prefixes = Prefixes(counter.v, piece.encode())
                self.within.append(prefixes)
                counts.append(prefixes.count[-1])
        self.counts = list(accumulate(counts))

    def first(self, tokens: int) -> int:
        """Bytes that the first ``tokens`` tokens hold."""
        k = bisect_right(self.counts, tokens)
        at, left = (self.ends[k - 1], tokens - self.counts[k - 1]) if k else (0, tokens)
        if k == len(self.pieces) or not left or self.within[k] is None:
            return at
        v = self.counter.v
        return at + sum(len(v.tokens[t]) for t in self.within[k].tokens()[:left])

    def count(self, size: int) -> int:
        """Tokens of the text's first ``size`` bytes, taken as a text of their own.

        Pieces that end before the last two the prefix touches are as in the whole text, as a piece looks one character ahead at
        most. The rest is split again, and its prefix counts taken from the stored pieces where they are the same.
        """
        k = max(0, bisect_right(self.ends, size) - 2)
        at, before = (self.ends[k - 1], self.counts[k - 1]) if k else (0, 0)
        total = before
        for piece in self.counter.pieces(self.text.encode()[at:size].decode("utf-8", "ignore")):
            stored = self.within[k] if k < len(self.within) else None
            raw = piece.encode()
            total += stored.count[len(raw)] if stored and stored.data.startswith(raw) else self.counter.piece(piece)
            k += 1
        return total


@functools.cache
def counter(name: str) -> Counter:
    """One counter for each worker process."""
    return Counter(public_tokenizers.path(name))


MEASURES = pa.struct([("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("limit_bytes", pa.int64())])


def token_counts(docs: DataFrame, limit: int = LIMIT, tokenizer: str = TOKENIZER, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Bytes, exact tokens, whether there are more than ``limit``, and the bytes the first ``limit`` tokens hold.

    One row for each row of ``docs``. A null or empty text has 0 bytes and 0 tokens; null ids and repeated rows stay; other
    columns are not read. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    @F.arrow_udf("struct<n_bytes:bigint,n_tokens:bigint,over_limit:boolean,limit_bytes:bigint>")
    def measures(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_blocks(columns, lambda texts: counter(tokenizer).measures(texts, limit), MEASURES)

    return docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m")).select("doc_id", "m.*")
