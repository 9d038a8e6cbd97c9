"""Byte-level BPE by dynamic programming over prefixes, and the encode/decode operator built on it.

For every prefix of a byte string there is exactly one last token its encoding can end in. With those last tokens stored, more
bytes are appended without looking back further than the longest token, any prefix's tokens are read off by walking back, and an
edit only costs the bytes until the stored tokens agree again. Sorted pieces share prefixes, so a run over sorted pieces only
computes the bytes in which neighbours differ.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_blocks, ship, slices

RANKS = "byte_bpe_50k.tiktoken"
#: Units (words with the space before them) a worker remembers, and pairs of tokens; both are emptied when full.
MAX_UNITS, MAX_PAIRS = 400_000, 400_000
_UNKNOWN = -2


#: The lowest character that Python's tables have no class for.
FIRST_OPEN = next(chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn")


class Vocabulary:
    """Tokens by rank. ``tails`` has every ending of a token: its rank, or -1 for an ending that is no token itself."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: r for r, t in enumerate(tokens)}
        self.longest = max(map(len, tokens))
        self.halves: list[tuple[int, int] | None] = [self._halves(t, r) if len(t) > 1 else None for r, t in enumerate(tokens)]
        self.tails: dict[bytes, int] = {}
        for r, t in enumerate(tokens):
            if len(t) > 1 and self.halves[r] is None:
                continue  # no merge order leads to it, so no text encodes to it
            self.tails[t] = r
            for k in range(1, len(t)):
                self.tails.setdefault(t[k:], -1)
        self.pairs: dict[tuple[int, int], bool] = {}

    @staticmethod
    def from_ranks(path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return Vocabulary([t for _, t in sorted((int(r), base64.b64decode(t)) for t, r in pairs)])

    @staticmethod
    def from_json(path: str) -> tuple[Vocabulary, list[str]]:
        """Tokens in merge order from a tokenizer file, and its added tokens."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: bytes([b]) for b, c in _printable().items()}
        decode = lambda s: b"".join(byte_of[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return Vocabulary([bytes([b]) for b in range(256)] + [decode(a + b) for a, b in merges]), [t["content"] for t in spec["added_tokens"]]

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one: its own encoding with earlier merges only."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(((self.rank.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)))
            if best[0] >= rank:
                return None
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (self.rank[parts[0]], self.rank[parts[1]]) if all(p in self.rank for p in parts) else None

    def adjacent(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens encode to these two tokens again.

        Merges on both sides of the seam are taken back, latest first; at no time may the tokens at the seam have a merge that
        would have come before the one just taken back.
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        key, before, answer = (a, b), len(self.tokens), True
        while True:
            joined = self.rank.get(self.tokens[a] + self.tokens[b])
            if joined is not None and joined < before:
                answer = False
                break
            left, right = self.halves[a], self.halves[b]
            if left is None and right is None:
                break
            if right is None or (left is not None and a > b):
                before, a = a, left[1]
            else:
                before, b = b + 1, right[0]  # of equal merges the left one, at the seam, comes first
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[key] = answer
        return answer


def _printable() -> dict[int, str]:
    """The printable character that stands for each byte in tokenizer files: itself, or the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Prefixes:
    """The last token and the token count of every prefix of a growing, editable byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data = vocabulary, b""
        self.last, self.count = [-1], [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.last)
        self.data += more
        self._fill(start, len(self.data) + 1)

    def _fill(self, start: int, stop: int) -> None:
        data, last, count, tails = self.data, self.last, self.count, self.v.tails
        pairs, adjacent = self.v.pairs, self.v.adjacent
        for i in range(start, stop):
            found, j = [], i - 1
            while j >= 0:
                r = tails.get(data[j:i])
                if r is None:
                    break
                if r >= 0:
                    found.append((j, r))
                j -= 1
            for j, r in reversed(found):
                if j == 0:
                    break
                ok = pairs.get((last[j], r))
                if ok or (ok is None and adjacent(last[j], r)):
                    break
            last.append(r)
            count.append(count[j] + 1)

    def cut(self, length: int) -> None:
        """Keep the first ``length`` bytes."""
        self.data = self.data[:length]
        del self.last[length + 1:], self.count[length + 1:]

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes [start, stop); returns how many bytes were encoded anew.

        After the edit, once as many prefixes as the longest token has bytes end in the tokens they had before, all later ones do.
        """
        tail, old = self.data[stop:], self.last[stop + 1:]
        self.cut(start)
        self.append(new)
        agree, done, base = 0, 0, len(self.data)
        self.data += tail
        while done < len(tail) and agree < self.v.longest:
            self._fill(base + done + 1, base + done + 2)
            agree = agree + 1 if self.last[-1] == old[done] else 0
            done += 1
        for k in range(done, len(tail)):
            self.last.append(old[k])
            i = base + k + 1
            self.count.append(self.count[i - len(self.v.tokens[old[k]])] + 1)
        return len(new) + done

    def tokens(self, length: int | None = None) -> list[int]:
        """Encoding of the first ``length`` bytes, by walking back from its last token."""
        i, out = len(self.data) if length is None else length, []
        while i:
            out.append(self.last[i])
            i -= len(self.v.tokens[self.last[i]])
        return out[::-1]

    def share(self, data: bytes) -> None:
        """Hold ``data`` instead, computing only what lies behind the common prefix."""
        n, own = 0, self.data
        most = min(len(own), len(data))
        while n < most and own[n] == data[n]:
            n += 1
        self.cut(n)
        self.append(data[n:])


class Splitter:
    """Cuts a text into the pieces that are encoded separately."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or max(text) < FIRST_OPEN or not any(unicodedata.category(c) == "Cn" for c in text):
            return self.find(text)
        # Characters younger than Python's own tables: ask the tokenizers library, whose tables are those of both libraries.
        from tokenizers import pre_tokenizers

        pieces = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
        return [text[a:b] for a, b in _char_spans(text, pieces)]


def _char_spans(text: str, pieces) -> Iterator[tuple[int, int]]:
    """Character spans of pieces: a piece has one printable character for each byte."""
    at = 0
    for shown, _ in pieces:
        left, end = len(shown), at
        while left > 0:
            left -= len(text[end].encode())
            end += 1
        yield at, end
        at = end


class Units:
    """Ids of whole text columns from the ids of their distinct units: the start of a text, and words with the space before them.

    A single space between two characters that are not white space always starts a piece, so such units are independent of each
    other and are encoded once. Texts with other white space beside spaces are encoded as a whole.
    """

    def __init__(self, encode, most: int = MAX_UNITS):
        self.encode = encode  # texts, whether they are words after a space -> (all their ids in one array, how many each has)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.lead: dict[str, int] = {}
        self.inner: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _add(self, texts: list[str], words: bool) -> int:
        """Encode texts and keep their ids; the number of the first."""
        ids, lengths = self.encode(texts, words)
        first = len(self.ends) - 1
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        return first

    def _numbers(self, known: dict[str, int], units: list[str], before: str) -> np.ndarray:
        """Numbers of distinct units, new ones encoded; -1 for a unit that is not independent."""
        numbers = np.array(list(map(known.get, units, itertools.repeat(_UNKNOWN))), np.int64)
        open_ = np.flatnonzero(numbers == _UNKNOWN)
        if len(open_):
            new = sorted(units[i] for i in open_.tolist())
            known.update(dict.fromkeys(new, -1))
            new = [u for u in new if _independent(u)]
            if new:
                first = self._add([before + u for u in new], before == " ")
                known.update(zip(new, range(first, first + len(new))))
            numbers[open_] = [known[units[i]] for i in open_.tolist()]
        return numbers

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of each text of a column without nulls: all in one array, and where each text's begin and end."""
        if len(self.ends) > self.most:
            self._forget()
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        parts = split.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets -= offsets[0]
        is_first = np.zeros(len(parts), bool)
        is_first[offsets[:-1]] = True
        numbers = np.empty(len(parts), np.int64)
        for mask, known, before in ((is_first, self.lead, ""), (~is_first, self.inner, " ")):
            coded = parts.filter(pa.array(mask)).dictionary_encode()
            if len(coded):
                units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                numbers[mask] = self._numbers(known, units, before)[coded.indices.to_numpy()]
        if numbers.min(initial=0) < 0:
            whole = np.unique(np.searchsorted(offsets, np.flatnonzero(numbers < 0), "right") - 1)
            first = self._add(texts.take(pa.array(whole)).to_pylist(), False)
            keep = np.ones(len(numbers), bool)
            for k, doc in enumerate(whole):
                keep[offsets[doc] + 1:offsets[doc + 1]] = False
                numbers[offsets[doc]] = first + k
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            numbers = numbers[keep]
        return numbers, offsets

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin and end."""
        numbers, offsets = self.column(texts)
        lengths = self.ends[numbers + 1] - self.ends[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[gather(self.ends[numbers], lengths)], ends[offsets]


def _independent(unit: str) -> bool:
    return unit != "" and not unit[0].isspace() and not unit[-1].isspace()


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each of many ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Level:
    """The same tables as :class:`Prefixes`, for many short pieces at once: one step computes every distinct prefix of a length.

    Sorted pieces that share a prefix share its entry, so the entries form the trie of the pieces.
    """

    LONGEST = 40

    def __init__(self, vocabulary: Vocabulary):
        self.v, size = vocabulary, len(vocabulary.tokens)
        # Endings of tokens as states of a trie over reversed bytes; an edge is state * 256 + byte.
        state = {b"": 0} | {tail: i + 1 for i, tail in enumerate(sorted(vocabulary.tails, key=len))}
        edges = sorted((state[tail[1:]] * 256 + tail[0], state[tail]) for tail in vocabulary.tails)
        self.edge, self.next = (np.array(c, np.int64) for c in zip(*edges))
        self.token = np.full(len(state), -1, np.int64)
        for tail, rank in vocabulary.tails.items():
            self.token[state[tail]] = rank
        # Pairs of tokens whose bytes together are a token.
        joins = sorted((vocabulary.rank[t[:k]] * size + vocabulary.rank[t[k:]], r) for r, t in enumerate(vocabulary.tokens)
                       for k in range(1, len(t)) if t[:k] in vocabulary.rank and t[k:] in vocabulary.rank)
        self.pair, self.joined = (np.array(c, np.int64) for c in zip(*joins))
        self.left = np.array([h[0] if h else -1 for h in vocabulary.halves], np.int64)
        self.right = np.array([h[1] if h else -1 for h in vocabulary.halves], np.int64)

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`Vocabulary.adjacent` for arrays of tokens."""
        answer, rows = np.ones(len(a), bool), np.arange(len(a))
        a, b, before = a.copy(), b.copy(), np.full(len(a), len(self.v.tokens))
        while len(rows):
            key = a * len(self.v.tokens) + b
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            bad = (self.pair[at] == key) & (self.joined[at] < before)
            answer[rows[bad]] = False
            go = ~bad & ((self.left[a] >= 0) | (self.left[b] >= 0))
            rows, a, b = rows[go], a[go], b[go]
            of_left = (self.left[b] < 0) | ((self.left[a] >= 0) & (a > b))
            before = np.where(of_left, a, b + 1)
            a, b = np.where(of_left, self.right[a], a), np.where(of_left, b, self.left[b])
        return answer

    def tokens(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sorted distinct pieces, none longer than LONGEST: all in one array, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        high = int(lengths.max(initial=0))
        data = np.frombuffer(b"".join(p.ljust(high, b"\0") for p in pieces), np.uint8).reshape(len(pieces), high)
        same = np.zeros(len(pieces), np.int64)  # bytes shared with the piece before
        differ = np.concatenate([data[1:] != data[:-1], np.ones((max(0, len(pieces) - 1), 1), bool)], axis=1)
        same[1:] = np.minimum(differ.argmax(axis=1), np.minimum(lengths[1:], lengths[:-1]))
        entry = np.zeros((high + 1, len(pieces)), np.int32)  # of each prefix of each piece
        last, before, used = [np.array([-1])], [np.array([0])], 1
        for i in range(1, high + 1):
            new = (same < i) & (lengths >= i)
            entry[i] = used - 1 + np.cumsum(new)
            used += int(new.sum())
            known = np.concatenate(last)
            a, b = self._step(data, np.flatnonzero(new), i, entry, known)
            last.append(a)
            before.append(b)
        last, before = np.concatenate(last), np.concatenate(before)
        at, found = entry[lengths, np.arange(len(pieces))].astype(np.int64), []
        while at.any():
            found.append(np.where(at > 0, last[at], -1))
            at = before[at]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(len(pieces), np.int64)
        back = np.stack(found[::-1], axis=1)
        return back[back >= 0].astype(np.uint32), (back >= 0).sum(axis=1)

    def _step(self, data, rows, i, entry, known):
        """Last tokens of the prefixes of length ``i`` of these pieces, and the entries before them."""
        last, before = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_, state = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for k in range(1, i + 1):
            key = state * 256 + data[rows[open_], i - k]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            ok = self.edge[at] == key
            open_, state = open_[ok], self.next[at[ok]]
            if not len(open_):
                break
            token = self.token[state]
            some = np.flatnonzero(token >= 0)
            prev = entry[i - k, rows[open_[some]]].astype(np.int64)
            good = np.ones(len(some), bool) if i == k else self.adjacent(known[prev], token[some])
            hit = some[good]
            last[open_[hit]], before[open_[hit]] = token[hit], prev[good]
            rest = np.ones(len(open_), bool)
            rest[hit] = False
            open_, state = open_[rest], state[rest]
            if not len(open_):
                break
        return last, before


class PieceEncoder:
    """Ids of texts: cut into pieces, distinct pieces through the prefix tables, put together again."""

    def __init__(self, vocabulary: Vocabulary, pieces, single: frozenset[str] = frozenset()):
        self.v, self.pieces, self.single = vocabulary, pieces, single  # text -> its pieces; pieces that are one token by rule
        self.level, self.prefixes = Level(vocabulary), Prefixes(vocabulary)

    def _distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [p.encode() for p in pieces]
        order = sorted(range(len(raw)), key=raw.__getitem__)
        short = [k for k in order if len(raw[k]) <= Level.LONGEST and pieces[k] not in self.single]
        ids, counts = self.level.tokens([raw[k] for k in short])
        starts, lengths, extra = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64), [ids]
        lengths[short] = counts
        starts[short] = np.cumsum(counts) - counts
        size = len(ids)
        for k in order:
            if pieces[k] in self.single:
                own = np.array([len(self.v.tokens)], np.uint32)
            elif len(raw[k]) > Level.LONGEST:
                self.prefixes.share(raw[k])
                own = np.array(self.prefixes.tokens(), np.uint32)
            else:
                own = ()
            if len(own):
                starts[k], lengths[k], size = size, len(own), size + len(own)
                extra.append(own)
        self.prefixes.cut(0)
        ids = np.concatenate(extra)
        return ids, np.stack([starts, lengths])

    def __call__(self, texts: list[str], words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        number: dict[str, int] = {}
        flat, per_text = [], []
        for text in texts:
            own = self.pieces(text)
            flat.extend([number.setdefault(p, len(number)) for p in own])
            per_text.append(len(own))
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ids, (starts, lengths) = self._distinct(list(number))
        flat = np.array(flat, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths[flat])])
        edges = ends[np.concatenate([[0], np.cumsum(per_text)])]
        return ids[gather(starts[flat], lengths[flat])], np.diff(edges)


class Codec:
    """Encoding of texts and decoding of ids with a rank file."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v = vocabulary
        self.units = Units(PieceEncoder(vocabulary, Splitter(pattern)))
        self.lengths = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.decimal = pa.array([str(i) for i in range(len(vocabulary.tokens))])

    def encode(self, text: str) -> np.ndarray:
        return self.units.tokens(pa.array([text], pa.string()))[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[gather(self.starts[ids], self.lengths[ids])].tobytes()

    def digests(self, texts: pa.Array):
        """Tokens, digest of the decimal ids and digest of the decoded bytes, a list of each."""
        ids, edges = self.units.tokens(texts)
        raw = self.decode(ids)
        at = np.concatenate([[0], np.cumsum(self.lengths[ids])])[edges]
        shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), self.decimal.take(pa.array(ids))), " ")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return np.diff(edges), [sha(s.as_buffer()) for s in shown], [sha(raw[a:b]) for a, b in zip(at, at[1:])]


@functools.cache
def codec(ranks: str) -> Codec:
    """One codec for each worker process."""
    return Codec(Vocabulary.from_ranks(public_tokenizers.path(ranks)), public_tokenizers.PATTERN)


DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the decoded bytes of every text: one row for each row of ``docs``.

    A null or empty text has no tokens and the digests of empty strings; a null id stays null; repeated rows each give a row;
    other columns of ``docs`` are not read. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digests(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_blocks(columns, codec(ranks).digests, DIGEST)

    return docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col)).alias("d")).select("doc_id", "d.*")


def token_ids(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids themselves, as an array of each text, with the same rules as :func:`encoded`."""
    ship(docs.sparkSession)
    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, parts in slices(columns):
            done = [codec(ranks).units.tokens(p) for p in parts]
            yield pa.concat_arrays([pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(i.astype(np.int32))) for i, e in done]
                                   or [pa.array([], pa.list_(pa.int32()))])

    return docs.select(F.col(id_col).alias("doc_id"), ids(F.col(text_col)).alias("ids"))
