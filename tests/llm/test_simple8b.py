"""Token-id files: coding round trips, files against the tokenizers library, damaged frames, awkward rows."""

import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from riskloom.llm import simple8b
from test_text_operators import LONG, SCHEMA, TEXTS, rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("high", [1, 2, 9, 200, 50_257, 1 << 21, 1 << 31, (1 << 60) - 1])
def test_every_length_and_width_comes_back(high):
    rng = np.random.default_rng(high % 997)
    for length in (0, 1, 2, 1023, 1024, 1025, 5000):
        values = rng.integers(0, high, length).astype(np.uint64)
        values[rng.random(length) < 0.3] = 0
        words, per_block = simple8b.encode(values)
        assert per_block.sum() == len(words)
        assert (simple8b.decode(words, per_block, length) == values).all()


def test_words_are_full_and_wide_values_escape():
    words, _ = simple8b.encode(np.full(1024, 30_000, np.uint64))
    assert len(words) == 256  # four values of 15 bits to a word
    words, _ = simple8b.encode(np.array([1 << 40, 1, 1 << 59], np.uint64))
    assert (words >> np.uint64(60)).tolist()[0] == 15


def test_a_frame_reads_any_range_and_notices_damage():
    ids = np.arange(5000, dtype=np.uint64) * 7
    raw = simple8b.frame([4, None, -9], np.array([2000, 0, 3000]), ids, 2, 11) + b"\n"
    found = simple8b.Frame(memoryview(raw))
    assert (found.doc_ids, found.counts.tolist(), found.part, found.before) == ([4, None, -9], [2000, 0, 3000], 2, 11)
    assert len(raw) % 8 == 0
    for a, b in ((0, 5000), (1023, 1025), (4999, 5000), (3000, 3000), (2500, 9999)):
        assert (found.ids(a, b) == ids[a:b]).all()
    for broken in (raw[:100] + b"x" + raw[101:], raw[:-8]):
        with pytest.raises(ValueError):
            simple8b.Frame(memoryview(broken))


def expected(library, table, end=2):
    """(id, start, count, crc32) of each row, in id order."""
    out, start = [], 0
    for doc_id, text in table:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_equal_the_library(spark, library):
    docs = spark.createDataFrame([r for r in rows() if r[0] is not None], SCHEMA).dropDuplicates(["doc_id"]).repartition(3)
    found = sorted(tuple(r) for r in simple8b.round_trip(docs).collect())
    assert found == expected(library, list(enumerate(TEXTS)))


def test_null_and_repeated_ids_lie_gapless_at_their_place(spark, library):
    docs = spark.createDataFrame(rows(), SCHEMA)
    found = [tuple(r) for r in simple8b.round_trip(docs).collect()]
    assert len(found) == len(rows())
    found.sort(key=lambda r: r[1])
    assert [r[1] for r in found] == np.concatenate([[0], np.cumsum([r[2] for r in found])[:-1]]).tolist()
    assert [(r[0] is None, r[0] or 0) for r in found] == sorted((r[0] is None, r[0] or 0) for r in found)
    want = sorted((n, c) for r in rows() for _, _, n, c in expected(library, [(r[0], r[1])]))
    assert sorted((n, c) for _, _, n, c in found) == want


def test_empty_table_long_texts_and_text_ids(spark, library):
    empty = spark.createDataFrame([], SCHEMA)
    assert simple8b.round_trip(empty).collect() == []
    texts = [LONG * 30, "", LONG]  # the first is larger than a block of text and than a frame
    docs = spark.createDataFrame([(f"é{i}", t) for i, t in enumerate(texts)] + [(None, "a")], "doc_id string, text string")
    found = sorted((tuple(r) for r in simple8b.round_trip(docs).collect()), key=lambda r: r[1])
    assert found == expected(library, [(f"é{i}", t) for i, t in enumerate(texts)] + [(None, "a")])


def test_ids_come_back_as_arrays(spark, library, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    path = f"{tmp_path}/ids"
    simple8b.write_ids(docs, path)
    for r in simple8b.read_ids(spark, path).collect():
        assert r.ids == library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [2]


def test_many_ids_in_many_parts(spark):
    docs = spark.range(0, 3000, 1, 7).selectExpr("pmod(id * 7919, 3000) AS doc_id", "repeat('a b ', pmod(id, 40)) AS text")
    found = sorted(tuple(r) for r in simple8b.round_trip(docs).collect())
    assert [r[0] for r in found] == list(range(3000))
    assert [r[1] for r in found] == np.concatenate([[0], np.cumsum([r[2] for r in found])[:-1]]).tolist()
