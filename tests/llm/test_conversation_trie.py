"""The conversation trie against a dictionary of all beginnings; shards of every cut, long conversations, awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from riskloom.llm import conversation_trie
from riskloom.llm.conversation_trie import RESULT

SCHEMA = "conv_id long, turn long, role string, text string, shard string, key string, ends string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "s", "k", "e") for r in rows], SCHEMA).repartition(parts)


def digest(turn):
    return hashlib.sha256(hashlib.sha256(turn[0].encode()).hexdigest().encode() + turn[1].encode()).digest()[:16]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest((role or "", text or "")), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, ids in members.items())


def key(row):
    return tuple(-1 if v is None else v for v in row)


def found(spark, rows, parts=3):
    return sorted((tuple(r) for r in conversation_trie.prefix_trie(table(spark, rows, parts)).collect()), key=key)


def chatter(seed, conversations=300, longest=9):
    rng = random.Random(seed)
    words = ["a", "bé", "漢", "", "dd " * 9]
    out = []
    for c in range(conversations):
        for turn in range(rng.randint(0, longest)):
            out.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(words)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shards", ["1", "4", "23"])
def test_equals_a_dictionary_of_beginnings(spark, shards):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        rows = chatter(int(shards))
        assert found(spark, rows) == sorted(brute(rows), key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_one_conversation_that_a_third_share(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(400) for t in range(4)] + chatter(9, 120)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert found(spark, rows) == sorted(brute(rows), key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_conversations_cross_bands(spark):
    rows = [(c, t, "user", f"turn {t // 70}" if t != 150 + c // 10 else f"other {c}") for c in range(0, 40, 5) for t in range(100 + 7 * c)]
    assert found(spark, rows) == sorted(brute(rows), key=key)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, "user", "late"), (0, 1, None, "x"), (0, 1, "", "x"), (0, 1, "a", None), (0, 0, "user", "zero"), (0, 0, "user", "zero"),
            (None, 0, "user", "nobody"), (3, None, None, None), (4, 2, "user", "x" * 3_000_000), (7, 0, "user", "zero"), (-3, 0, "user", "minus")]
    negative = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found(spark, negative) == sorted(brute(negative), key=key)
    assert len(found(spark, rows)) >= len(found(spark, negative))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_conversation_without_turns_left_is_a_member_of_the_root(spark):
    gone = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    rows = [(gone, t, "user", "x") for t in range(2)]  # the family's first is absent, and all own turns are replaced
    assert found(spark, rows) == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())] == brute(rows)


def test_columns_are_as_stated(spark):
    frame = conversation_trie.prefix_trie(table(spark, [(1, 0, "user", "a")]))
    assert frame.columns == list(RESULT)
    assert {t for n, t in frame.dtypes if n != "ends_sha256"} == {"bigint"}


def test_bands_sort_as_a_whole(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(conversation_trie, "BAND", 3)
    turns = [b"".join(bytes([rng.integers(0, 3)]) * 16 + bytes(4) for _ in range(rng.integers(0, 11))) for _ in range(500)]
    convs = rng.permutation(500).astype(np.int64)
    order = conversation_trie.Shard(convs, turns, 0).order
    assert order.tolist() == sorted(range(500), key=lambda i: (turns[i], convs[i]))
