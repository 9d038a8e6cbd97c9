"""The importance draw against a plain re-computation; selection with ties, nulls and hot keys."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import importance_draw
from test_text_operators import SCHEMA, rows


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def grams(text, longest):
    own = words(text)
    return [" ".join(own[i:i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def brute(docs, target, buckets=10_000, longest=1, percent=10, least=20):
    place = lambda w: zlib.crc32(w.encode()) % buckets
    source, aim = Counter(), Counter()
    for _, text in docs:
        source.update(map(place, grams(text, longest)))
    for text in target:
        aim.update(map(place, grams(text, longest)))
    s, t = sum(source.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((n + 1) * (t + buckets)))) for b, n in source.items()}
    out = []
    for doc_id, text in docs:
        own = grams(text, longest)
        weight = sum(gain[place(w)] for w in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))[:percent * sum(r[4] for r in out) // 100]
    return sorted(map(str, [(*r[:4], None) for r in out])), [(r[3], r[0]) for r in order]


def check(frame, docs, target, **given):
    found = frame.collect()
    plain, order = brute(docs, target, **given)
    assert sorted(str((r.doc_id, r.n_features, r.weight, r.score, None)) for r in found) == plain
    taken = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in taken] == list(range(1, len(order) + 1))
    assert [(r.score, r.doc_id) for r in taken] == order


def corpus(count, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)] + ["Über", "漢字", "A1b", "x-y", "ÀB"]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(count)]


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (2, 97), (3, 10_000)])
def test_equals_the_plain_form(spark, longest, buckets):
    docs = corpus(400)
    target = ["w1 w2 w3 Über", None, "", "w7 w7 漢字"]
    frame = importance_draw.drawn(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                  spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=buckets)
    check(frame, docs, target, longest=longest, buckets=buckets)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    target = spark.createDataFrame([("quick fox",)], "text string")
    check(importance_draw.drawn(docs, target, percent=60, least_words=2), [r[:2] for r in rows()], ["quick fox"], percent=60, least=2)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert importance_draw.drawn(none, some).collect() == []
    check(importance_draw.drawn(some, none, percent=100), [(1, "a " * 30)], [], percent=100)


def test_selection_finds_every_rank_among_ties(spark):
    rng = random.Random(4)
    table = [(rng.choice([None, *range(40)]), rng.randint(-3, 3)) for _ in range(300)] + [(7, 2)] * 150
    frame = spark.createDataFrame(table, "doc_id long, score long").repartition(4).cache()
    order = sorted(table, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for k in (1, 2, 60, 200, 449, 450):
        assert importance_draw.kth_key(frame, k) == (order[k - 1][1], order[k - 1][0])
    assert importance_draw.kth_key(frame, 451) is None


def test_a_hot_key_at_the_edge_gets_only_the_ranks_left(spark, tmp_path):
    table = [(i, 9, True) for i in range(10)] + [(50, 5, True)] * 90 + [(60, 1, True), (61, 99, False)]
    spark.createDataFrame(table, "doc_id long, score long, eligible boolean").repartition(6).write.parquet(f"{tmp_path}/t")
    found = importance_draw.ranked(spark.read.parquet(f"{tmp_path}/t"), 40).collect()
    assert len(found) == len(table)
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 41))
    assert sum(r["rank"] is not None for r in found if r.doc_id == 50) == 30
    assert all(r["rank"] == r.doc_id + 1 for r in found if r.doc_id < 10)


def test_text_ids(spark):
    docs = [(f"d{i}", t) for i, t in corpus(100)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    found = importance_draw.drawn(frame, spark.createDataFrame([("w1 w2",)], "text string")).collect()
    order = sorted((r for r in found if r.n_features >= 20), key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in order][:5] == [1, 2, 3, 4, 5]


def test_words_of_a_sliced_column():
    texts = pa.array(["zero", "One TWO", "", "x_y 漢 3", "tail"]).slice(1, 3)
    found, of = importance_draw._words(texts)
    assert found.to_pylist() == ["one", "two", "x", "y", "漢", "3"]
    assert of.tolist() == [0, 0, 2, 2, 2, 2]
    assert np.array_equal(importance_draw.features(texts, 100, 1)[2], [2, 0, 4])
