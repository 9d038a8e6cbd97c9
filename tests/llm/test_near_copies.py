"""Near copies at five words and similarity 0.8 against all pairs, and one row of each group."""

import random

import corpus_pipeline
from riskloom.llm import near_copies


def jaccard(a, b):
    x, y = ({" ".join(t.lower().split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def corpus():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for changes in [0, 1, 2, 3, 4, 5, 6, 8] * 3:
        base = [word() for _ in range(200)]
        texts.append(" ".join(base))
        for _ in range(2):
            copy = base[:]
            for at in rng.sample(range(200), changes):
                copy[at] = word()
            texts.append(" ".join(copy))
    for k in range(70):  # a hot bucket: one word of the base changed
        hot = [f"h{i}" for i in range(150)]
        hot[k * 2] = "other"
        texts.append(" ".join(hot))
    return texts


def test_stage_leaves_no_pair_of_four_fifths(spark):
    texts = corpus()
    low = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    for _ in texts:
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == sorted(set(low)) and 1 < len(kept) < len(texts)


def test_exactly_one_row_of_each_group(spark):
    text, other = "one two three four five six seven eight", "quite another text of some more than five words"
    rows = [(None, text, "a"), (3, text, "a"), (3, text, "b"), (3, text.upper(), "a"), (3, text, "a"), (5, text, "a"),
            (None, other, None), (None, other, None), (None, None, "a"), (None, " \n", "a"), (9, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(2)
    kept = near_copies.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 3), (False, 9), (True, None)]
    none = docs.filter("false")
    assert near_copies.one_of_each(none).count() == 0


def likely_pairs(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    signed = table.select(near_copies._signatures(table["text"], 5).alias("s")).select("s.*")
    rows = signed.selectExpr("explode(bands) AS bucket", "mark", "n", "sketch").cache()
    return near_copies.candidates(rows, 0.8, near_copies._Tables()).distinct().count()


def test_texts_with_a_common_passage_cost_no_pairs(spark):
    """Similarity about 0.5: most share bands, none is a near copy."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(200)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(90)]) for _ in range(400)]
    few, many = likely_pairs(spark, texts[:200]), likely_pairs(spark, texts)
    assert many <= 3 * max(few, 200)


def test_a_large_group_of_near_copies_costs_pairs_in_its_size(spark):
    base = [f"h{i}" for i in range(300)]
    texts = [" ".join(base[:k % 290] + [f"x{k}"] + base[k % 290 + 1:]) for k in range(300)]
    assert likely_pairs(spark, texts) <= 20 * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert [r.doc_id for r in near_copies.one_of_each(docs).collect()] == [0]
