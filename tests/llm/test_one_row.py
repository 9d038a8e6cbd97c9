"""Exactly one row of each group of linked fingerprints stays: null ids, repeated ids, equal rows."""

from riskloom.llm import simhash_trie


def test_exactly_one_row_of_each_group(spark):
    text, other = "one two three four five six seven eight", "quite another text of some more than five words"
    rows = [(None, text, "a"), (3, text, "a"), (3, text, "b"), (3, text.upper(), "a"), (3, text, "a"), (5, text, "a"),
            (None, other, None), (None, other, None), (None, None, "a"), (None, " \n", "a"), (9, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(2)
    kept = simhash_trie.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 3), (False, 9), (True, None)]
    none = docs.filter("false")
    assert simhash_trie.one_of_each(none).count() == 0
