"""The quality stage without any usable label."""

import pytest

import corpus_pipeline
from riskloom.llm import quality_embed


@pytest.mark.parametrize("only", ["false", "crc32(string(doc_id)) % 4 = 2"])
def test_nothing_learned_rejects_nothing(spark, tmp_path, only):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["one text", "", None, "another"])], "doc_id long, text string")
    labels = spark.range(200).selectExpr("id AS doc_id", "int(id % 2) AS quality").filter(only)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()) == [0, 1, 2, 3]
    model = quality_embed.train(docs, labels)
    assert not model.learned and {r.score for r in quality_embed.scored(docs, model).collect()} == {0.5}


def test_samples_stay_bounded_where_one_id_repeats(spark, monkeypatch):
    """A label and a document that repeat by the hundred, with many texts: four rows of an id reach the driver, and all classes do."""
    from riskloom.llm import lang_gru, quality_embed

    docs = spark.createDataFrame([(8, f"hot text {i} of one id", "en") for i in range(400)] + [(8, "same", "en")] * 300
                                 + [(i, f"der Text {i}", "de") for i in range(100, 160)], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(8, 1)] * 500 + [(i, i % 2) for i in range(100, 160)], "doc_id long, quality long")
    seen = []
    monkeypatch.setattr(quality_embed, "fit", lambda texts, marks: seen.append((texts, marks)))
    quality_embed.train(docs, labels)
    texts, marks = seen[0]
    assert sum(t.startswith((b"hot", b"same")) for t in texts) <= quality_embed.ROWS_OF_ID and {0, 1} == set(marks)
    windows, langs = lang_gru.sample(docs, "doc_id", "text", "lang")
    assert set(langs) == {"de", "en"} and sum(w == b"same" for w in windows) <= lang_gru.SAMPLE_WINDOWS
