"""What counts as a letter in language identification, and the bound of its sample."""
from pyspark.sql import functions as F

from trailkeep.llm import language


def test_numerals_are_no_letters():
    for text in ("½ ² ①", "Ⅳ ⅷ", "́̈", "12 _ -", "", None):
        assert language.words_of(text) == []
    assert language.words_of("Straße x² a½b É") == ["straße", "x", "a", "b", "é"]


def test_letterless_texts_are_undetermined(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "½ ² ①", None), (3, "Ⅳ", "de"), (4, None, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.train(docs)).collect()}
    assert found[1][0] == "en" and found[2] == found[3] == found[4] == ("und", 0.0)


def test_copies_of_a_text_do_not_come_in_together(spark, monkeypatch):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("one hot text").alias("text"), F.lit("en").alias("lang"))
    seen = []
    real = language.map_arrow

    def watched(df, fn, schema):
        if df.columns == ["text", "lang"]:
            seen.append(df.count())
        return real(df, fn, schema)

    monkeypatch.setattr(language, "map_arrow", watched)
    language.train(docs, per_language=100, rounds=1)
    assert 50 <= seen[0] <= 160
