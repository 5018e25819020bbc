"""Words of texts stay in their task where what they meet is small."""

from marketloom.operators import news


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark):
    return spark.createDataFrame([(1, "good Good bad, x"), (2, ""), (3, None), (4, "the Red fox good")], "doc_id long, text string")


def test_scores_shuffle_no_words(spark, monkeypatch):
    lexicon = spark.createDataFrame([("good", 1), ("bad,", -1)], "word string, polarity int")
    out = news.lexicon_scores(docs(spark), lexicon)
    assert "hashpartitioning(word" not in plan(out) and "hashpartitioning(doc_id#" in plan(out) and ", word" not in plan(out).split("hashpartitioning(doc_id#")[1].split(")")[0]
    small = sorted(tuple(r) for r in out.collect())
    monkeypatch.setattr(news, "small_side", lambda df: df)
    assert small == sorted(tuple(r) for r in news.lexicon_scores(docs(spark), lexicon).collect())
    assert (1, 0.5, 0.25, 0.25, "positive") in small and len(small) == 4


def test_rest_isn_t_sorted(spark):
    out = news.score_with(docs(spark), docs(spark).filter("doc_id = 1"), lambda rest: rest)
    assert "SortMergeJoin" not in plan(out) and sorted(r.doc_id for r in out.collect()) == [2, 3, 4]


def test_names_shuffle_no_words(spark, monkeypatch):
    names = spark.createDataFrame([(7, "Red Fox"), (8, "good red"), (9, "!")], "symbol long, name string")
    out = news.named_in(docs(spark), names)
    assert "hashpartitioning(word" not in plan(out)
    assert [tuple(r) for r in out.collect()] == [(4, 7)]
    monkeypatch.setattr(news, "small_side", lambda df: df)
    assert [tuple(r) for r in news.named_in(docs(spark), names).collect()] == [(4, 7)]
