from tabforge.llm import toxicity


def _mostly_toxic(spark):
    """600 toxic texts, 200 clean; \"garden\" stands in all clean ones and in two thirds of the toxic ones."""
    rows = [(k, "the awfulword " + ("garden " * 30 if k % 3 else "street"), 1) for k in range(600)]
    rows += [(k, ". ".join(["a garden"] * (k % 5 + 1)), 0) for k in range(600, 800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_words_commoner_in_clean_texts_are_not_learned(spark):
    docs, labels = _mostly_toxic(spark)
    lexicon = toxicity.learn_lexicon(toxicity.training_rows(docs, labels))
    assert "awfulword" in lexicon.words and "garden" not in lexicon.words
    assert all(w > 0 for w in lexicon.beginnings.values()) and all(w >= 0 for _, w in lexicon.words.values())
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == set(range(600, 800))


def test_total_is_not_negative_and_missing_scores_are_kept(spark, monkeypatch):
    lexicon = toxicity.Lexicon({"bad": (toxicity.INSULT, -2.0)})
    assert toxicity.clause_scores("bad bad", lexicon, toxicity.grammar(), {})[0] == 0.0
    docs, labels = _mostly_toxic(spark)
    for beta in (float("nan"), None):
        model = toxicity.ToxicityModel(toxicity.seed_lexicon(), [beta, 0.0, 0.0, 0.0])
        monkeypatch.setattr(toxicity, "fit", lambda *a, m=model: m)
        assert toxicity.without_toxic(docs, labels).count() == 800
