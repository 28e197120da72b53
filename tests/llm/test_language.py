import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sirenlog.llm import language as g

SYLLABLES = {"en": ["th", "er", "ing", "on"], "fr": ["eau", "ez", "ç", "é"], "de": ["sch", "ung", "ß", "ü"]}


def _rows(n, seed):
    rng = random.Random(seed)
    word = lambda lang: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
    return [(seed * 1000 + i, " ".join(word(lang) for _ in range(rng.randint(3, 60))), lang)
            for i, lang in enumerate(rng.choice(list(SYLLABLES)) for _ in range(n))]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_held_out_accuracy(spark):
    frame = _frame(spark, _rows(300, 1))
    model = g.fit(frame, ~g.held_out())
    assert 3 <= len(model.languages) <= 3 * g.CLUSTERS
    out = g.predict(frame.withColumn("held_out", g.held_out()), model).filter("held_out")
    total, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert total > 50 and right / total > 0.97
    assert out.agg(F.min("score"), F.max("score")).first() >= (0,) and out.agg(F.max("score")).first()[0] <= 1


def test_held_out_rows_and_unknown_languages_teach_nothing(spark):
    frame = _frame(spark, _rows(200, 2))
    model = g.fit(frame, ~g.held_out())
    wrong = frame.withColumn("lang", F.when(g.held_out(), "xx").otherwise(F.col("lang"))).union(
        _frame(spark, [(9000 + i, "zzz qqq", None) for i in range(20)]))
    other = g.fit(wrong, ~g.held_out())
    assert other.languages == model.languages and np.allclose(other.centroids, model.centroids)


def test_counts_do_not_depend_on_neighbours():
    texts = ["Straße und", "", "12 !", "été", "a", "日本 x", "b"]
    whole, letters = g.counts(texts)
    assert letters.tolist() == [True, False, False, True, True, True, True]
    for i, text in enumerate(texts):
        assert np.array_equal(g.counts([text])[0][0], whole[i])
    assert whole[4].sum() == 3 and whole[3].sum() == 9  # one-, two- and three-letter grams per letter


def test_far_texts_are_rejected(spark):
    model = g.fit(_frame(spark, _rows(300, 3)), F.lit(True))
    out = {r.doc_id: r for r in g.predict(_frame(spark, [(1, "ыва олд жэ " * 9, None), (2, "schung üß schung", None)]), model).collect()}
    assert out[1].rejected and out[2].lang_pred == "de"


def test_odd_rows(spark, documents, odd_rows):
    model = g.fit(_frame(spark, _rows(100, 4)), F.lit(True))
    docs = documents(odd_rows).selectExpr("*", "'x' AS score", "'y' AS rejected")
    out = g.predict(docs, model).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        if not any(x.isalpha() for x in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == (g.UNKNOWN, 0.0, True)
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1


def test_nothing_to_learn_from(spark, documents):
    model = g.fit(_frame(spark, _rows(5, 5)), F.lit(False))
    [row] = g.predict(_frame(spark, [(1, "text", None)]), model).collect()
    assert row.lang_pred == g.UNKNOWN and row.score == 0
    assert g.predict(documents([]), model).count() == 0


def test_repeated_and_null_ids_teach_as_much(spark):
    """All rows under one id, or under none, give the model of the same rows under ids of their own."""
    rows = _rows(240, 6)
    model = g.fit(_frame(spark, rows), F.lit(True))
    for same in (7, None):
        other = g.fit(_frame(spark, [(same, text, lang) for _, text, lang in rows]), F.lit(True))
        assert other.languages == model.languages and np.allclose(other.centroids, model.centroids, atol=1e-5)


def test_predictions_equal_a_plain_cosine(spark):
    """Row by row: the gram counts of one text at a time, weighted, against every centroid."""
    rows = _rows(120, 8) + [(9500, "", None), (9501, "12", None), (9502, "thering oneau", None)]
    model = g.fit(_frame(spark, rows), F.lit(True))
    out = {r.doc_id: r for r in g.predict(_frame(spark, rows), model).collect()}
    seen = Counter(d for _, text, lang in rows if lang for d in np.flatnonzero(g.counts([text])[0][0]).tolist())
    lettered = sum(any(x.isalpha() for x in text) for _, text, lang in rows if lang)
    for i, text, _ in rows:
        table = g.counts([text])[0][0].astype(float)
        weight = {d: np.log1p(table[d]) * (np.log((1 + lettered) / (1 + seen[d])) + 1) for d in np.flatnonzero(table).tolist()}
        if not any(x.isalpha() for x in text):
            assert out[i].lang_pred == g.UNKNOWN
            continue
        cosine = [_plain_cosine(weight, c) for c in model.centroids]
        assert out[i].score == pytest.approx(max(cosine), abs=1e-4), i
        best = sorted(zip(cosine, model.languages))[-2:]
        assert out[i].lang_pred == best[-1][1] or abs(best[-1][0] - best[0][0]) < 1e-4


def _plain_cosine(weight, centroid):
    dot = sum(x * float(centroid[d]) for d, x in weight.items())
    return dot / np.sqrt(sum(x * x for x in weight.values())) / max(1e-9, float(np.sqrt((centroid.astype(float) ** 2).sum())))


def test_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = g.fit(docs, ~g.held_out())
    out = g.predict(docs.withColumn("held_out", g.held_out()), model).filter("held_out AND length(text) > 40")
    total, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert total > 40 and right / total >= 0.9
