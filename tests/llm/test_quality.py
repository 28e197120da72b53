import re

import numpy as np

from sirenlog.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(windows) < 5000 else None
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": None if covered is None else len(covered)}


def test_counts_of_odd_rows(documents, odd_rows):
    rows = [(i, t) for i, t in enumerate(t for _, t in odd_rows)]
    rows += [(100, "a b c a b c d"), (101, "#* $\n% &|\n<>\n% &|\n"), (102, "x\r\nx\n\x0b\nx\r\n"), (103, "a a a a")]
    model = q.Model(np.zeros(1 << q.BITS, np.int32), 0.0)
    got = {r.doc_id: r for r in q.assess(documents(rows).selectExpr("*", "9 AS kept", "8 AS __text2"), model).collect()}
    for i, text in rows:
        for name, value in plain_counts(text).items():
            assert value is None or got[i][name] == value, (i, name)
        failed = got[i].n_words < 50 or 100 * got[i].n_repeat_words > 50 * got[i].n_words
        assert got[i].base_failed == failed and got[i].kept == (not failed)


def _corpus():
    rng = np.random.default_rng(0)
    clean = [" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)) for _ in range(60)]
    junk = [" ".join("".join(rng.choice(list("XYZ$#"), 5)) for _ in range(80)) for _ in range(30)]
    return clean, junk


def test_the_model_separates(spark, documents):
    clean, junk = _corpus()
    rows = list(enumerate(clean + junk))
    labels = spark.createDataFrame(
        [(i, int(i < 60), 0) for i, _ in rows if i % 3] + [(1, None, 0), (None, 1, 0), (7777, 1, 0)],
        "doc_id long, quality int, toxic int")
    model = q.fit(documents(rows), labels)
    kept = {r.doc_id for r in q.assess(documents(rows), model, keep=["doc_id"]).filter("kept").collect()}
    assert kept == set(range(60))
    assert {r.doc_id for r in q.kept_documents(documents(rows), model).collect()} == kept
    again = q.fit(documents(rows, 7), labels)
    assert np.array_equal(model.ratios, again.ratios) and model.threshold == again.threshold


def test_scores_are_length_normalised_log_ratios(spark, documents):
    clean, junk = _corpus()
    rows = list(enumerate(clean + junk))
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(90)], "doc_id long, quality int, toxic int")
    model = q.fit(documents(rows), labels)
    counts = {True: np.ones(1 << q.BITS), False: np.ones(1 << q.BITS)}
    for i, text in rows:
        for k in q.buckets(np.frombuffer(text.encode(), np.uint8)):
            counts[False][k] += 1
            counts[True][k] += i < 60
    ratio = np.rint(q.SCALE * np.log((counts[True] / counts[True].sum()) / (counts[False] / counts[False].sum())))
    assert np.abs(ratio - model.ratios).max() <= 1
    for row in q.assess(documents(rows), model).collect():
        grams = q.buckets(np.frombuffer(row.text.encode(), np.uint8))
        assert abs(row.score - ratio[grams].mean() / q.SCALE) < 1e-3


def test_without_labels_or_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean, _ = _corpus()
    model = q.fit(documents(list(enumerate(clean))), labels)
    assert q.assess(documents(list(enumerate(clean))), model).filter("kept").count() == 60
    model = q.fit(documents([]), labels)
    assert q.assess(documents([]), model).count() == 0


def test_every_label_counts(spark):
    n = 50_000
    corpus = spark.range(n).selectExpr("id AS doc_id", "if(id % 5 = 0, 'xyz', 'abc') AS text")
    labels = corpus.selectExpr("doc_id", "if(doc_id % 5 = 0, 0, 1) AS quality", "0 AS toxic")
    model = q.fit(corpus, labels)
    size = 1 << q.BITS
    trusted, raw = 4 * n // 5, n
    for gram, p, r in (("abc", trusted, trusted), ("xyz", 0, n // 5)):
        ratio = np.log((p + 1) / (trusted + size) / ((r + 1) / (raw + size)))
        assert model.ratios[q.buckets(np.frombuffer(gram.encode(), np.uint8))[0]] == np.rint(q.SCALE * ratio), gram
