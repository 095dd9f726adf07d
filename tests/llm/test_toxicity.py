from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import frame, odd_rows

from caremarts.llm import toxicity as X

RUDE = {"en": ["vilething", "nastyone"], "de": ["grobus", "grobix"]}


def corpus(n=900, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        words = [f"{lang}{rnd.randrange(3000)}" for _ in range(rnd.randint(5, 200))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words)), rnd.choice(RUDE[lang]) + rnd.choice(["", "!", ","]))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, _, y in rows}


def test_held_out_documents_are_told_apart(tables):
    docs, labels, toxic = tables
    rows = [r for r in X.toxicity_scores(docs, labels).collect() if r.held_out]
    y = np.array([toxic[r.doc_id] for r in rows])
    p = np.array([r.predicted for r in rows])
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)
    assert p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.05
    assert all(r.toxic_flag == (r.score >= r.threshold) for r in rows)


def test_scores_depend_on_the_text_alone(tables, spark):
    docs, labels, _ = tables
    net = X.fit(docs, labels)
    one = {r.doc_id: r.score for r in X.score(docs, net).collect()}
    moved = docs.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source", "0 as n_chars").repartition(7)
    two = {r.doc_id: r.score for r in X.score(moved, net).collect()}
    assert one.keys() == two.keys() and all(abs(one[i] - two[i]) < 1e-6 for i in one)


def test_labels_outside_training_teach_nothing(tables, spark):
    docs, labels, _ = tables
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    a = {r.doc_id: r.score for r in X.toxicity_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in X.toxicity_scores(docs, flipped).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_model_survives_packing():
    net = X.TextCnn.fresh()
    net.thresholds = {"de": 0.4, "": 0.2}
    again = X.TextCnn.loaded(net.dumped())
    texts = pa.array(["one two three", "", None])
    assert np.allclose(net.scores(texts), again.scores(texts)) and again.thresholds == net.thresholds


def test_pooling_is_the_maximum_over_all_places():
    net = X.TextCnn.fresh()
    texts = ["a b c d", "", "x"]
    offsets, codes, words = X.coded_words(pa.array(texts))
    features = X.word_features(words)
    best, _, _ = net.pooled(features, codes, offsets)
    pad = [np.zeros(X.DIM)] * (max(X.WIDTHS) - 1)
    for d, t in enumerate(texts):
        emb = [net.table[f].sum(0) for f in features[codes[offsets[d] : offsets[d + 1]]]] + pad
        for i, (k, conv) in enumerate(zip(X.WIDTHS, net.convs)):
            want = np.max([sum(emb[p + j] @ conv[j] for j in range(k)) for p in range(len(emb) - k + 1)] + [np.zeros(X.FILTERS)], axis=0)
            own = slice(i * X.FILTERS, (i + 1) * X.FILTERS)
            assert np.allclose(best[d, own] - net.shift[own], want, atol=1e-5), t


def test_one_class_or_no_labels(spark):
    docs = frame(spark, ["some text", "more text"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = spark.createDataFrame([(0, 1, 0), (1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, clean):
        assert {r.score for r in X.toxicity_scores(docs, labels).collect()} == {0.0}


def test_odd_rows_and_empty_table(tables, spark):
    docs, labels, _ = tables
    net = X.fit(docs, labels)
    odd = odd_rows(spark).selectExpr("*", "'x' as Score", "1 as THRESHOLD")
    rows = X.score(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] and by_id[5] == by_id[6]
    assert X.score(odd.limit(0), net).count() == 0


def test_rows_beyond_the_first_teach_and_calibrate(spark):
    """A rude word that none of the first rows holds is learned from the others, in several tasks."""
    rows = corpus(1500, seed=11)
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows], "doc_id long, text string, lang string").cache()
    first = docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, 2), 1 << 30) / double(1 << 30) as lot")
    lot = {r.doc_id: r.lot for r in first.collect()}
    toxic = [i for i, _, _, y in rows if y]
    few = 60
    late = {i for i in toxic if lot[i] >= few / len(toxic) and i % 2}
    docs = docs.selectExpr("doc_id", "lang", "regexp_replace(text, 'xxxx', '') as text").collect()
    said = [(r.doc_id, " ".join([*r.text.split()[:20], "latevilest"] if r.doc_id in late else r.text.split()), r.lang) for r in docs]
    for word in ("vilething", "nastyone", "grobus", "grobix"):
        said = [(i, t.replace(word, "plain") if i in late else t, g) for i, t, g in said]
    docs = spark.createDataFrame(said, "doc_id long, text string, lang string").repartition(6)
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows], "doc_id long, toxic int")
    part = X.fit(docs, labels.where(labels.doc_id.isin([i for i in lot if i not in late])), toxic_rows=few, clean_rows=200)
    net = X.fit(docs, labels, toxic_rows=few, clean_rows=200)
    rude = pa.array([t for i, t, _ in said if i in late])
    assert net.scores(rude).mean() > part.scores(rude).mean() + 0.2
    assert set(net.thresholds) == {"en", "de"} and all(0.1 <= x <= 0.9 for x in net.thresholds.values())


def test_thresholds_come_from_all_held_back_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(X, "calibrate", lambda net, rows: seen.append(rows.count()))
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in corpus(800)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in corpus(800)], "doc_id long, toxic int")
    X.fit(docs, labels, toxic_rows=30, clean_rows=40)
    assert seen == [docs.where("pmod(xxhash64(doc_id, 3), 5) = 0").count()]
