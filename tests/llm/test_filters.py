from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
from brute import WORD, frame, odd_rows

from caremarts.llm import filters as X

LABELS = "doc_id long, quality int, toxic int"


def plain_flags(rows):
    """Five flags of each (doc_id, text) row, as the filters are worded."""
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        copies = [j for j, u in rows if (u or "") == t and j is not None and i is not None and j < i]
        out.append(
            (
                len(w) < 100,
                100 * len(set(w)) < 80 * len(w),
                100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                bool(re.search(r"[#$%&*|]", t)),
                bool(copies),
            )
        )
    return out


def plain_audit(rows, labels):
    """Every order walked document by document; rows are (doc_id, lang, text)."""
    flags = plain_flags([(i, t) for i, _, t in rows])
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    parts, out = {}, {}
    for (i, lang, _), f in zip(rows, flags):
        parts.setdefault(lang or "", []).append((i, f))
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, x in enumerate(order):
                own = "ABCDE".index(x)
                gone = [d for d in left if d[1][own]]
                before = len(left)
                left = [d for d in left if not d[1][own]]
                shapley[x] += len(gone)
                out[part, order, k + 1] = [
                    len(left),
                    before - len(left),
                    sum(f[own] for _, f in docs) - len(gone),
                    sum(f[own] and sum(f) == 1 for _, f in docs),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                    x,
                ]
        for (p, *_), v in out.items():
            if p == part:
                v[-1] = shapley[v[-1]] if isinstance(v[-1], str) else v[-1]
    return {k: tuple(v) for k, v in out.items()}


def corpus():
    rnd = random.Random(9)
    texts = []
    for _ in range(120):
        n = rnd.choice([3, 60, 99, 100, 101, 180])
        word = rnd.choice(["w{}", "W{}", "WORD{}", "Wört{}"])
        t = " ".join(word.format(rnd.randrange(rnd.choice([40, 400, 4000]))) for _ in range(n))
        texts.append(t + rnd.choice(["", "", " #", " a|b"]))
    texts += texts[:20] + ["", None, "same", "same"]
    langs = [rnd.choice(["en", "de", None, ""]) for _ in texts]
    return [(i, lang, t) for i, (lang, t) in enumerate(zip(langs, texts))]


def audit(spark, rows, labels, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    got = X.filter_audit(docs, spark.createDataFrame(labels, LABELS), **kw).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}


def test_equal_to_walking_every_order(spark):
    rows = corpus()
    rnd = random.Random(1)
    labels = [(i, rnd.randrange(2), rnd.randrange(2)) for i, _, _ in rows if i % 3]
    want = plain_audit(rows, labels)
    assert audit(spark, rows, labels, shard_bytes=6000) == want  # several shards in a task


def test_limits_are_exact(spark):
    w = lambda n, d: " ".join(f"w{i % d}" for i in range(n))
    texts = [w(99, 99), w(100, 100), w(100, 80), w(100, 79), "A" + "a" * 9, "AA" + "a" * 9, "A" + "é" * 9, "x%", ""]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.a, r.b, r.c, r.d, r.e) for r in X.filter_flags(frame(spark, texts)).collect()}
    assert got == dict(zip(range(len(texts)), plain_flags(rows)))
    assert [got[i][1] for i in range(4)] == [False, False, False, True]
    assert [got[i][2] for i in (4, 5, 6)] == [False, True, False]


def test_matrix_has_every_word_under_one_number(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    shards = X.stored(X.term_shards(docs, 5000), "test")
    numbers = X.numbered(shards)
    words = X.dictionary(numbers).collect()
    name = {r.id: r.word for r in words}
    assert len(set(name.values())) == len(name) == len(words)
    found = {}
    shard_rows = X.global_shards(shards, numbers).collect()
    assert len(shard_rows) > 4
    for s in shard_rows:
        indptr, ids, counts = (np.frombuffer(x, t) for x, t in ((s.indptr, "<i8"), (s.ids, "<i8"), (s.counts, "<i4")))
        for k, d in enumerate(s.docs):
            cells = slice(indptr[k], indptr[k + 1])
            found[d.doc_id] = {name[i]: n for i, n in zip(ids[cells], counts[cells])}
    for i, _, t in rows:
        own = WORD.findall(t or "")
        assert found[i] == {w: own.count(w) for w in set(own)}


def test_odd_rows(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as a", "2 as Words", "3 as digest", "4 as part", "5 as good")
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    labels = [(7, 1, 0), (7, 0, 1), (None, 1, 1), (99, 1, 1), (1, None, None)]
    got = X.filter_audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    # a null id has no label and is no copy of anything
    want = plain_audit(rows, [x for x in labels if x[0] is not None])
    assert found == want and len(found) == 4 * 600
    assert X.filter_audit(docs.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert sum(r.good_lost + r.toxic_lost for r in X.filter_audit(docs, none).collect()) == 0
