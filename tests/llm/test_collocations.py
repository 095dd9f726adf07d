from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from brute import frame, lowered, odd_rows

from caremarts.llm import collocations as C


def plain(rows, least, top, longest=4):
    """The report by counting every phrase as it stands."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    kept = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in kept.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and 100 * a >= 80 * f[lang, p[i:j]]:
                    gone.add((lang, p[i:j]))
    found = {}
    for (lang, p), a in kept.items():
        if (lang, p) not in gone:
            cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            row = (" ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
            found.setdefault(lang, []).append(row)
    out = set()
    for lang, rows in found.items():
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out |= {(lang, i + 1, *r) for i, r in enumerate(rows[:top])}
    return out


def report(df, **kw):
    return {tuple(r) for r in C.collocations(df, **kw).collect()}


def corpus(n=150):
    rnd = random.Random(3)
    names = ["To", "to", "ünder", "of", "new york", "a-b", "x\x1cy", "中", "be be be", "run, off", "stop.Go"]
    weigh = [rnd.random() ** 3 + 0.02 for _ in names]
    gap = lambda: rnd.choice([" ", " ", " ", "\t", "  ", ", ", "\n", "!"])
    texts = ["".join(rnd.choices(names, weigh)[0] + gap() for _ in range(rnd.randint(0, 90))) for _ in range(n)]
    return [(("en", "de", None)[i % 3] if i % 7 else "en", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("least,top", [(30, 2000), (3, 5), (8, 2000)])
def test_equal_to_counting_every_phrase(spark, least, top):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    # many shards, so many parts of a stripe
    assert report(df, least=least, top=top, shard_bytes=3000) == plain(rows, least, top)


def test_segments_and_a_full_filter_change_nothing(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "lang string, text string")
    want = plain(rows, 3, 2000)
    assert report(df, least=3, filter_bits=64) == want  # lets everything through
    assert report(df, least=3, shares=1) == want  # no segments
    # nearly every prefix here has more than a thousandth of the words
    stripes = C.phrase_stripes(df, least=3)
    assert stripes[1].groupBy("lang", "prefix").count().where("count > 1").count() > 0
    assert report(df, least=3) == want


def test_totals_are_the_counts_of_the_prefixes(spark):
    rows = corpus(60)
    stripes = C.phrase_stripes(spark.createDataFrame(rows, "lang string, text string"), least=5)
    for shorter, longer in zip(stripes, stripes[1:]):
        counts = {(r.lang, r.phrase): r.f for r in C.extensions(shorter).collect()}
        totals = {(r.lang, r.prefix): r.total for r in C.totals(longer).collect()}
        assert counts and counts.items() <= totals.items()


def test_overlaps_and_pieces(spark):
    rows = [("en", "a a a a a, a a."), ("en", "A a\x0ba"), ("en", None), (None, ""), ("en", " \t ")]
    got = report(spark.createDataFrame(rows, "lang string, text string"), least=1)
    assert got == plain(rows, 1, 2000)
    n = {r[6] for r in got}
    assert n == {10}


def test_odd_rows(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as Phrase", "2 as n", "3 as total")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert report(docs, least=2) == plain(rows, 2, 2000)
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(frame(spark, [None, "", " "])).count() == 0


def test_scores_of_counts_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    schema = "lang string, prefix string, segment int, total long, extensions array<struct<next: string, f: long>>"
    two = [("en", "a", 0, big, [("b", big - 1)]), ("en", "b", 0, big, [])]
    three = [("en", "a b", 0, big - 1, [])]
    stripes = [spark.createDataFrame(x, schema) for x in ([], two, three)]
    (row,) = C.scored_phrases(stripes).collect()
    assert (row.a, row.l, row.r, row.score) == (big - 1, big, big, 2000000 * (big - 1) // (2 * big))
