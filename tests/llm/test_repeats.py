from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from brute import frame, odd_rows, without_windows

from caremarts.llm import repeats as R


SMALL = R.Shape(depth=24, gram=10, stretch=4)  # small texts hold many such windows


def corpus():
    rnd = random.Random(6)
    make = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    shared = [make(rnd.randint(20, 90)) for _ in range(6)]
    texts = []
    for _ in range(70):
        parts = [make(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randrange(len(p))
            parts += [p[a : a + rnd.randint(5, 90)], make(rnd.randint(0, 30))]
        texts.append("".join(parts))
    base = make(300)
    for _ in range(8):  # near copies
        own = list(base)
        for _ in range(4):
            own[rnd.randrange(len(own))] = "z"
        texts.append("".join(own))
    return texts + [texts[3], texts[3], "ab" * 60, "c" * 90, "d" * 24, "e" * 23, "", None, base]


def test_removed_bytes_as_all_windows_give_them(spark):
    texts = corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.without_repeats(frame(spark, texts), SMALL).collect()}
    want = without_windows(texts, SMALL.depth)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] > 0 for w in want) > 30 and sum(0 < w[1] < w[0] for w in want) > 20


def test_small_blocks_change_nothing(spark):
    texts = corpus()
    want = without_windows(texts, SMALL.depth)
    shape = R.Shape(depth=24, gram=10, stretch=4, block=50)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.without_repeats(frame(spark, texts), shape).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_runs_hold_every_window_once():
    texts = corpus()
    r = R.runs(pa.array(texts), R.Rolling(1, SMALL))
    for i, t in enumerate(texts):
        own = r["row"] == i
        seen = [p for a, b in zip(r["start"][own], r["end"][own]) for p in range(a, b + 1)]
        assert sorted(seen) == list(range(max(0, len((t or "").encode()) - SMALL.depth + 1)))


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 1000, 137).astype(np.uint64)
    for w in (1, 2, 7, 50, 137):
        assert R.sliding_least(x, w).tolist() == [x[i : i + w].min() for i in range(len(x) - w + 1)]


def test_full_depth(spark):
    rnd = random.Random(9)
    make = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = make(450)
    texts = [make(300) + passage + make(100), make(50) + passage, passage[:399] + make(80), make(2000), passage[25:435]]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.without_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == without_windows(texts, 400)


def test_odd_rows_and_empty_table(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as k1", "2 as Kept", "3 as spans")
    rows = R.without_repeats(docs).collect()
    assert len(rows) == docs.count() and all(r.n_removed in (0, r.n_bytes) for r in rows if r.doc_id != 4)
    assert R.without_repeats(docs.limit(0)).count() == 0
    twice = docs.where("doc_id = 4")
    assert all(r.n_removed == r.n_bytes for r in R.without_repeats(twice.union(twice)).collect())


def test_passages_of_over_fifty_words_are_told(spark):
    rnd = random.Random(12)
    make = lambda n: [f"{rnd.choice('abcdefgh')}{rnd.randrange(3000)}" for _ in range(n)]
    passage = make(58)  # less than 400 bytes
    assert len(" ".join(passage).encode()) < 400
    texts = [
        make(90) + passage + make(70),
        make(10) + passage[4:55] + make(200),
        passage[:50] + make(100),
        make(3) + passage[8:],
        make(300),
        passage[:20],
        [],
    ]
    texts = [*(" ".join(t) for t in texts), None, "\n ".join(make(30) + passage[2:54]), " ".join(passage).upper()]
    windows = [{tuple(w[i : i + 51]) for i in range(len(w) - 50)} for w in ((t or "").split() for t in texts)]
    want = [any(a & b for j, b in enumerate(windows) if i != j) for i, a in enumerate(windows)]
    rows = {r.doc_id: r for r in R.without_repeats(frame(spark, texts)).collect()}
    assert [rows[i].has_passage for i in range(len(texts))] == want and sum(want) == 3
    assert not any(r.n_removed for r in rows.values())  # the contract's windows are of 400 bytes


def test_passages_as_all_word_windows_give_them(spark):
    rnd = random.Random(13)
    make = lambda n: [rnd.choice("abcdefghijklmnop") for _ in range(n)]
    shared = [make(rnd.randint(5, 30)) for _ in range(70)]
    lists = [[w for _ in range(rnd.randint(1, 3)) for w in make(rnd.randint(0, 9)) + rnd.choice(shared)[rnd.randint(0, 9) :]] for _ in range(80)]
    lists += [["z"] * 40, ["y"] * 9, lists[0]]
    depth, held = 9, {}
    for i, w in enumerate(lists):
        for at in range(len(w) - depth + 1):
            held.setdefault(tuple(w[at : at + depth]), []).append(i)
    want = {i for own in held.values() if len(own) > 1 for i in own}
    small = R.Shape(depth=depth, gram=4, stretch=2, block=50, words=True)
    rows = R.without_repeats(frame(spark, [" ".join(w) for w in lists]), SMALL, small).collect()
    assert {r.doc_id for r in rows if r.has_passage} == want and 10 < len(want) < len(lists) - 5
