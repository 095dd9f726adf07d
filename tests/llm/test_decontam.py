from __future__ import annotations

import random

from brute import frame, odd_rows, substring_distance

from caremarts.llm import decontam as D


def spoiled(rnd, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rnd.randrange(len(out) + 1)
        out[i : i + rnd.randint(0, 1)] = rnd.choice(["", "x", "q "])
    return "".join(out)


def corpus():
    rnd = random.Random(8)
    make = lambda n: "".join(rnd.choice("abcdefgh ij") for _ in range(n))
    items = [(i, make(rnd.randint(30, 180))) for i in range(15)]
    texts = []
    for n in range(60):
        text = make(rnd.randint(0, 200))
        if n % 2:
            item = rnd.choice(items)[1]
            at = rnd.randint(0, len(text))
            text = text[:at] + spoiled(rnd, item, rnd.randint(0, len(item) // 9)) + text[at:]
        texts.append(text)
    return items, texts


def test_leaks_as_the_edit_distance_gives_them(spark):
    items, texts = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(frame(spark, texts), bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in items:
            k = substring_distance(D.folded(item), D.folded(t))
            if k <= int(D.BUDGET * len(item)):
                want[d, i] = k
    assert {k: r.distance for k, r in got.items()} == want and 15 < len(want) < 100
    for (d, i), r in got.items():
        span = D.folded(texts[d])[r.start : r.end]
        assert substring_distance(span, D.folded(dict(items)[i])) <= substring_distance(D.folded(dict(items)[i]), span) + 1
        assert substring_distance(D.folded(dict(items)[i]), span) == r.distance


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items, texts = corpus()
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), frame(spark, texts)
    whole = sorted(D.leaks(docs, bench).collect())
    kept = sorted(r.doc_id for r in D.without_leaks(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", 400)
    assert len(D.blocks_of(bench, "text", "item_id")) > 3
    assert sorted(D.leaks(docs, bench).collect()) == whole
    assert sorted(r.doc_id for r in D.without_leaks(docs, bench).collect()) == kept
    assert set(kept) == set(range(len(texts))) - {r.doc_id for r in whole}


def test_case_and_line_ends_do_not_matter(spark):
    item = "The quick brown fox\njumps over the lazy dog again"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short")], "item_id long, text string")
    docs = frame(spark, ["xx " + item.upper().replace("\n", " ") + " yy", "nothing", "too short"])
    assert [(r.doc_id, r.item_id, r.distance) for r in D.leaks(docs, bench).collect()] == [(0, 1, 0)] * 2


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as Matches")
    bench = spark.createDataFrame([(1, "this row is repeated as it is")], "item_id long, text string")
    bench = bench.selectExpr("item_id", "concat(text, ' and more') as text").union(
        bench.selectExpr("item_id + 1", "'the same text stands here two times'")
    )
    found = sorted((r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect())
    assert found == [(5, 2), (6, 2)]
    kept = D.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert D.leaks(docs, bench.limit(0)).count() == 0 and D.without_leaks(docs, bench.limit(0)).count() == docs.count()
    assert D.leaks(docs.limit(0), bench).count() == 0


def test_a_tenth_of_an_item_may_be_edited(spark):
    rnd = random.Random(10)
    make = lambda n: "".join(rnd.choice("abcdefgh ij") for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate((95, 95, 95, 394, 394, 30))]
    texts = []
    for _, item in items:
        k = len(item) // 10
        for edits in (k, k + 1):
            at = {round((j + 0.5) * len(item) / edits) for j in range(edits)}
            assert len(at) == edits
            texts.append(make(50) + "".join("#" if j in at else c for j, c in enumerate(item)) + make(50))
    found = D.leaks(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(2 * i, i, len(t) // 10) for i, t in items]


def test_parts_lose_no_match(monkeypatch):
    items, texts = corpus()
    block = D.ItemBlock([(i, D.folded(t)) for i, t in items], D.BUDGET)
    key = lambda rows: sorted(tuple(r.values()) for r in rows)
    found = [key(block.matches(D.folded(t))) for t in texts]
    monkeypatch.setattr(D.ItemBlock, "_upheld", staticmethod(lambda *_: True))  # every hit is searched
    assert any(found) and found == [key(block.matches(D.folded(t))) for t in texts]


def test_short_items_are_met_unchanged_between_word_bounds(spark):
    items = [(1, "too short"), (2, "Was it?"), (3, "..."), (4, ""), (5, None), (6, "a" * 29), (7, "b" * 30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        "it is Too\nshort, really",
        "it is too shorty",
        "stoodtoo short",
        "into short too  short",
        "what was it? this... too short",
        "was itx was it",
        "a" * 29,
        "a" * 28 + "x",
        "b" * 29 + "x",
    ]
    found = sorted((r.doc_id, r.item_id, r.distance, r.start, r.end) for r in D.leaks(frame(spark, texts), bench, 1).collect())
    assert {f[:2] for f in found if f[1] < 7} == {(0, 1), (4, 1), (4, 2), (6, 6)}
    assert all(d == 0 and D.folded(texts[i])[a:b] == D.folded(dict(items)[n]) for i, n, d, a, b in found if n < 7)
    assert {f[0] for f in found if f[1] == 7} == {8}  # an item of 30 characters keeps its edits
    kept = D.without_leaks(frame(spark, texts), bench, least_chars=1)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 7]
    assert {r.item_id for r in D.leaks(frame(spark, texts), bench).collect()} == {7}
