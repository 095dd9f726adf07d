from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import frame, near_components, odd_rows, shingle_set

from caremarts.llm import components as C
from caremarts.llm import neardup as N


def family(rnd, n, size, edits):
    """A text and copies with ``edits`` words replaced."""
    base = [f"v{rnd.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(size)] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def corpus():
    rnd = random.Random(2)
    texts = [" ".join(f"r{rnd.randrange(10**5)}" for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    for size, edits in ((40, 2), (60, 4), (80, 6), (30, 1)):
        texts += family(rnd, 12, size, edits)
    passage = " ".join(f"p{i}" for i in range(50))  # shared by texts that are otherwise different
    texts += [f"{passage} " + " ".join(f"q{rnd.randrange(10**6)}" for _ in range(25)) for _ in range(25)]
    texts += [texts[41].upper(), texts[41] + " ", "a b c", "A\tb\nc", "a b c d", None, "", "  "]
    return texts


def test_components_as_all_pairs_give_them(spark):
    texts = corpus()
    want = near_components(dict(enumerate(texts)))
    got = {r.doc_id: r for r in N.near_duplicates(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, (n, component) in want.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, component, component == i), texts[i]


def test_blocks_of_a_large_bucket_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 3)
    texts = corpus()
    want = near_components(dict(enumerate(texts)))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(frame(spark, texts)).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_rounds_over_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_EDGES", 40)
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)] + [(100 + rnd.randrange(80), 100 + rnd.randrange(80)) for _ in range(90)]
    rnd.shuffle(chain)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    nodes, least = C.least_reachable(*(np.array(x) for x in zip(*[(a, b) for a, b in chain if a != b])))
    assert got == dict(zip(nodes.tolist(), least.tolist()))


def test_shingles_are_the_distinct_ones():
    texts = ["a b c d e f a b c d e", "x", None, "", "One  two\nthree four five"]
    hashes, offsets = N.shingles(pa.array(texts))
    assert np.diff(offsets).tolist() == [len(shingle_set(t)) for t in texts]


def test_odd_rows_and_empty_table(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as component_id", "'x' as node", "2 as KEY")
    rows = N.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[None][0].component_id is None and not by_id[None][0].kept
    assert [by_id[i][0].n_shingles for i in (1, 2, 3)] == [0, 0, 0]
    assert by_id[6][0].component_id == 5 and not by_id[6][0].kept and by_id[5][0].kept
    assert [r.component_id for r in by_id[7]] == [7, 7]
    assert N.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share, least", [(0.75, 0.9999), (0.8, 0.99999)])
def test_chance_to_share_a_table(share, least):
    p = share**N.ROWS
    n = N.COLLECTIONS
    assert 1 - (1 - p) ** n - n * p * (1 - p) ** (n - 1) > least
