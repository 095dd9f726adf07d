from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import frame, odd_rows, words

from caremarts.llm import lm as L


def corpus(n=400):
    """Words that follow each other by a rule, so that context tells something."""
    rnd = random.Random(3)
    out = []
    for _ in range(n):
        w, text = rnd.randrange(60), []
        for _ in range(rnd.randint(1, 80)):
            text.append(f"Word{w}" if rnd.random() < 0.9 else f"rare{rnd.randrange(4000)}")
            w = (w * 7 + 1) % 60 if rnd.random() < 0.8 else rnd.randrange(60)
        out.append(" ".join(text))
    return out + [None, "", "unseen words only"]


def base_scores(texts):
    count = Counter()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    for t, h in zip(texts, held):
        if not h:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    out = []
    for t, h in zip(texts, held):
        tokens = [*words(t), None]
        out.append((h, len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


@pytest.mark.parametrize("known", [L.KNOWN, 30])
def test_counts_and_base_scores(spark, monkeypatch, known):
    monkeypatch.setattr(L, "KNOWN", known)  # with 30, most counts come from the join
    texts = corpus()
    got = {r.doc_id: r for r in L.lm_scores(frame(spark, texts)).collect()}
    for i, (held, n, seen, total, base) in enumerate(base_scores(texts)):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, seen, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    if known > 30:
        mean = lambda f: sum(f(r) for r in got.values() if r.held_out) / sum(r.n_tokens for r in got.values() if r.held_out)
        assert mean(lambda r: r.score) > mean(lambda r: r.base_score) + 0.1  # the context helps on held-out texts


def test_probabilities_of_a_context_sum_to_one():
    tokens = np.arange(1, 40, dtype=np.uint64) * np.uint64(7919)
    tokens[0] = L.END_HASH
    counts = L.Counts(tokens, np.arange(40, 1, -1), int(np.arange(40, 1, -1).sum()) + 9, 45)
    model = L.LogBilinear(counts)
    one, two = np.array([1, 2, 0]), np.array([1, 0, 5])
    score = model.predicted(one, two) @ model.target.T + model.bias
    assert np.allclose(np.exp(score - model.log_normaliser(one, two)[:, None]).sum(1), 1, atol=1e-4)
    # inside the class of rare words: its tokens' smoothed counts, and one share for the unseen
    assert counts.class_count[L.RARE] == 9 and counts.rare_distinct == 45 - 39


def test_contexts_do_not_cross_texts():
    ends = np.array([0, 3, 4, 6])
    kinds = np.array([5, 6, L.END, L.END, 7, L.END])
    one, two = L.contexts(kinds, ends)
    assert one.tolist() == [1, 5, 6, 1, 1, 7] and two.tolist() == [1, 1, 5, 1, 1, 1]


def test_odd_rows_empty_table_and_no_training(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as times", "2 as Score", "3 as row_key")
    rows = L.lm_scores(docs).collect()
    assert len(rows) == docs.count() and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 7}) == 1
    assert L.lm_scores(docs.limit(0)).count() == 0
    untaught = L.score_texts(docs, "false").collect()
    assert {r.train_tokens for r in untaught} == {0} and {r.n_known for r in untaught} == {0}


def test_scores_recomputed_token_by_token(spark, monkeypatch):
    monkeypatch.setattr(L, "CLASSES", 20)  # most words share a class, in several blocks
    monkeypatch.setattr(L, "BLOCK", 16)
    texts = corpus(120)
    rows = frame(spark, texts).selectExpr("doc_id", "coalesce(text, '') as text", "doc_id % 5 = 0 as held_out")
    counted, counts, model, shared = L.taught(rows.where("not held_out"))
    assert counts.blocks > 10 and np.abs(shared.target).max() > 0
    seen = Counter(w for i, t in enumerate(texts) if i % 5 for w in [*words(t), None])
    hashes = {w: L.END_HASH if w is None else int(L.hash_words(L.pa.array([w]))[0]) for t in texts for w in [*words(t), None]}
    at = {int(v): i for i, v in enumerate(counts.tokens)}

    def kind(w):
        return L.END if w is None else int(counts.class_of[at[hashes[w]]]) if hashes[w] in at else L.RARE

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    rare_total = counts.class_count[L.RARE] + counts.rare_distinct + 1
    got = {r.doc_id: r.score for r in L.scored(rows, counted, counts, model, shared).collect()}
    for i, text in enumerate(texts):
        one = two = L.END
        want = 0.0
        for w in [*words(text), None]:
            hat = model.context[one] @ model.maps[0] + model.context[two] @ model.maps[1]
            k = kind(w)
            p = softmax(model.target @ hat + model.bias)[k]
            if k == L.RARE and seen[w]:
                rank = int(counts.rank_of[at[hashes[w]]])
                own = slice(rank // L.BLOCK * L.BLOCK, (rank // L.BLOCK + 1) * L.BLOCK)
                inside = softmax(shared.target[own].astype(np.float32) @ hat + shared.bias[own])[rank % L.BLOCK]
                p *= inside * counts.smoothed[own].sum() / rare_total
            elif k == L.RARE:
                p /= rare_total
            want += math.log10(p)
            one, two = k, one
        assert math.isclose(got[i], want, rel_tol=1e-4, abs_tol=1e-3), i
    # the shared class: its words' shares, and one for the unseen, sum to one
    assert math.isclose(counts.block_mass.sum() + 1, rare_total)


def test_blocks_learned_in_several_tasks_help_on_held_out_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "CLASSES", 34)  # half of the words that follow by a rule share a class
    monkeypatch.setattr(L, "SHARE", 2000)
    rows = frame(spark, corpus()).selectExpr("doc_id", "coalesce(text, '') as text", "doc_id % 5 = 0 as held_out").repartition(6, "doc_id")
    counted, counts, model, shared = L.taught(rows.where("not held_out"))
    assert counts.block_mass.max() > 2 * L.SHARE
    mean = lambda w: L.scored(rows, counted, counts, model, w).where("held_out").selectExpr("sum(score) / sum(n_tokens)").first()[0]
    assert mean(shared) > mean(L.BlockWords(counts))  # those by the counts alone
