from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from brute import frame, odd_rows, words

from caremarts.llm import imatch as M


def corpus(n=120):
    rnd = random.Random(5)
    return [" ".join(f"t{int(rnd.paretovariate(0.6))}" for _ in range(rnd.randint(3, 300))) for _ in range(n)]


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_BYTES", 4000)  # many partitions, so many waiting rows
    texts = corpus()
    texts[7] = texts[9]
    rows = M.fingerprints(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    got = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        following = texts[i - 1]  # descending ids; after the first comes the last
        want = M.edited(t, following)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if i and texts[i - 1] == t:
            assert r.near_next == 1
    assert got[7].fingerprint == got[9].fingerprint and len({r.fingerprint for r in rows}) == len(set(texts))
    assert np.mean([r.near_edited for r in rows]) > 3 * np.mean([r.near_next for r in rows])


def test_frequencies_and_band(spark):
    texts = corpus(60)
    df = {}
    for t in texts:
        for w in set(words(t)):
            df[w] = df.get(w, 0) + 1
    docs = frame(spark, texts)
    got = {r.term: r.df for r in M.document_frequencies(docs).collect()}
    names = pa.array(list(df))
    hashes = M.hash_words(names).view(np.int64).tolist()
    assert got == dict(zip(hashes, df.values()))
    kept = M.lexicon(docs, least=0.05, most=0.5)
    assert set(kept.view(np.int64).tolist()) == {h for h, n in zip(hashes, df.values()) if 3 <= n <= 30}


def test_fingerprint_is_of_the_sorted_distinct_lexicon_terms():
    terms = np.sort(M.hash_words(pa.array([f"w{i}" for i in range(3000)])))
    hashes = M.Fingerprinter(terms)
    many = " ".join(f"w{i}" for i in range(200))
    a = hashes(pa.array([many, " ".join(reversed(many.split())) + " w3 w3", many + " outside", many + " w2000", "", None]))
    short, whole = a
    assert (short[0] == short[1]).all() and whole[0] == whole[1]
    assert (short[0] == short[2]).all() and whole[0] != whole[2]  # no lexicon term, so no subset has it
    same = (short[0] == short[3]).mean()
    assert 0.5 < same < 1 or (short[0] == short[3]).all()
    assert not short[4].any() and not short[5].any() and whole[4] == whole[5]


def test_edited():
    assert M.edited("abcdefg", "XYZ") == "abcdeXY" and M.edited("abcdefg", "X") == "abcdeX" and M.edited("ab", "X") == "ab"


def test_odd_rows_and_empty_table(spark):
    docs = odd_rows(spark).selectExpr("*", "1 as part", "2 as FINGERPRINT", "3 as first_text")
    rows = M.fingerprints(docs).collect()
    assert len(rows) == docs.count() and len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert M.fingerprints(docs.limit(0)).count() == 0
    (alone,) = M.fingerprints(frame(spark, ["one document alone"])).collect()
    assert alone.near_next == 1 and alone.near_edited <= 1


def test_copies_do_not_move_the_lexicon(spark):
    texts = corpus(60)
    large = " ".join(f"t{i}" for i in range(1, 400, 3)) + " only here"
    once, often = frame(spark, [*texts, large]), frame(spark, [*texts, *[large] * 40, None, "", texts[3]])
    kept = M.lexicon(often.union(often.limit(0)), least=0.05, most=0.5)
    assert kept.tolist() == M.lexicon(once.union(frame(spark, [""])), least=0.05, most=0.5).tolist()
    got = {r.term: r.df for r in M.document_frequencies(often).collect()}
    assert got == {r.term: r.df for r in M.document_frequencies(once).collect()}


def test_texts_with_few_lexicon_terms_are_told_apart():
    lexicon = np.sort(M.hash_words(pa.array([f"w{i}" for i in range(3000)])))
    hashes = M.Fingerprinter(lexicon)
    rare = [f"rare{i}" for i in range(120)]
    other = [f"other{i}" for i in range(120)]
    texts = [" ".join(x) for x in (rare, [*rare[:-3], "a", "b"], other, ["w1", "w2", *rare[:-1]], ["w1", "w2", *rare[1:]])]
    short, whole = hashes(pa.array(texts))
    like = lambda i, j: M.likeness((short[[i]], whole[[i]]), (short[[j]], whole[[j]]))[0]
    assert (short != 0).any(1).all()
    assert like(0, 1) > 0.5 and like(3, 4) > 0.5 and like(0, 3) > 0.5 and like(0, 2) < 0.1 and like(2, 3) < 0.1
    # a text's own hashes do not depend on the texts beside it
    assert all((hashes(pa.array([t]))[0][0] == s).all() for t, s in zip(texts, short))


def test_near_copies_of_the_largest_group_are_recognised(spark):
    texts, group = corpus(60), [f"g{i}" for i in range(150)]
    near = [" ".join([*group[:-2], f"x{i}", f"y{i}"]) for i in range(20)]
    docs = frame(spark, [*texts, *[" ".join(group)] * 30, *near])
    short, whole = M.Fingerprinter(M.lexicon(docs))(pa.array([" ".join(group), near[0], near[1], texts[0]]))
    like = lambda i, j: M.likeness((short[[i]], whole[[i]]), (short[[j]], whole[[j]]))[0]
    assert like(0, 1) > 0.5 and like(1, 2) > 0.4 and like(0, 3) < 0.1


def test_sixteen_subsets_of_every_rate():
    (one,) = M.packed(*M.Fingerprinter(np.zeros(0, np.uint64))(pa.array(["some text"])))
    assert len(one) == 2 * 16 * len(M.RATES) + 8


def test_terms_that_are_rare_everywhere_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(M, "COUNTED_BYTES", 20_000)  # many pieces
    texts = [*corpus(100), *[f"copy {i % 3}" for i in range(30)], None, ""]
    df = {}
    for t in set(texts) - {None}:
        for w in set(words(t)):
            df[w] = df.get(w, 0) + 1
    docs = frame(spark, texts)
    names = dict(zip(M.hash_words(pa.array(list(df))).view(np.int64).tolist(), df))
    some = {names[r.term] for r in M.common_somewhere(docs, "text", 10, len(texts)).collect()}
    assert {w for w, n in df.items() if n >= 10} <= some and len(some) < len(df) / 4
    among = M.common_somewhere(docs, "text", 10, len(texts))
    got = {names[r.term]: r.df for r in M.document_frequencies(docs, among=among).collect()}
    assert some <= set(got) and len(got) < len(df) / 3 and all(df[w] == n for w, n in got.items())
    least = 10 / len(set(texts) - {None})
    assert {names[t] for t in M.lexicon(docs, least=least, most=0.5).view(np.int64).tolist()} == {
        w for w, n in df.items() if 10 <= n <= len(set(texts) - {None}) // 2
    }
