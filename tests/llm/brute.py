"""Slow and plain versions of the operators, and the rows that every operator must bear."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, first=0):
    """A documents table of the texts; None stands for a null."""
    rows = [(first + i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_rows(spark):
    """Null id, null and empty text, white space, a long text, ties, a repeated row."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (None, "a text without an id that is long enough to have shingles", "en", "s", 1),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n ", "en", "s", 4),
        (4, long, "de", "s", len(long)),
        (5, "the same text stands here two times", "en", "s", 5),
        (6, "the same text stands here two times", "en", "s", 5),
        (7, "this row is repeated as it is", "en", "s", 5),
        (7, "this row is repeated as it is", "en", "s", 5),
        (8, "é 中文 😀 ß İ́ \x1c\x85 end", "fr", "s", 5),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lowered(text))


def shingle_set(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def near_components(texts: dict):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter()
    for own in holders.values():
        for n, a in enumerate(own):
            for b in own[n + 1 :]:
                shared[a, b] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def without_windows(texts: list, depth: int):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[p : p + depth] for d in data for p in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - depth + 1):
            if count[d[p : p + depth]] > 1:
                gone[p : p + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for p in range(len(d)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def substring_distance(item, text):
    """Least edit distance of the item to any substring of the text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            now[j] = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (c != d))
        before = now
    return min(before)
