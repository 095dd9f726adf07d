"""Benchmark decontamination by pigeonhole edit matching (operator 8).

An item of m characters may be met with up to k = floor(``BUDGET`` * m) edits.
Split into k + 1 pieces, one piece at least stands unchanged in any such match.
One pass of an Aho-Corasick automaton over each whole text finds all piece
hits. Pieces are the leaves of a tree: a part of L pieces has L - 1 edits, and in
any match within k edits some piece stands unchanged whose parts, up to the whole
item, all keep to theirs (if each half of a part went over, the part would too).
So a hit is first held against its smallest part, some 20 characters, then against
larger ones; where it passes all, Myers' bit-parallel search over the item's window
(its length and k on either side) confirms it. No match is lost by this.

Items are broadcast in blocks of at most ``BLOCK_BYTES`` of text, one pass over
the documents for each block, so no broadcast grows with the benchmark.
Comparing is by lower-cased text with line ends and tabs as spaces.

Items of fewer than ``SHORT`` characters must be met unchanged and between word
bounds, since with edits ordinary sentences would match them. ``least_chars``
says which short items are searched at all: none by default, all that hold a
letter or digit with 1 (as the registered query and the pipeline ask).

Cases: null and empty texts match nothing; items that are null, shorter than
``least_chars`` or short without a letter or digit are left out; repeated items are each reported; repeated rows are each reported, null
ids as null; an empty benchmark or an empty table gives an empty result; columns
beyond the named are not read, and ``without_leaks`` passes them on; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import map_pieces, quoted, texts

BUDGET = 0.1
SHORT = 30  # items of fewer characters are met unchanged, between word bounds
LEAST_CHARS = SHORT
BLOCK_BYTES = 1 << 20

MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("distance", T.IntegerType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def folded(text: str) -> str:
    """Lower case by code point, line ends and tabs as spaces; the length stays."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.replace("\n", " ").replace("\t", " ").replace("\r", " ")


def cut(item: str, budget: int) -> list[tuple[int, str]]:
    """The item in ``budget`` + 1 pieces of nearly equal length, with their places."""
    n = budget + 1
    at = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def parts_of(n: int) -> list[list[tuple[int, int]]]:
    """For each of ``n`` pieces, the parts (first piece, end) of the tree that hold it.

    The smallest comes first; the piece itself and the whole are left out.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    open_ = [(0, n)]
    while open_:
        a, b = open_.pop()
        if b - a < 2:
            continue
        if b - a < n:
            for i in range(a, b):
                out[i].insert(0, (a, b))
        open_ += [(a, (a + b) // 2), ((a + b) // 2, b)]
    return out


def myers(masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and where that ends.

    ``masks`` holds for each character the pattern's positions as bits. Gives
    (``most`` + 1, -1) if no substring is within ``most`` edits; the first of
    the best ends otherwise.
    """
    top, every = 1 << (m - 1), (1 << m) - 1
    pv, mv, score, best, end = every, 0, m, most + 1, -1
    get = masks.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        pv = ((mh << 1) | ~(xv | ph)) & every
        mv = ph & xv & every
        if score < best:
            best, end = score, i + 1
    return best, end


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return dict(out)


def bounded(text: str, first: int, end: int) -> bool:
    """Whether no word of ``text`` goes on over either end of a span."""
    goes_on = lambda i: 0 < i < len(text) and text[i - 1].isalnum() and text[i].isalnum()
    return not goes_on(first) and not goes_on(end)


class ItemBlock:
    """The automaton over the pieces of a block of items, and what verifying needs."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        self.ids = [i for i, _ in items]
        self.items = [t for _, t in items]
        self.budget = [int(share * len(t)) if len(t) >= SHORT else 0 for t in self.items]
        self.masks = [masks_of(t) for t in self.items]
        self.reverse = [masks_of(t[::-1]) for t in self.items]
        places: dict[str, list[tuple[int, int, list]]] = defaultdict(list)
        for n, t in enumerate(self.items):
            split = cut(t, self.budget[n])
            bounds, masks = [at for at, _ in split] + [len(t)], {}
            for (at, piece), above in zip(split, parts_of(len(split))):
                parts = []
                for a, b in above:
                    lo, hi = bounds[a], bounds[b]
                    if (a, b) not in masks:
                        masks[a, b] = masks_of(t[lo:hi])
                    parts.append((lo - at, hi - at, b - a - 1, masks[a, b]))
                places[piece].append((n, at, parts))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        """The best match of each item within its budget."""
        begin: dict[int, set[int]] = defaultdict(set)
        for last, (size, where) in self.automaton.iter(text):
            for n, at, parts in where:
                first = last + 1 - size
                if len(self.items[n]) < SHORT and not bounded(text, first, first + size):
                    continue
                if first - at not in begin[n] and self._upheld(text, first, parts):
                    begin[n].add(first - at)
        out = []
        for n, starts in begin.items():
            item, k = self.items[n], self.budget[n]
            best = (k + 1, -1)
            for lo, hi in self._windows(sorted(starts), k, len(item), len(text)):
                if item in text[lo:hi]:
                    found = (0, text.index(item, lo) + len(item))
                else:
                    d, e = myers(self.masks[n], len(item), text[lo:hi], k)
                    found = (d, lo + e)
                if found[0] <= k and found < best:
                    best = found
            if best[0] <= k:
                d, end = best
                lo = max(0, end - len(item) - k)
                _, back = myers(self.reverse[n], len(item), text[lo:end][::-1], d)
                out.append({"item_id": self.ids[n], "distance": d, "start": end - back, "end": end})
        return out

    @staticmethod
    def _upheld(text: str, first: int, parts: list) -> bool:
        """Whether all parts around a piece met at ``first`` keep to their edits."""
        for lo, hi, most, masks in parts:
            around = text[max(0, first + lo - most) : first + hi + most]
            if myers(masks, hi - lo, around, most)[0] > most:
                return False
        return True

    @staticmethod
    def _windows(starts: list[int], k: int, m: int, n: int) -> list[tuple[int, int]]:
        """Where an item may lie that begins near one of ``starts``; overlapping windows are one."""
        out: list[list[int]] = []
        for s in starts:
            lo, hi = max(0, s - k), min(n, s + m + k)
            if out and lo <= out[-1][1]:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
        return [(a, b) for a, b in out]


def blocks_of(items: DataFrame, column: str, item_id: str, least_chars: int = LEAST_CHARS) -> list[DataFrame]:
    """The items in blocks of about ``BLOCK_BYTES`` of text, dealt by their hash."""
    usable = items.select(
        quoted(item_id).cast("long").alias("item_id"), quoted(column).alias("text")
    )
    size = F.length("text")
    usable = usable.where((size >= least_chars) & ((size >= SHORT) | F.col("text").rlike("[\\p{L}\\p{N}]")))
    size = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    if n <= 1:
        return [usable] if n else []
    return [usable.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == i) for i in range(n)]


def shared_blocks(
    items: DataFrame, column: str = "text", item_id: str = "item_id", least_chars: int = LEAST_CHARS
) -> list:
    """Broadcasts of the items, block by block."""
    out = []
    for block in blocks_of(items, column, item_id, least_chars):
        rows = sorted((r["item_id"] is None, r["item_id"] or 0, folded(r["text"])) for r in block.collect())
        listed = [(None if null else i, t) for null, i, t in rows]
        out.append(items.sparkSession.sparkContext.broadcast(listed))
    return out


def matched(df: DataFrame, shared, column: str = "text", budget: float = BUDGET) -> DataFrame:
    """Add ``matches``: the best match of each item of a block in the text."""

    def setup():
        own = ItemBlock(shared.value, budget)
        return lambda piece: [[own.matches(folded(t)) for t in texts(piece, column)]]

    return map_pieces(df, column, [T.StructField("matches", MATCH)], setup)


def leaks(docs: DataFrame, items: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """A row for each document and item met in it: distance and span (code points)."""
    found = [
        matched(docs.select("doc_id", "text"), shared)
        .select("doc_id", F.explode("matches").alias("m"))
        .select("doc_id", "m.*")
        for shared in shared_blocks(items, least_chars=least_chars)
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, start int, end int")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_leaks(
    docs: DataFrame, items: DataFrame, column: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """The rows of ``docs`` in which no item is met."""
    columns = [quoted(c) for c in docs.columns]
    for shared in shared_blocks(items, least_chars=least_chars):
        docs = matched(docs, shared, column).where(F.size("matches") == 0).select(*columns)
    return docs
