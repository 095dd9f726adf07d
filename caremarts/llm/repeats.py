"""Repeated byte windows by a depth-limited radix sort of suffixes (operator 10).

A window is ``depth`` (400) bytes of one text. Two suffixes that agree on their first
DEPTH bytes hold equal windows, so sorting suffixes no deeper than DEPTH puts
repeated windows, and nothing else, into groups of two and more. The sort goes
most significant digit first, and a suffix that is alone in its group after a
digit is dropped: the next passes see only suffixes that still tie.

1. Digit one is a ``gram``-byte piece. Sorting it for every suffix would shuffle
   16 bytes for each byte of text, so suffixes share it: of all pieces inside a
   window the one with the least hash is its anchor. Equal windows have equal
   anchors at equal places, and one piece anchors a run of neighbouring suffixes
   (about a hundredth as many rows as bytes). Runs whose anchor occurs once hold
   no repeated window.
2. Digit two is all bytes that the windows of a run cover. Runs that tie on it
   consist of repeated windows only and are finished.
3. The remaining runs are split into stretches of ``stretch`` suffixes, aligned
   to the anchor, with two digits again: the bytes that all windows of a whole
   stretch share, and all bytes that the stretch's windows cover.
4. The last digit of the suffixes that still tie is their whole window.

A run or stretch that is finished takes part in the next pass once, as one of
its copies, where it shares the first digit with an unfinished one. Digits are
64-bit hashes, grouped by shuffles with map-side counts. Bytes covered by a
repeated window are removed.

Passages of over 50 words can have less than DEPTH bytes, which are not removed. The
same passes over words in place of bytes (``WORDS``, windows of 51) find the texts
that hold such a passage that also stands elsewhere; ``has_passage`` says so.

Cases: null and empty texts, and texts shorter than DEPTH bytes, lose nothing;
a text that occurs again, as another row or as the same row repeated, loses
everything if it has DEPTH bytes; windows never cross rows; overlapping repeats
inside one text count; an empty table gives an empty table; other columns are
not returned. Texts of any length are read in blocks of ``block`` suffixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import coded_words, hash_words, map_pieces, mixed, pieces, prefiltered, written

DEPTH = 400


@dataclass(frozen=True)
class Shape:
    """Sizes of a run of the operator, in bytes or words (windows, anchors) and suffixes (stretches, blocks)."""

    depth: int = DEPTH
    gram: int = DEPTH * 2 // 5
    stretch: int = 16
    block: int = 1 << 20
    words: bool = False

    @property
    def span(self) -> int:
        """Pieces inside a window."""
        return self.depth - self.gram + 1


#: Windows of the least passage of over 50 words.
WORDS = Shape(depth=51, gram=20, stretch=4, words=True)


class Rolling:
    """64-bit hashes of all windows of an array of bytes or word hashes, by prefix sums of letter * base**place."""

    def __init__(self, seed: int, shape: Shape):
        self.shape = shape
        rng = np.random.default_rng(seed)
        self.letter = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 1 << 61)) * 8 + 5
        n = shape.block + 2 * shape.depth + 1
        self.power = self._powers(base, n)
        self.back = self._powers(pow(base, -1, 1 << 64), n)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def sums(self, data: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            letter = data if self.shape.words else self.letter[data]
            return np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter * self.power[: len(data)], dtype=np.uint64)])

    def hashes(self, sums: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((sums[to] - sums[at]) * self.back[at])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    table = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    table[: len(x)] = x
    table = table.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and each text's offsets."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def symbols(column: pa.Array, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, or the words' hashes, of all texts one after another, and each text's offsets."""
    if not shape.words:
        return text_bytes(column)
    offsets, codes, words = coded_words(column, lower=False)
    return hash_words(words)[codes], offsets


def blocks(offsets: np.ndarray, shape: Shape):
    """Ranges of bytes that hold at most ``block`` windows and cut no window: (first text, begin, end)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + shape.block, side="right")) - 1
        if to > at:
            yield at, to, int(offsets[at]), int(offsets[to])
            at = to
            continue
        for begin in range(int(offsets[at]), max(int(offsets[at]) + 1, int(offsets[at + 1]) - shape.depth + 1), shape.block):
            yield at, at + 1, begin, min(begin + shape.block + shape.depth - 1, int(offsets[at + 1]))
        at += 1


def runs(column: pa.Array, rolling: Rolling) -> dict[str, np.ndarray]:
    """All windows of the texts as runs of neighbours with the same anchor.

    ``row`` is the text; ``start`` to ``end`` (inclusive) are the windows'
    first bytes and ``anchor`` that of the anchor; ``coarse`` is the anchor's
    hash and ``fine`` that of all bytes the run's windows cover.
    """
    shape = rolling.shape
    data, offsets = symbols(column, shape)
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("row", "start", "end", "anchor", "coarse", "fine")}
    for first, last, begin, end in blocks(offsets, shape):
        n = end - begin - shape.depth + 1
        if n <= 0:
            continue
        sums = rolling.sums(data[begin:end])
        place = np.arange(end - begin - shape.gram + 1)
        grams = rolling.hashes(sums, place, place + shape.gram)
        low = np.uint64((1 << 21) - 1)
        anchor = (sliding_least((grams & ~low) | place.astype(np.uint64), shape.span) & low).astype(np.int64)
        bounds = np.clip(offsets[first : last + 1] - begin, 0, end - begin)
        row = np.searchsorted(bounds, np.arange(n), side="right") - 1
        inside = np.arange(n) + shape.depth <= bounds[row + 1]
        same = inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1])
        heads = np.flatnonzero(inside & np.concatenate([[True], ~same]))
        tails = np.flatnonzero(inside & np.concatenate([~same, [True]]))
        out["row"].append(row[heads] + first)
        base = begin - offsets[row[heads] + first]
        out["start"].append(heads + base)
        out["end"].append(tails + base)
        out["anchor"].append(anchor[heads] + base)
        out["coarse"].append(grams[anchor[heads]])
        out["fine"].append(covering(rolling, sums, heads, tails))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def covering(rolling: Rolling, sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of all bytes that the windows ``first`` to ``last`` cover, and of their number."""
    with np.errstate(over="ignore"):
        number = (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mixed(rolling.hashes(sums, first, last + rolling.shape.depth) + number)


def stretches(data: np.ndarray, spans: dict[str, np.ndarray], rolling: Rolling, width: int) -> dict[str, np.ndarray]:
    """Split the windows ``start`` to ``end`` of each span into stretches of ``width``.

    ``data`` holds all texts' bytes and ``base`` each span's text's place in it.
    With a width of one a stretch is a window, and both its digits are that.
    """
    shape = rolling.shape
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("span", "start", "end", "coarse", "fine")}
    n = spans["end"] - spans["start"] + 1
    size = n + shape.depth - 1
    ends = np.cumsum(size)
    at = 0
    while at < len(n):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + shape.block, side="right")))
        own = slice(at, to)
        place = np.concatenate([[0], np.cumsum(size[own])[:-1]])
        spread = np.arange(int(size[own].sum())) + np.repeat(spans["base"][own] + spans["start"][own] - place, size[own])
        sums = rolling.sums(data[spread])
        span = np.repeat(np.arange(to - at), n[own])
        step = np.arange(len(span)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        window = place[span] + step  # first bytes within the gathered ones
        delta = (spans["anchor"][own] - spans["start"][own])[span] - step
        part = delta // width
        edge = (span[1:] != span[:-1]) | (part[1:] != part[:-1])
        heads = np.flatnonzero(np.concatenate([[True], edge]))
        tails = np.flatnonzero(np.concatenate([edge, [True]]))
        first, last = window[heads], window[tails]
        fine = covering(rolling, sums, first, last)
        if width > 1:
            core = first + delta[heads] - part[heads] * width  # where a whole stretch's last window begins
            with np.errstate(over="ignore"):
                fine = mixed(fine + delta[heads].astype(np.uint64))
                coarse = mixed(rolling.hashes(sums, core, core - (width - 1) + shape.depth) + part[heads].astype(np.uint64))
        else:
            coarse = fine
        out["span"].append(span[heads] + at)
        out["start"].append(spans["start"][own][span[heads]] + step[heads])
        out["end"].append(spans["start"][own][span[tails]] + step[tails])
        out["coarse"].append(coarse)
        out["fine"].append(fine)
        at = to
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


ROWS = "k1 long, k2 long, start int, end int, anchor int, coarse long, fine long, own boolean"


def keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key of two numbers: the id (or the least number) and the text's hash."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text")
    )


def run_rows(texts: DataFrame, shape: Shape) -> DataFrame:
    def run(batches):
        rolling = Rolling(1, shape)
        for batch in batches:
            for piece in pieces(batch, "text"):
                r = runs(piece.column("text"), rolling)
                row = pa.array(r["row"].astype(np.int64))
                yield _batch(piece.column("k1").take(row), piece.column("k2").take(row), r, np.ones(len(row), bool))

    return texts.mapInArrow(run, ROWS)


def _batch(k1: pa.Array, k2: pa.Array, r: dict[str, np.ndarray], own: np.ndarray) -> pa.RecordBatch:
    number = lambda k: pa.array(r[k].astype(np.int32))
    digit = lambda k: pa.array(r[k].astype(np.uint64).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [k1, k2, number("start"), number("end"), number("anchor"), digit("coarse"), digit("fine"), pa.array(own)],
        names=[c.split()[0] for c in ROWS.split(", ")],
    )


def stretch_rows(texts: DataFrame, spans: DataFrame, width: int, shape: Shape) -> DataFrame:
    """The stretches of ``spans`` (rows as in ``ROWS``), read from their texts."""
    grouped = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end", "anchor", "own")).alias("spans"))
    both = prefiltered(texts, grouped, ["k1", "k2"]).join(grouped, ["k1", "k2"]).select("k1", "k2", "spans", "text")

    def run(batches):
        rolling = Rolling(2 + (width == 1), shape)
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = symbols(piece.column("text"), shape)
                lists = piece.column("spans")
                row = pc.list_parent_indices(lists).to_numpy()
                flat = lists.flatten()
                get = lambda k: pc.struct_field(flat, k).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                found = {k: get(k).astype(np.int64) for k in ("start", "end", "anchor")}
                found["base"] = offsets[row]
                r = stretches(data, found, rolling, width)
                r["anchor"] = found["anchor"][r["span"]]
                at = pa.array(row[r["span"]].astype(np.int64))
                yield _batch(piece.column("k1").take(at), piece.column("k2").take(at), r, get("own")[r["span"]])

    return both.mapInArrow(run, ROWS)


def tied(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Finished rows (only repeated windows), and what the next pass needs.

    Finished rows tie on the fine digit. The next pass gets the rows that tie on
    the coarse digit alone, and for their coarse digits one copy of each
    finished row and the rows that only stand for such copies (``own`` false).
    """
    groups = rows.groupBy("coarse").count().where("count > 1").select("coarse")
    active = written(rows.join(groups, "coarse", "left_semi").select(*rows.columns), name)
    copies = active.groupBy("fine").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start")).alias("one")).where("n > 1")
    done = active.where("own").join(copies.select("fine"), "fine", "left_semi").select("k1", "k2", "start", "end")
    single = active.join(copies.select("fine"), "fine", "left_anti").select(*rows.columns)
    unfinished = single.where("own")
    wanted = unfinished.select("coarse").distinct()
    one = copies.select("fine", F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2"), F.col("one.start").alias("start"))
    helpers = (
        active.join(one, ["fine", "k1", "k2", "start"], "left_semi")
        .select(*rows.columns)
        .unionByName(single.where("not own"))
        .join(wanted, "coarse", "left_semi")
        .withColumn("own", F.lit(False))
    )
    return done, written(unfinished.unionByName(helpers.select(*rows.columns)), f"{name}-next")


def repeated_spans(texts: DataFrame, shape: Shape) -> DataFrame:
    """(``k1``, ``k2``, ``start``, ``end``): ranges of first bytes of repeated windows."""
    done1, left = tied(written(run_rows(texts, shape), "repeats-runs"), "repeats-active")
    done2, left = tied(written(stretch_rows(texts, left, shape.stretch, shape), "repeats-stretches"), "repeats-ties")
    windows = written(stretch_rows(texts, left, 1, shape), "repeats-windows")
    twice = windows.groupBy("fine").count().where("count > 1").select("fine")
    done3 = windows.where("own").join(twice, "fine", "left_semi").select("k1", "k2", "start", "end")
    return done1.unionByName(done2).unionByName(done3)


CUT = [
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType()),
]


def cut_texts(texts: DataFrame, spans: DataFrame, depth: int) -> DataFrame:
    """The texts that have spans, with what is left of them (bytes) and how much went."""
    grouped = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    grouped = written(grouped, "repeats-spans")
    both = prefiltered(texts, grouped, ["k1", "k2"]).join(grouped, ["k1", "k2"])

    def setup():
        def each(piece: pa.RecordBatch) -> list:
            removed, number, kept = [], [], []
            for text, own in zip(piece.column("text").to_pylist(), piece.column("spans")):
                data = np.frombuffer(text.encode(), np.uint8)
                flat = own.values
                start = pc.struct_field(flat, "start").to_numpy()
                end = pc.struct_field(flat, "end").to_numpy()
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, start, 1)
                np.add.at(step, end.astype(np.int64) + depth, -1)
                gone = np.cumsum(step[:-1]) > 0
                removed.append(int(gone.sum()))
                number.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(data[~gone].tobytes())
            return [removed, number, kept]

        return each

    return map_pieces(both, "text", CUT, setup).drop("text", "spans")


def without_repeats(docs: DataFrame, shape: Shape = Shape(), words: Shape = WORDS) -> DataFrame:
    """The registered result: what is left of every text's bytes."""
    texts = keyed(docs)
    passages = repeated_spans(texts, words).select("k1", "k2").distinct().withColumn("passage", F.lit(True))
    cut = cut_texts(texts, repeated_spans(texts, shape), shape.depth).select(
        "k1", "k2", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")
    )
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"),
        F.xxhash64(text).alias("k2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole_sha256"),
    )
    found = whole.join(cut.dropDuplicates(["k1", "k2"]), ["k1", "k2"], "left").join(passages, ["k1", "k2"], "left")
    return found.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
        (F.coalesce("n_removed", F.lit(0)) > 0).alias("has_repeats"),
        F.coalesce("passage", F.lit(False)).alias("has_passage"),
    )
