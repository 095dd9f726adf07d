r"""Phrase collocations by the stripes pattern (operator 11).

A stripe is a prefix of words with an associative counter of the words that come
next. Tasks build the stripes of their texts in numpy (one pass over the texts
for each length), Spark brings the parts of a stripe together and merges them
elementwise. A stripe also counts, under no word, the occurrences that nothing
follows in the piece or whose continuation cannot be frequent, so it yields

* its extensions: the counts of prefix + word, which are the phrases;
* its total: the count of the prefix itself, which serves as both the first
  parts and the rests of the phrases that are cut;
* the largest of its extensions, which may subsume the prefix (and, regrouped by
  what follows the first word, the largest extensions to the left).

Lengths go up by one: a prefix is counted only if the last pass found it
frequent, and a continuation only if the words from the second on are frequent
too. Tasks know that from a Bloom filter of fixed size: what it lets through
wrongly is counted exactly all the same and falls to the threshold.

Skew: all words are thought of as cut into equal shares, ``TASK_SHARES`` for each
shuffle partition of the session. A prefix with more than one share of the words
is divided into segments by the next word, as many as it has shares; there are
fewer such prefixes than shares, and they alone are broadcast. The root stripe (no
prefix: all words of a language) has as many segments as there are shares. Counts
are summed in tasks before they are shuffled.

Cases: a null lang is ``und``; null and empty texts have no words; a very long
text is one shard by itself; repeated rows count as often as they stand there;
ties are broken by cut, score, count and phrase as the contract says; an empty
table gives no row; columns beyond ``text`` and ``lang`` are not read. Arithmetic on
counts is decimal with 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremarts.llm.common import hash_words, mixed, pieces, written

LEAST = 30
LONGEST = 4
TOP = 2000
NO_LANG = "und"
LEAST_SHARES, TASK_SHARES = 1024, 16  # see ``word_shares``
FILTER_BITS = 1 << 26  # of the filter of frequent phrases: 8 MiB
SHARD_BYTES = 6 << 20
RANK_SALTS = 256

#: A part of a stripe: its words joined by spaces (the empty word stands for none), and their counts.
STRIPE = "lang string, prefix string, segment int, next string, n array<long>"

_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_in_pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts (lower-cased A-Z), and for each the number of its piece, which no other text shares."""
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    text_starts = offsets[:-1] - offsets[0]
    kind = _KIND[raw]
    inside = kind == 0
    first = np.ones(len(raw), bool)  # whether a word byte here begins a word
    first[1:] = ~inside[:-1]
    first[text_starts[text_starts < len(raw)]] = True
    starts = np.flatnonzero(inside & first)
    data = _LOWER[raw[inside]]
    # words lie one after another in ``data``: each ends where the next begins
    places = np.cumsum(inside, dtype=np.int32)[starts] - 1 if len(starts) else np.zeros(0, np.int32)
    bounds = np.append(places, len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + np.searchsorted(text_starts, starts, side="right")
    return words, piece


def window_hashes(hashes: np.ndarray, width: int, lang: str) -> np.ndarray:
    """A hash of the language and each run of ``width`` words, given the words' hashes."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, hash_words(pa.array([lang]), 7)[0], np.uint64)
    for j in range(width):
        out = mixed(out ^ hashes[j : j + n])
    return out


def spots(h: np.ndarray, bits: int) -> np.ndarray:
    """Three places in a filter of so many bits for each hash."""
    bits = np.uint64(bits)
    return np.stack([h % bits, (h >> np.uint64(32)) % bits, mixed(h) % bits]).astype(np.int64)


class Known:
    """What the tasks of a pass know of the last one: frequent phrases (a filter) and hot ones (hash, segments)."""

    def __init__(self, table: np.ndarray, hot: np.ndarray, segments: np.ndarray):
        self.table, self.hot, self.segments = table, hot, segments

    def frequent(self, h: np.ndarray) -> np.ndarray:
        at = spots(h, 64 * len(self.table))
        hit = (self.table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return hit.all(axis=0)

    def segments_of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.ones(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return np.where(self.hot[at] == h, self.segments[at], 1)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each key's group, the distinct keys, and where each stands first."""
    import pandas as pd

    of, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), np.int64)
    first[of[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return of, distinct, first


def local_stripes(words: pa.Array, piece: np.ndarray, lang: str, length: int, known: Known | None, shares: int) -> pa.RecordBatch | None:
    """Stripes of the prefixes of ``length - 1`` words over the words of one language in a shard."""
    coded = words.dictionary_encode()
    codes, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    hashes = hash_words(vocabulary)
    width = length - 1
    if width == 0:  # one prefix, and every word goes on from it
        first, segments = np.zeros(1, np.int64), np.full(1, shares)
        group, following, n = np.zeros(len(vocabulary), np.int64), np.arange(1, len(vocabulary) + 1), np.bincount(codes)
    else:
        h = window_hashes(hashes[codes], width, lang)
        ok = known.frequent(h) & (piece[: len(h)] == piece[width - 1 : width - 1 + len(h)])
        at = np.flatnonzero(ok)
        if not len(at):
            return None
        group, _, first = grouped(codes[at])
        for j in range(1, width):
            group, _, first = grouped(group << 32 | codes[at + j])
        first = at[first]
        segments = known.segments_of(h[first])
        follows = np.append(ok, False)[at + 1]
        end = np.minimum(at + width, len(codes) - 1)
        goes_on = follows & (at + width < len(codes)) & (piece[end] == piece[at])
        following = np.where(goes_on, codes[end] + 1, 0)  # 0: none that counts
        of, cells, _ = grouped(group << 32 | following)
        group, following, n = cells >> 32, cells & 0xFFFFFFFF, np.bincount(of)
    pick = (mixed(hashes) % np.uint64(shares)).astype(np.int64)[np.maximum(following - 1, 0)]
    place = group * shares + np.where(following > 0, pick % segments[group], 0)
    order = np.argsort(place)
    place, following, n = place[order], following[order], n[order]
    row = np.flatnonzero(np.append(True, np.diff(place) != 0))
    bounds = pa.array(np.append(row, len(place)), pa.int32())
    of_row = first[place[row] // shares]
    parts = [vocabulary.take(pa.array(codes[of_row + j])) for j in range(width)]
    prefix = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(row), pa.string())
    nexts = pc.fill_null(vocabulary.take(pa.array(following - 1, mask=following == 0)), "")
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(row), pa.string()),
            prefix,
            pa.array(place[row] % shares, pa.int32()),
            pc.binary_join(pa.ListArray.from_arrays(bounds, nexts), " "),
            pa.ListArray.from_arrays(bounds, pa.array(n, pa.int64())),
        ],
        names=["lang", "prefix", "segment", "next", "n"],
    )


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, pa.Array]]:
    """Language and texts, at most ``most`` bytes of text at a time (one text at least)."""
    held: list[pa.RecordBatch] = []
    size = 0

    def by_lang() -> Iterator[tuple[str, pa.Array]]:
        batch = pa.concat_batches(held)
        langs = pc.fill_null(batch.column("lang"), NO_LANG).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, pc.fill_null(batch.column("text"), "").filter(pc.equal(langs.indices, code))

    for batch in batches:
        for piece in pieces(batch, "text", most):
            n = pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
            if held and size + n > most:
                yield from by_lang()
                held, size = [], 0
            held.append(piece)
            size += n
    if held:
        yield from by_lang()


def merged_stripes(
    texts: DataFrame, length: int, known: Broadcast | None, least: int, shard_bytes: int, shares: int
) -> DataFrame:
    """``lang, prefix, segment, total, extensions`` of all prefixes of ``length - 1`` words that may be frequent.

    ``total`` counts the prefix's occurrences that fall to the segment,
    ``extensions`` has (next, f) of those with at least ``least``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in shards(batches, shard_bytes):
            words, piece = words_in_pieces(column)
            if len(words):
                stripes = local_stripes(words, piece, lang, length, known.value if known else None, shares)
                if stripes is not None:
                    yield stripes
                    del stripes
            pa.default_memory_pool().release_unused()  # else a worker keeps what its largest shard took

    # parts of a stripe meet by (lang, prefix, segment); its counts are summed where they are
    met = texts.mapInArrow(run, STRIPE).repartition("lang", "prefix", "segment")
    listed = met.withColumn("next", F.split("next", " "))
    cells = listed.select("lang", "prefix", "segment", F.expr("inline(arrays_zip(next, n))"))
    summed = cells.groupBy("lang", "prefix", "segment", "next").agg(F.sum("n").alias("f"))
    frequent = (F.col("next") != "") & (F.col("f") >= least)
    stripes = summed.groupBy("lang", "prefix", "segment").agg(
        F.sum("f").alias("total"), F.collect_list(F.when(frequent, F.struct("next", "f"))).alias("extensions")
    )
    return written(stripes, f"stripes-{length}")


def extensions(stripes: DataFrame) -> DataFrame:
    """``lang, prefix, phrase, f``: the frequent phrases that extend the prefixes."""
    cells = stripes.select("lang", "prefix", F.inline("extensions"))
    joined = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    return cells.select("lang", "prefix", joined.alias("phrase"), "f")


def totals(stripes: DataFrame) -> DataFrame:
    """``lang, prefix, total``: occurrences of each prefix, over its segments."""
    return stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"))


def known_phrases(phrases: DataFrame, width: int, words: int, filter_bits: int, shares: int) -> Known:
    """What the next pass must know of the frequent phrases of ``width`` words; ``words`` is the number of all words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            split = pc.split_pattern(b.column("phrase"), " ").flatten()
            h = hash_words(split)
            out = np.zeros(b.num_rows, np.uint64)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = langs.indices.to_numpy() == code
                own = h.reshape(-1, width)[rows].ravel()
                out[rows] = window_hashes(own, width, lang)[::width] if len(own) else out[rows]
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), b.column("f")], names=["h", "f"])

    def filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(spots(b.column("h").to_numpy().view(np.uint64), filter_bits).ravel())
            word, first = np.unique(at >> 6, return_index=True)
            value = np.uint64(1) << (at & 63).astype(np.uint64)
            value = np.bitwise_or.reduceat(value, first) if len(at) else value
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "bits"])

    keys = phrases.select("lang", "phrase", "f").mapInArrow(hashed, "h long, f long")
    rows = (
        keys.mapInArrow(filter_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    )  # at most filter_bits / 64 rows
    table = np.zeros(filter_bits // 64, np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    # the counts of one length sum up to the number of words at most: fewer than ``shares`` rows
    hot = keys.where(F.col("f") * shares > words).toArrow()
    h, f = hot["h"].to_numpy().view(np.uint64), hot["f"].to_numpy()
    h, last = np.unique(h, return_index=True)
    return Known(table, h, np.minimum(-(-f[last] * shares // words), shares))


def word_shares(spark: SparkSession) -> int:
    """How many shares of all words the session's shuffles are divided into."""
    return max(LEAST_SHARES, TASK_SHARES * int(spark.conf.get("spark.sql.shuffle.partitions")))


def phrase_stripes(
    documents: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    *,
    shard_bytes: int = SHARD_BYTES,
    filter_bits: int = FILTER_BITS,
    shares: int | None = None,
) -> list[DataFrame]:
    """The merged stripes of 0 to ``longest`` - 1 words, written to the shared folder.

    The sizes bound what a task holds at once, the filter that is broadcast and
    the hot prefixes and their segments; none of them changes a result.
    """
    spark = documents.sparkSession
    shares = shares or word_shares(spark)
    texts = documents.select("text", F.col("lang").cast("string").alias("lang"))
    out = [merged_stripes(texts, 1, None, least, shard_bytes, shares)]
    words = out[0].agg(F.sum("total")).first()[0] or 0
    for length in range(2, longest + 1):
        known = known_phrases(extensions(out[-1]), length - 1, max(words, 1), filter_bits, shares)
        out.append(merged_stripes(texts, length, spark.sparkContext.broadcast(known), least, shard_bytes, shares))
    return out


def scored_phrases(stripes: list[DataFrame]) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that no longer one subsumes."""
    united = lambda frames: [f := frames[0], *(f := f.unionByName(x) for x in frames[1:])][-1]
    phrases = united([extensions(s).drop("prefix") for s in stripes[1:]])
    parts = united([totals(s) for s in stripes[1:]])
    words = F.split("phrase", " ")
    after = lambda col, head: F.substr(col, F.length(head) + 2)  # noqa: E731  what follows ``head`` and a space
    cut = (
        phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("rest", after(F.col("phrase"), F.col("head")))
    )
    left = parts.select("lang", F.col("prefix").alias("head"), F.col("total").alias("l"))
    right = parts.select("lang", F.col("prefix").alias("rest"), F.col("total").alias("r"))
    score = F.expr("cast((cast(2000000 as decimal(7, 0)) * cast(f as decimal(19, 0))) div (cast(l as decimal(20, 0)) + r) as long)")
    best = (
        cut.join(left, ["lang", "head"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", F.col("f").alias("a"))
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    longer = united([extensions(s) for s in stripes[2:]])
    to_right = longer.select("lang", F.col("prefix").alias("phrase"), "f")
    to_left = longer.select("lang", after(F.col("phrase"), F.expr("substring_index(phrase, ' ', 1)")).alias("phrase"), "f")
    most = to_right.unionByName(to_left).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(19, 0)")
    kept = best.join(most, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (wide("most") * 100 < wide("a") * 80)
    )
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, **sizes: int
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases; ``sizes`` as for ``phrase_stripes``."""
    stripes = phrase_stripes(documents, least, longest, **sizes)
    kept = scored_phrases(stripes).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # the first of a language are among the first of its salted groups
    near = kept.withColumn("place", rank("lang", "salt")).where(F.col("place") <= top)
    ranked = near.withColumn("rank", rank("lang").cast("long")).where(F.col("rank") <= top)
    n = stripes[0].groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
