"""Document fingerprints by I-Match with randomised lexicons (operator 7).

Document frequencies of all terms are counted over all distinct texts, so copies
of a text do not move its terms. The lexicon keeps the terms whose inverse
document frequency lies in a band, here terms in at least ``LEAST_SHARE`` and at
most ``MOST_SHARE`` of the distinct texts. A text's distinct lexicon terms are
sorted, and for each randomised subset of the lexicon the terms that fall in it
are hashed in that order. A text with fewer than ``FEW`` lexicon terms (rare
words, or words of a large group of near copies) takes all of its terms instead,
in the subsets that each term draws by itself. The fingerprint is the list
of these hashes, ended by a hash of all distinct terms. Likeness is the share of
subsets with equal hashes among those that are not empty for both texts.

The lexicon is broadcast: with LEAST_SHARE of the documents a term at least, it
has at most (mean distinct terms of a document) / LEAST_SHARE entries of 8
bytes, however many documents there are.

The counts take two passes over the texts: a term of at least ``LEAST_SHARE`` of
all documents has that share of one piece of them at least, so the first pass
names the terms that have it somewhere, and only these are counted and shuffled.

Copies are found by a 128-bit hash. Only rows whose hash repeats (and few others
that a Bloom filter lets pass) are shuffled with their text, one row of a text for
each task, and what they add beyond one is subtracted from the counts.

Cases: null and empty texts have the fingerprint of no terms (all zeros); two
texts whose subsets are all empty are like each other if all their terms agree;
equal texts have equal fingerprints; ids that repeat are ordered by text, null
ids come last; one document alone is its own next document; an empty table
gives an empty table; other columns are not returned; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import coded_words, hash_words, map_pieces, membership, mixed, pieces, prefiltered, quoted, written

LEAST_SHARE = 0.002
MOST_SHARE = 0.1
#: Of every rate so many subsets; a subset holds that share of the lexicon.
RATES = (1 / 16, 1 / 64, 1 / 256, 1 / 1024)
SUBSETS = 16
FEW = 16  # below so many lexicon terms the densest subsets hold less than one on average
PARTITION_BYTES = 24 << 20  # text sorted in one task
COUNTED_BYTES = 16 << 20  # text whose terms are counted at once


def distinct_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and term number of each text's distinct terms, and the hash of each term number."""
    offsets, codes, words = coded_words(column)
    values = hash_words(words)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pairs = np.unique(owner * max(1, len(values)) + codes)
    return pairs // max(1, len(values)), pairs % max(1, len(values)), values


def repeated_texts(df: DataFrame, column: str = "text") -> DataFrame:
    """(``h1``, ``h2``, ``copies``) of each text that stands in several rows; null is the empty text."""
    return written(hashed(df, column).groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1"), "imatch-copies")


def hashed(df: DataFrame, column: str) -> DataFrame:
    text = F.coalesce(quoted(column), F.lit(""))
    return df.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))


def piece_counts(piece: pa.RecordBatch, times: np.ndarray | None = None) -> pa.RecordBatch:
    """(``term``, ``n``): in how many texts of the piece each term stands; a text counts ``times``, else once."""
    owner, codes, values = distinct_terms(piece.column("text"))
    n = np.zeros(len(values), np.int64)
    np.add.at(n, codes, 1 if times is None else times[owner])
    return pa.RecordBatch.from_pydict({"term": pa.array(values.view(np.int64)), "n": pa.array(n)})


def common_somewhere(df: DataFrame, column: str, least: int, rows: int) -> DataFrame:
    """(``term``): all terms of at least ``least`` of the ``rows`` texts, and few others.

    A term that has its share ``least / rows`` of no piece of the texts cannot have it of all of them.
    """

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", COUNTED_BYTES):
                counts = piece_counts(piece)
                often = counts.column("n").to_numpy() * rows >= least * piece.num_rows
                yield counts.select(["term"]).filter(pa.array(often))

    return df.select(F.coalesce(quoted(column), F.lit("")).alias("text")).mapInArrow(run, "term long").distinct()


def document_frequencies(
    df: DataFrame, column: str = "text", repeated: DataFrame | None = None, among: DataFrame | None = None
) -> DataFrame:
    """(``term``, ``df``) over all distinct texts; a term is known by its 64-bit hash.

    With ``among`` (``term``) most terms that are not in it are left out before the shuffle.
    """
    repeated = repeated_texts(df, column) if repeated is None else repeated
    wanted = membership(among, ["term"]) if among is not None else None

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", COUNTED_BYTES):
                counts = piece_counts(piece, piece.column("times").to_numpy())
                yield counts if wanted is None else counts.filter(pa.array(wanted(counts)))

    rows = df.select(F.coalesce(quoted(column), F.lit("")).alias("text"), F.lit(1).cast("long").alias("times"))
    beyond = (
        prefiltered(hashed(df, column), repeated, ["h1", "h2"])
        .groupBy("h1", "h2")
        .agg(F.first("text").alias("text"), (1 - F.count("*")).alias("times"))
        .where("times < 0")
        .select("text", "times")
    )
    counted = [part.mapInArrow(run, "term long, n long") for part in (rows, beyond)]
    return counted[0].unionByName(counted[1]).groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(df: DataFrame, column: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    repeated = repeated_texts(df, column)
    rows = df.count()
    n = rows - (repeated.agg(F.sum(F.col("copies") - 1)).first()[0] or 0)
    lo, hi = max(2, math.ceil(least * n)), max(2, math.floor(most * n))
    counted = document_frequencies(df, column, repeated, common_somewhere(df, column, lo, rows))
    found = counted.where(F.col("df").between(lo, hi)).select("term").toArrow()
    return np.sort(found["term"].to_numpy().view(np.uint64))


class Fingerprinter:
    """Hashes of every randomised subset; which terms a subset holds follows from the term alone."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.rates = np.repeat(RATES, SUBSETS)
        self.width = len(self.rates)
        self.starts, self.subsets = self._drawn(terms)

    def _drawn(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each term's subsets begin (one more than there are terms), and the subsets."""
        rows, subsets = [], []
        for i, rate in enumerate(self.rates):
            turn = np.uint64(0x632BE59BD9B4E019 * (i + 1) % (1 << 64))
            lot = mixed(terms + turn) >> np.uint64(11)
            inside = np.flatnonzero(lot < np.uint64(int(rate * (1 << 53))))
            rows.append(inside)
            subsets.append(np.full(len(inside), i))
        order = np.argsort(np.concatenate(rows), kind="stable")
        return np.searchsorted(np.concatenate(rows)[order], np.arange(len(terms) + 1)), np.concatenate(subsets)[order]

    def _cells(self, drawn: tuple, owner: np.ndarray, place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell (text and subset) of each term for each subset that it is in, and its value."""
        starts, subsets = drawn
        size = starts[place + 1] - starts[place]
        ends = np.cumsum(size)
        spread = np.repeat(starts[place] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return np.repeat(owner, size) * self.width + subsets[spread], np.repeat(value, size)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Subset hashes of each text (0: empty subset), and the hash of all its terms."""
        owner, codes, values = distinct_terms(column)
        n = len(column)
        value = values[codes]
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        whole = np.zeros(n, np.uint64)
        np.add.at(whole, owner, mixed(value))
        place = np.searchsorted(self.terms, value)
        if len(self.terms):
            hit = self.terms[np.minimum(place, len(self.terms) - 1)] == value
        else:
            hit = np.zeros(len(value), bool)
        few = np.bincount(owner[hit], minlength=n) < FEW
        more = few[owner] & ~hit
        others, at = np.unique(value[more], return_inverse=True)
        parts = [
            self._cells((self.starts, self.subsets), owner[hit], place[hit], value[hit]),
            self._cells(self._drawn(others), owner[more], at, value[more]),
        ]
        cell, held = (np.concatenate(x) for x in zip(*parts))
        sums = np.zeros(n * self.width, np.uint64)
        np.add.at(sums, cell, mixed(held + np.uint64(7)))
        seen = np.zeros(n * self.width, bool)
        seen[cell] = True
        short = np.where(seen, 1 + mixed(sums) % np.uint64(65535), 0).astype(">u2")
        return short.reshape(n, self.width), whole


def packed(hashes: np.ndarray, whole: np.ndarray) -> list[bytes]:
    """Two bytes of each subset, then eight of all terms."""
    return [h.tobytes() + w.tobytes() for h, w in zip(hashes, whole.astype(">u8"))]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Share of equal hashes among the subsets that are not empty for both texts."""
    some = (a[0] != 0) | (b[0] != 0)
    same = some & (a[0] == b[0])
    n = some.sum(1)
    return np.where(n > 0, same.sum(1) / np.maximum(n, 1), (a[1] == b[1]).astype(float))


def fingerprint(df: DataFrame, terms: np.ndarray, column: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text under the lexicon ``terms``."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def setup():
        hashes = Fingerprinter(shared.value)
        return lambda piece: [[p.hex() for p in packed(*hashes(piece.column(column)))]]

    return map_pieces(df, column, [T.StructField(out, T.StringType(), False)], setup)


COLUMNS = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.binary()),
    ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the next document's first as many."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compared(hashes: Fingerprinter, ids: list, texts: list[str], at: np.ndarray) -> list:
    """Columns of the result for the texts ``at``, each beside the one after it; digests are bytes."""
    changed = [edited(texts[i], texts[i + 1]) for i in at]
    short, whole = hashes(pa.array(texts, pa.string()))
    own, following, new = (short[at], whole[at]), (short[at + 1], whole[at + 1]), hashes(pa.array(changed, pa.string()))
    return [
        [ids[i] for i in at],
        [len(texts[i]) for i in at],
        [hashlib.sha256(t.encode()).digest() for t in changed],
        packed(*own),
        packed(*new),
        likeness(own, new),
        likeness(own, following),
    ]


def parted(docs: DataFrame, parts: int) -> DataFrame:
    """Add ``part``: about ``parts`` ranges of the id, of about as many rows each; it follows from the id alone."""
    at = [i / parts for i in range(1, parts)]
    bounds = sorted(set(docs.approxQuantile("doc_id", at, 1 / (4 * parts)))) if at else []
    if not bounds:
        return docs.withColumn("part", F.lit(0.0))
    ranges = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="place", outputCol="part")
    return ranges.transform(docs.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)))).drop("place")


def first_texts(docs: DataFrame) -> DataFrame:
    """(``part``, ``text``): for each part the first text of the part read after it; the last one meets the first again."""
    spark = docs.sparkSession
    firsts = docs.groupBy("part").agg(F.max("doc_id").alias("doc_id")).orderBy(F.col("part").desc()).collect()
    before = [(before.part, r.doc_id) for before, r in zip([firsts[-1], *firsts], firsts)] if firsts else []
    wanted = F.broadcast(spark.createDataFrame(before, "before double, first long"))  # a row for each part
    met = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("first")))
    return met.groupBy(F.col("before").alias("part")).agg(F.min("text").alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The registered result: each text beside its edited text and the next document.

    Documents are dealt by ranges of the id and read in descending order, so
    a row's next document is the next row; behind the last row of a range
    stands a copy of the first text of the next one.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(lexicon(docs))
    parts = max(1, math.ceil(size / PARTITION_BYTES))
    docs = parted(docs, parts)
    behind = first_texts(docs).select(F.lit(None).cast("long").alias("doc_id"), "text", "part", F.lit(True).alias("behind"))
    order = ["part", "behind", F.col("doc_id").desc_nulls_last(), "text"]
    dealt = docs.withColumn("behind", F.lit(False)).unionByName(behind).repartitionByRange(parts, "part").sortWithinPartitions(*order)

    def run(batches):
        hashes, carry = Fingerprinter(shared.value), None
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                rows = [piece.column(c).to_pylist() for c in ("part", "doc_id", "text")]
                if carry is not None:
                    rows = [[before, *own] for before, own in zip(carry, rows)]
                carry = [own[-1] for own in rows]
                part, ids, texts = rows
                at = np.flatnonzero(np.equal(part[1:], part[:-1]))
                if len(at):
                    values = compared(hashes, ids, texts, at)
                    yield pa.RecordBatch.from_pydict({c: pa.array(v, k) for (c, k), v in zip(COLUMNS, values, strict=True)})

    rows = dealt.mapInArrow(run, RESULT)
    return rows.select(*[F.lower(F.hex(c)).alias(c) if k == pa.binary() else F.col(c) for c, k in COLUMNS])
