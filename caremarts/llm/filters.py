r"""Filter interaction audit over a sparse document-term matrix (operator 12).

``term_shards`` cuts the documents into shards and writes each as one row: the
words of its texts as codes of the shard's own word list in CSR form (``indptr``,
``codes``, ``counts``), with what the other filters need of each text.
``numbered`` deals the word lists by the words' hashes and numbers the distinct
words of all shards once, in as many buckets as there are words for.
``global_shards`` brings the numbers of a shard's words to it and rewrites its
codes: the same matrix under one global dictionary. Row sums of a shard are word counts
and the nonzeros of a row are its distinct words, which decide filters A and B;
C and D are byte counts of the texts, taken in the same pass; E compares digests.

Filters (a document fails):

* A: under 100 words; B: 100 * distinct words < 80 * words;
* C: 100 * capitals (A-Z) > 10 * code points; D: holds one of ``#$%&*|``;
* E: its text is that of a smaller doc_id, anywhere in the table.

``audit`` counts documents by part, failing filters and labels (map-side combined:
at most parts x 128 rows), and derives all 120 orders from those counts.

Bounds: a shard holds at most ``SHARD_BYTES`` of text and ``SHARD_ROWS`` rows (one
row at least, so a very long text is a shard by itself); a word list and a shard's
numbers are bounded by its text, and a word comes once from each shard, however
often it occurs. A bucket has ``BUCKET_WORDS`` listed words on average, and a task
keeps only its distinct ones. Nothing is broadcast or collected.

Cases: a null or empty text has no words, fails A (and E, if a smaller id is
empty too) and nothing else; a null ``lang`` is the part of the empty string; rows
that repeat a doc_id are rows of their own, and of two rows with one id and text
neither fails E for the other; a null doc_id is no smaller id and has none, so it
never takes part in E, and has no label; several label rows of an id count as one
that has each label any of them has; a tie in percent does not fail B or C; an
empty table gives no shard and no row; columns beyond the named are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import arrow_type, coded_words, pieces, shared_dir

FILTERS = "ABCDE"
MARKS = b"#$%&*|"
FEWEST_WORDS = 100
SHARD_BYTES = 8 << 20
SHARD_ROWS = 1 << 16
#: Listed words for each bucket of the dictionary, and the fewest buckets.
BUCKET_WORDS, LEAST_BUCKETS = 1 << 20, 256
#: Words in a row of the stored dictionary.
LIST_WORDS = 1 << 14

DOC = "struct<doc_id: long, lang: string, digest: binary, chars: long, capitals: long, marked: boolean>"
SHARD = f"shard long, docs array<{DOC}>, indptr binary, codes binary, counts binary, listed long, words binary"


def packed(values: np.ndarray) -> bytes:
    """Ascending runs of small numbers (codes of a row, counts) in few bytes: differences, compressed."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def unpacked(cell: bytes, kind: str) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(cell), kind), dtype=kind)


def packed_words(words: list[bytes]) -> bytes:
    """Words hold no white space, so a line end parts them."""
    return zstandard.compress(b"\n".join(words), 1)


def unpacked_words(cell: bytes, listed: int) -> list[bytes]:
    return zstandard.decompress(cell).split(b"\n") if listed else []


def shards_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` bytes of text (one row at least) from batches of any size."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        for start in range(0, batch.num_rows, SHARD_ROWS):
            for piece in pieces(batch.slice(start, SHARD_ROWS), "text", most):
                n = pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
                if held and (size + n > most or rows + piece.num_rows > SHARD_ROWS):
                    yield pa.concat_batches(held)
                    held, size, rows = [], 0, 0
                held.append(piece)
                size, rows = size + n, rows + piece.num_rows
    if held:
        yield pa.concat_batches(held)


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set bytes of ``flags`` between neighbouring offsets."""
    before = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return before[offsets[1:]] - before[offsets[:-1]]


def byte_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, capitals A-Z and characters of ``MARKS`` in each text of a column without nulls."""
    _, ends, data = pa.array(column, pa.string()).buffers()
    offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    at = offsets - offsets[0]
    marks = np.zeros(256, bool)
    marks[list(MARKS)] = True
    return sums((raw & 0xC0) != 0x80, at), sums((raw >= 65) & (raw <= 90), at), sums(marks[raw], at)


def csr(offsets: np.ndarray, codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``indptr, codes, counts`` of the rows whose words are given one after another."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    cells, counts = np.unique(rows * max(words, 1) + codes, return_counts=True)
    of = cells // max(words, 1)
    indptr = np.searchsorted(of, np.arange(n + 1))
    return indptr.astype("<i8"), (cells - of * max(words, 1)).astype("<i4"), counts.astype("<i4")


def term_shards(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The shards of the document-term matrix under their own word lists; a lazy frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(shards_of(batches, shard_bytes)):
            text = pc.fill_null(batch.column("text"), "")
            offsets, codes, words = coded_words(text, lower=False)
            chars, capitals, marked = byte_counts(text)
            lines = zip(
                batch.column("doc_id").to_pylist(),
                batch.column("lang").to_pylist(),
                (hashlib.sha256(t).digest() for t in text.cast(pa.binary()).to_pylist()),
                chars.tolist(),
                capitals.tolist(),
                (marked > 0).tolist(),
                strict=True,
            )
            names = ("doc_id", "lang", "digest", "chars", "capitals", "marked")
            indptr, codes, counts = csr(offsets, codes, len(words))
            row = {
                "shard": task + k,
                "docs": [dict(zip(names, x, strict=True)) for x in lines],
                "indptr": indptr.tobytes(),
                "codes": packed(codes),
                "counts": packed(counts),
                "listed": len(words),
                "words": packed_words(words.cast(pa.binary()).to_pylist()),
            }
            yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in T.StructType.fromDDL(SHARD)])
    return documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").mapInArrow(run, SHARD)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As ``common.written``, packed tighter: shards are mostly small integers."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(shards: DataFrame) -> DataFrame:
    """``shard, codes, ids, words``: the global number of each word of each shard, and the dictionary itself.

    A shard's word list is dealt by the words' hashes, so every copy of a word
    meets in one task, which numbers the distinct ones as they come. A row has the
    numbers of the words of one shard in one bucket (``codes`` and ``ids``); rows
    without a shard have ``words`` and their ``ids`` (all packed). The rows are
    stored: a task that ran again could number its words otherwise.
    """
    listed = shards.agg(F.sum("listed")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, listed // BUCKET_WORDS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            for shard, n, cell in zip(*(b.column(c).to_pylist() for c in ("shard", "listed", "words")), strict=True):
                words = unpacked_words(cell, n)
                bucket = np.fromiter((digest(w) % buckets for w in words), np.int64, n)
                order = np.argsort(bucket, kind="stable").astype("<i4")
                row = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)[:n])
                own = [order[i:j] for i, j in zip(row, np.append(row[1:], n))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[order][row]),
                        pa.array([shard] * len(row), pa.int64()),
                        pa.array([packed(codes) for codes in own], pa.binary()),
                        pa.array([len(codes) for codes in own], pa.int64()),
                        pa.array([packed_words([words[i] for i in codes]) for codes in own], pa.binary()),
                    ],
                    names=["bucket", "shard", "codes", "listed", "words"],
                )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        known: dict[bytes, int] = {}
        for b in batches:
            ids = []
            for n, cell in zip(b.column("listed").to_pylist(), b.column("words").to_pylist(), strict=True):
                own = [known.setdefault(w, first + len(known)) for w in unpacked_words(cell, n)]
                ids.append(packed(np.array(own, "<i8")))
            cells = [b.column("shard"), b.column("codes"), pa.array(ids, pa.binary()), b.column("listed"), pa.nulls(b.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, schema=schema)
        words = list(known)
        for at in range(0, len(words), LIST_WORDS):
            own = words[at : at + LIST_WORDS]
            ids = packed(np.arange(first + at, first + at + len(own), dtype="<i8"))
            row = {"shard": None, "codes": None, "ids": ids, "listed": len(own), "words": packed_words(own)}
            yield pa.RecordBatch.from_pylist([row], schema)

    kind = "shard long, codes binary, ids binary, listed long, words binary"
    schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in T.StructType.fromDDL(kind)])
    dealt = shards.select("shard", "listed", "words").mapInArrow(deal, "bucket long, shard long, codes binary, listed long, words binary")
    return stored(dealt.repartition("bucket").mapInArrow(number, kind), "dictionary")


def dictionary(numbers: DataFrame) -> DataFrame:
    """``word, id`` of all words, from ``numbered``."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, words, ids in zip(*(b.column(c).to_pylist() for c in ("listed", "words", "ids")), strict=True):
                column = pa.array(unpacked_words(words, n), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([column, pa.array(unpacked(ids, "<i8"))], names=["word", "id"])

    return numbers.where("shard is null").select("listed", "words", "ids").mapInArrow(pairs, "word string, id long")


def global_shards(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """``shard, docs, indptr, ids, counts``: stored shards with the dictionary's numbers for their codes.

    The cells are plain little-endian buffers: ``indptr`` and ``ids`` of 64 bits, ``counts`` of 32.
    """

    def renumber(own: pa.Table, found: pa.Table) -> pa.Table:
        codes, ids = (
            np.concatenate([np.zeros(0, t), *(unpacked(x, t) for x in found.column(c).to_pylist())])
            for c, t in (("codes", "<i4"), ("ids", "<i8"))
        )
        by_code = np.zeros(len(codes), "<i8")
        by_code[codes] = ids
        cells = [by_code[unpacked(x, "<i4")].tobytes() for x in own.column("codes").to_pylist()]
        counts = [unpacked(x, "<i4").tobytes() for x in own.column("counts").to_pylist()]
        columns = {"ids": pa.array(cells, pa.binary()), "counts": pa.array(counts, pa.binary())}
        return pa.table({c: columns[c] if c in columns else own.column(c) for c in ("shard", "docs", "indptr", "ids", "counts")})

    of_shards = numbers.where("shard is not null").select("shard", "codes", "ids")
    return (
        shards.select("shard", "docs", "indptr", "codes", "counts")
        .groupBy("shard")
        .cogroup(of_shards.groupBy("shard"))
        .applyInArrow(renumber, f"shard long, docs array<{DOC}>, indptr binary, ids binary, counts binary")
    )


def document_flags(matrix: DataFrame) -> DataFrame:
    """``doc_id, lang, words, distinct_words, a, b, c, d, e`` of each row of a matrix of global shards."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                docs = b.column("docs")[k].values.flatten()
                indptr, counts, ids = (
                    np.frombuffer(b.column(c)[k].as_buffer(), t)
                    for c, t in (("indptr", "<i8"), ("counts", "<i4"), ("ids", "<i8"))
                )
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                sizes = [pa.array(total[indptr[1:]] - total[indptr[:-1]]), pa.array(nonzeros(indptr, ids))]
                yield pa.RecordBatch.from_arrays([*docs, *sizes], names=names)

    names = ["doc_id", "lang", "digest", "chars", "capitals", "marked", "words", "distinct_words"]
    rows = matrix.mapInArrow(
        measured,
        "doc_id long, lang string, digest binary, chars long, capitals long, marked boolean, words long, distinct_words long",
    )
    rows = stored(rows, "filter-rows")
    copies = (
        rows.where("doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("digest", "first")
    )
    return rows.join(copies, "digest", "left").select(
        "doc_id",
        "lang",
        "words",
        "distinct_words",
        F.expr(f"words < {FEWEST_WORDS}").alias("a"),
        F.expr("100 * distinct_words < 80 * words").alias("b"),
        F.expr("100 * capitals > 10 * chars").alias("c"),
        F.col("marked").alias("d"),
        F.expr("coalesce(doc_id > first, false)").alias("e"),
    )


def nonzeros(indptr: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Nonzero cells of each row: its global ids, which differ from one another as the local codes do."""
    if len(ids) != indptr[-1]:
        raise ValueError("a shard's cells do not match its row index")
    return np.diff(indptr).astype(np.int64)


def filter_flags(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The filters' flags of each document, decided on the document-term matrix."""
    shards = stored(term_shards(documents, shard_bytes), "term-shards")
    return document_flags(global_shards(shards, numbered(shards)))


def audit(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes in each order of the five, by part.

    One row per part, order and step: see the module docstring of the filters;
    ``kept`` counts documents left after the step, ``removed`` those it removes,
    ``redundant`` those failing its filter that are gone already,
    ``unique_fails`` those failing it alone, ``good_lost`` and ``toxic_lost``
    the labelled ones among ``removed``, ``shapley`` what its filter removes
    summed over all 120 orders.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    fails = sum((F.col(n.lower()).cast("int") * (1 << k) for k, n in enumerate(FILTERS)), F.lit(0))
    counted = (
        flags.withColumn("fails", fails)
        .join(known, "doc_id", "left")
        .groupBy(
            F.coalesce("lang", F.lit("")).alias("part"),
            "fails",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    steps = [
        (order, k + 1, 1 << FILTERS.index(order[k]), sum(1 << FILTERS.index(x) for x in order[:k]))
        for order in map("".join, permutations(FILTERS))
        for k in range(len(FILTERS))
    ]
    rows = ", ".join(f"struct('{o}' as filter_order, {k} as step, {own} as own, {before} as before)" for o, k, own, before in steps)
    each = counted.select("*", F.expr(f"inline(array({rows}))"))
    failing = F.expr("fails & own <> 0")
    gone = F.expr("fails & before <> 0")
    removed = failing & ~gone
    total = lambda cond: F.sum(F.when(cond, F.col("docs")).otherwise(0)).cast("long")
    # of the orders of m failing filters, each comes first in one of m
    share = F.when(failing, F.col("docs") * F.expr(f"{len(steps) // len(FILTERS)} div bit_count(fails)")).otherwise(0)
    return each.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~failing).alias("kept"),
        total(removed).alias("removed"),
        total(failing & gone).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        F.sum(share).cast("long").alias("shapley"),
    )


def filter_audit(documents: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``audit`` of all documents."""
    return audit(filter_flags(documents, shard_bytes), labels)
