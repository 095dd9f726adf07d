"""What the operators share: table access, Arrow batch mapping, word splitting.

Every operator that needs Python maps Arrow batches that Spark partitions and
shuffles. A batch is cut into pieces of at most ``PIECE_BYTES`` of text (one
row at least), so a task's memory is bounded by its longest text and not by
the number of rows in a batch.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.session import checkpoint_dir

PIECE_BYTES = 4 << 20
FILTER_BITS = 1 << 25  # of the filter in ``prefiltered``: 4 MiB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset (tests, a laptop) a temporary folder is installed.
    """
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="llm-checkpoints-"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small frame with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def dropped(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add, in any letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes in ``column``, one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_pieces(
    df: DataFrame,
    column: str,
    added: list[T.StructField],
    setup: Callable[[], Callable[[pa.RecordBatch], list]],
    most: int = PIECE_BYTES,
) -> DataFrame:
    """Add columns computed from Arrow pieces of ``df``; other columns pass through.

    ``setup`` runs once in each task and returns the function from a piece to
    one Arrow array (or list) for each added field. A column of ``df`` that has
    the name of an added one is replaced.
    """
    names = {f.name.lower() for f in added}
    kept = [c for c in df.columns if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in kept] + added)
    kinds = [arrow_type(f.dataType) for f in added]
    order = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = setup()
        for batch in batches:
            for piece in pieces(batch, column, most):
                new = [
                    a if isinstance(a, pa.Array) else pa.array(a, k)
                    for a, k in zip(each(piece), kinds, strict=True)
                ]
                old = [piece.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(old + new, names=order)

    return df.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def texts(piece: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a piece; null is the empty text."""
    return [t or "" for t in piece.column(column).to_pylist()]


def split_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased if ``lower``.

    Returns the offsets of each text's words (one more than there are texts)
    and the flat words. Null and white-space-only texts have no words.
    """
    column = pc.fill_null(column, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return before[offsets - offsets[0]], flat.filter(full)


def coded_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As ``split_words``, with the words as codes into their dictionary."""
    offsets, flat = split_words(column, lower)
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def hash_words(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxhash of each word (uint64)."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def membership(keys: DataFrame, columns: list[str]) -> Callable[[pa.RecordBatch], np.ndarray]:
    """A test for tasks: which rows of a batch may have their ``columns`` (long) in ``keys``; none that has is missed.

    A Bloom filter of ``FILTER_BITS``, whatever the input; with very many keys it lets everything pass.
    """

    def spots(batch: pa.RecordBatch) -> np.ndarray:
        h = np.full(batch.num_rows, 17, np.uint64)
        for c in columns:
            h = mixed(h ^ pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        turns = [h, h >> np.uint64(32), mixed(h)]
        return np.stack([t % np.uint64(FILTER_BITS) for t in turns], 1).astype(np.int64)

    def bits(batches):
        for b in batches:
            at = np.unique(spots(b).ravel())
            words, first = np.unique(at >> 6, return_index=True)
            value = np.uint64(1) << (at & 63).astype(np.uint64)
            if len(at):
                value = np.bitwise_or.reduceat(value, first)
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.int64()), "bits": pa.array(value.view(np.int64))})

    rows = (
        keys.select(*columns)
        .mapInArrow(bits, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()  # FILTER_BITS / 64 rows at most
    )
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    def passes(batch: pa.RecordBatch) -> np.ndarray:
        at = spots(batch)
        hit = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return hit.all(axis=1)

    return passes


def prefiltered(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without most rows whose ``columns`` (long) are not in ``keys``, to spare their shuffle.

    Where there are so many keys that everything passes (see ``membership``),
    the join that must follow does all the work.
    """
    passes = membership(keys, columns)

    def passing(batches):
        for b in batches:
            yield b.filter(pa.array(passes(b)))

    return df.mapInArrow(passing, df.schema)


def crc_mod(column: str, n: int):
    """``crc32(id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
