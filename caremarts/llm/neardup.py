"""MinHash near-duplicates with tensored banding (operator 4).

A text's set is its distinct 5-word shingles. ``COLLECTIONS`` small collections
of ``ROWS`` minhashes each are computed; a table's key combines two of them, so
C(16, 2) = 120 tables of four minhashes cost 32 minhash evaluations instead of
480. Two sets of similarity s meet in some table unless fewer than two of the
collections agree, each of which does with probability s**2: at s = 0.75 the
chance to miss is 4e-5, and it falls fast above.

Texts with equal sets collapse first. Then each table bucket proposes its
members to its least member; proposals are confirmed on full sets and joined to
components. In buckets that still hold several components every pair across
components is compared by long sketches (``SKETCH`` minhashes of 8 bits), in
blocks of about ``BLOCK`` members a task, and only pairs whose sketches agree
nearly as often as they would at the threshold (four standard deviations below)
are proposed, once each. So a link is lost only if its texts share no bucket or
miss that bound by chance (3e-5 at the threshold, far less above). Nothing is capped; a large group of near
copies costs a row a member and table, and no pair is shipped for a bucket
whose members are already connected.

Cases: null and empty texts, and texts of white space only, have an empty set
and link with nothing; rows with a null id link with nothing and are not kept
(their component is null); rows that repeat an id and text share a component;
several texts under one id count as one document with the links of each;
an empty table gives an empty table; other columns are not returned; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import checkpointed, coded_words, hash_words, map_pieces, mixed, prefiltered, written
from caremarts.llm.components import components

SHINGLE = 5
PERCENT = 75  # links have 100 * intersection >= PERCENT * union
COLLECTIONS = 16
ROWS = 2
SKETCH = 512  # minhashes that decide whether a remaining pair is worth confirming
AGREE = SKETCH * 0.75 - 4 * (SKETCH * 0.75 * 0.25) ** 0.5
BLOCK = 512  # members of a bucket that meet as many others in one task
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's distinct shingles, sorted, and each text's offsets."""
    offsets, codes, words = coded_words(column)
    value = hash_words(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(codes)) - offsets[:-1][owner]
    width = np.minimum(n, SHINGLE)[owner]  # a shorter text is one shingle
    starts = np.flatnonzero(place + width <= n[owner])
    own, width = owner[starts], width[starts]
    total = width.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SHINGLE):
            use = width > j
            total[use] = (total[use] * STEP) ^ mixed(value[starts[use] + j])
    total = mixed(total)
    order = np.lexsort((total, own))
    own, total = own[order], total[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (total[1:] != total[:-1])
    return total[new], np.searchsorted(own[new], np.arange(len(n) + 1))


def minhash_collections(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each non-empty set one 64-bit value of each collection."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), COLLECTIONS), np.uint64)
    if not len(starts):
        return out
    rng = np.random.default_rng(41)
    odd = rng.integers(0, 1 << 63, (COLLECTIONS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, (COLLECTIONS, ROWS), np.uint64)
    with np.errstate(over="ignore"):
        for c in range(COLLECTIONS):
            value = np.full(len(starts), c, np.uint64)
            for r in range(ROWS):
                least = np.minimum.reduceat(hashes * odd[c, r] + add[c, r], starts)
                value = mixed(value * STEP ^ mixed(least))
            out[:, c] = value
    return out


TABLES = np.array(list(combinations(range(COLLECTIONS), 2)))
LOW = np.uint64(127)

SIGNED = [
    T.StructField("n_shingles", T.LongType(), False),
    T.StructField("set_key", T.BinaryType()),
    T.StructField("minhashes", T.BinaryType()),
]


def signed(df: DataFrame, column: str = "text") -> DataFrame:
    """Add the set's size, a 128-bit key of the whole set and its minhash collections.

    The key and the minhashes (``COLLECTIONS`` packed uint64) are null for an empty set.
    """

    def setup():
        def each(piece: pa.RecordBatch) -> list:
            hashes, offsets = shingles(piece.column(column))
            size = np.diff(offsets)
            full = np.flatnonzero(size)
            values = minhash_collections(hashes, offsets)
            sums = [
                np.add.reduceat(mixed(hashes + np.uint64(s)), offsets[full]) if len(full) else np.zeros(0, np.uint64)
                for s in (1, 2)
            ]
            keys: list = [None] * len(size)
            packed: list = [None] * len(size)
            for i, d in enumerate(full.tolist()):
                keys[d] = sums[0][i].tobytes() + sums[1][i].tobytes()
                packed[d] = values[i].tobytes()
            return [pa.array(size.astype(np.int64)), keys, packed]

        return each

    return map_pieces(df, column, SIGNED, setup)


def table_keys(classes: DataFrame) -> DataFrame:
    """(``key``, ``node``, ``n``): a row for each class and table; a key's low bits are its table."""
    pairs = TABLES
    salt = mixed(np.arange(len(pairs), dtype=np.uint64) + np.uint64(1000))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                raw = b"".join(part.column("minhashes").to_pylist())
                values = np.frombuffer(raw, np.uint64).reshape(-1, COLLECTIONS)
                with np.errstate(over="ignore"):
                    keys = mixed(values[:, pairs[:, 0]] * STEP ^ mixed(values[:, pairs[:, 1]] + salt))
                keys = keys & ~LOW | np.arange(len(pairs), dtype=np.uint64)
                rows = np.repeat(np.arange(len(values)), len(pairs))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(keys.ravel().view(np.int64)),
                        "node": part.column("node").take(pa.array(rows)),
                        "n": part.column("n").take(pa.array(rows)),
                    }
                )

    return classes.select("node", "n", "minhashes").mapInArrow(run, "key long, node long, n long")


def _sizes_fit(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of ids whose full sets are similar enough.

    ``docs`` has ``node`` and ``text``. Both texts travel to the pair; sets are
    rebuilt and intersected there, piece by piece.
    """
    left = docs.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def setup():
        def each(piece: pa.RecordBatch) -> list:
            one, one_at = shingles(piece.column("text_a"))
            two, two_at = shingles(piece.column("text_b"))
            n1, n2 = np.diff(one_at), np.diff(two_at)
            rows = np.arange(len(n1))
            owner = np.concatenate([np.repeat(rows, n1), np.repeat(rows, n2)])
            value = np.concatenate([one, two])
            order = np.lexsort((value, owner))
            owner, value = owner[order], value[order]
            same = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
            shared = np.bincount(owner[1:][same], minlength=len(rows))
            return [pa.array(100 * shared >= PERCENT * (n1 + n2 - shared))]

        return each

    checked = map_pieces(both, "text_a", [T.StructField("linked", T.BooleanType(), False)], setup, 2 << 20)
    return checked.where("linked").select("a", "b").distinct()


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every class that is linked with another."""
    order = Window.partitionBy("key").orderBy("node")
    met = written(
        table_keys(classes)
        .withColumn("leader", F.first("node").over(order))
        .withColumn("next", F.lead("node").over(order))
        .where("leader != node or next is not null")
        .select("key", "node", "n", F.first("n").over(order).alias("leader_n"), "leader"),
        "neardup-buckets",
    )
    # only texts that share a bucket with another are read again
    nodes = met.select("node").distinct()
    docs = written(
        prefiltered(docs.where("node is not null"), nodes, ["node"]).join(nodes, "node", "left_semi").select("node", "text"),
        "neardup-texts",
    )
    pair = [F.col("leader").alias("a"), F.col("node").alias("b")]
    first = checkpointed(
        met.where("leader != node").where(_sizes_fit("n", "leader_n")).select(*pair).distinct()
    )
    edges = checkpointed(confirmed(first, docs))
    known = components(edges)
    at = met.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = (
        at.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        .where("lo != hi")
        .select("key", "size")
    )
    rest = written(at.select("key", "node", "n", "component").join(split, "key"), "neardup-rest")
    across = checkpointed(likely_pairs(rest, docs).join(first, ["a", "b"], "left_anti"))
    more = checkpointed(confirmed(across, docs))
    return components(edges.unionByName(more))


def sketched(docs: DataFrame) -> DataFrame:
    """(``node``, ``sketch``): ``SKETCH`` minhashes of 8 bits, then 32 bits of each collection."""

    def setup():
        rng = np.random.default_rng(43)
        odd = rng.integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, SKETCH, np.uint64)

        def each(piece: pa.RecordBatch) -> list:
            hashes, offsets = shingles(piece.column("text"))
            out: list = [None] * piece.num_rows
            short = minhash_collections(hashes, offsets).astype(np.uint32)
            full = np.flatnonzero(np.diff(offsets))
            for i, d in enumerate(full.tolist()):
                least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
                for at in range(offsets[d], offsets[d + 1], 1024):
                    own = hashes[at : min(at + 1024, offsets[d + 1])]
                    with np.errstate(over="ignore"):
                        least = np.minimum(least, (own[:, None] * odd + add).min(0))
                out[d] = (mixed(least) & np.uint64(255)).astype(np.uint8).tobytes() + short[i].tobytes()
            return [out]

        return each

    made = map_pieces(docs, "text", [T.StructField("sketch", T.BinaryType())], setup, 2 << 20)
    return made.where("sketch is not null").select("node", "sketch").distinct()


def likely_pairs(rest: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs across components of a bucket whose sketches agree, each once.

    ``rest`` has ``key``, ``node``, ``n``, ``component`` and the bucket's ``size``.
    A bucket is dealt into blocks; each pair of blocks is a group of about twice
    ``BLOCK`` rows at most, which one task reads as it comes.
    """
    nodes = rest.select("node").distinct()
    sketches = sketched(docs.join(nodes, "node", "left_semi"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (
        rest.join(sketches, "node")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key",
            F.least("block", "other").alias("lo"),
            F.greatest("block", "other").alias("hi"),
            "block",
            "node",
            "n",
            "component",
            "sketch",
        )
    )
    order = ["key", "lo", "hi"]
    grouped = dealt.repartition(*order).sortWithinPartitions(*order)

    def run(batches):
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            group = _groups(table)
            whole = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if whole:
                yield from _pairs(table.slice(0, whole), group[:whole])
            left = table.slice(whole).combine_chunks()
        if left is not None and left.num_rows:
            yield from _pairs(left, _groups(left))

    return grouped.mapInArrow(run, "a long, b long").distinct()


def _groups(table: pa.Table) -> np.ndarray:
    """Number of each row's group; groups are neighbours."""
    key, lo, hi = (table.column(c).to_numpy() for c in ("key", "lo", "hi"))
    new = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return np.concatenate([[0], np.cumsum(new)]) if len(key) else np.zeros(0, np.int64)


def _pairs(table: pa.Table, group: np.ndarray):
    column = lambda c: table.column(c).to_numpy()
    node, n, component, block = (column(c) for c in ("node", "n", "component", "block"))
    one_block = column("lo") == column("hi")
    number = (column("key").view(np.uint64) & LOW).astype(np.int64)
    raw = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
    sketch, short = raw[:, :SKETCH], np.ascontiguousarray(raw[:, SKETCH:]).view(np.uint32)
    most = int(np.bincount(group).max())
    for d in range(1, most):
        i = np.flatnonzero(group[d:] == group[:-d])
        j = i + d
        fit = (component[i] != component[j]) & (one_block[i] | (block[i] != block[j]))
        fit &= 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
        i, j = i[fit], j[fit]
        for at in range(0, len(i), 8192):
            x, y = i[at : at + 8192], j[at : at + 8192]
            near = (sketch[x] == sketch[y]).sum(1) >= AGREE
            x, y = x[near], y[near]
            if not len(x):
                continue
            same = short[x] == short[y]  # a pair is proposed by the first table that it shares
            met = same[:, TABLES[:, 0]] & same[:, TABLES[:, 1]]
            first = met.argmax(1) == number[x]
            x, y = x[first], y[first]
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(np.minimum(node[x], node[y])), "b": pa.array(np.maximum(node[x], node[y]))}
            )


def near_duplicates(df: DataFrame, column: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    docs = df.select("doc_id", F.col(column).alias("text"))
    rows = written(signed(docs).select("doc_id", "n_shingles", "set_key", "minhashes"), "neardup-signed")
    full = rows.where("set_key is not null and doc_id is not null")
    classes = checkpointed(
        full.groupBy("set_key").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("minhashes").alias("minhashes")
        )
    )
    found = links(docs.withColumnRenamed("doc_id", "node"), classes)
    node = classes.select("set_key", F.col("node").alias("class_node"))
    with_class = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(
        node, "set_key", "left"
    )
    named = with_class.join(found.withColumnRenamed("node", "class_node"), "class_node", "left")
    component = F.coalesce("component", "class_node", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
