"""URL filters by Bloom filter cascades (operator 9).

A cascade answers exactly for every key of a known universe. Its first level
encodes the listed keys; the second the universe's keys that the first admits
wrongly; the third the listed keys that the second admits wrongly; and so on
until a level admits nothing wrongly. A key belongs to the list if the first
level that rejects it has an even number (or none does and the count is odd).

The universe is every key that the corpus's urls can ask for, gathered by
Spark, so looking up needs no join: the levels are broadcast. A cascade is
built over blocks of the key space (by key hash); a block's levels stay under
``BLOCK_BYTES``, and where there are several blocks the urls pass one block's
broadcast at a time.

Cases: null urls and urls without ``://`` have empty host and path, fit no
rule and are allowed; an empty path fits no rule whose path is not empty;
repeated rows get equal results; an empty table gives an empty table; an empty
list admits nothing; columns named like output columns are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import checkpointed, map_pieces, written

BLOCK_BYTES = 32 << 20
BLOCK_KEYS = 8_000_000  # listed keys of a block, about: 32 bits a key and further levels fit in BLOCK_BYTES
RATES = (0.01, 0.5)  # wrongly admitted share of the first level, and of later ones

# The rules of the registered query, as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# Words that mark a host label as unwanted; labels are split at hyphens.
UNWANTED = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "track")


@dataclass
class Level:
    bits: np.ndarray  # uint64 words
    size: int  # bits
    hashes: int
    seed: int

    def places(self, keys: list[str]) -> np.ndarray:
        """Bit numbers of each key: one row a key."""
        digest = xxhash.xxh3_128_intdigest
        whole = [digest(k, self.seed) for k in keys]
        a = np.array([h & 0xFFFFFFFFFFFFFFFF for h in whole], np.uint64)
        b = np.array([h >> 64 | 1 for h in whole], np.uint64)
        with np.errstate(over="ignore"):
            steps = a[:, None] + b[:, None] * np.arange(self.hashes, dtype=np.uint64)
        return (steps % np.uint64(self.size)).astype(np.int64)

    def admits(self, keys: list[str]) -> np.ndarray:
        if not self.size or not keys:
            return np.zeros(len(keys), bool)
        at = self.places(keys)
        return ((self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def member(levels: list[Level], keys: list[str]) -> np.ndarray:
    """Exact membership of keys of the universe."""
    out = np.zeros(len(keys), bool)
    open_ = np.arange(len(keys))
    for number, level in enumerate(levels):
        if not len(open_):
            break
        admitted = level.admits([keys[i] for i in open_])
        # rejected at an odd level (0, 2, ...): not encoded with the listed side, so not listed
        out[open_[~admitted]] = number % 2 == 1
        open_ = open_[admitted]
    out[open_] = len(levels) % 2 == 1
    return out


def block_of(keys: list[str], blocks: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k, 99) % blocks for k in keys], np.int64)


def _encoded(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """One level: bit words gathered by Spark from all partitions."""
    hashes = max(1, round(math.log2(1 / rate)))
    size = max(64, math.ceil(n * hashes / math.log(2)))
    shape = Level(np.zeros(0, np.uint64), size, hashes, seed)

    def run(batches):
        for b in batches:
            at = np.unique(shape.places(b.column("key").to_pylist()).ravel())
            words, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else []
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(words, pa.int64()), "bits": pa.array(np.asarray(bits, np.uint64).view(np.int64))}
            )

    rows = (
        keys.select("key")
        .mapInArrow(run, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()  # a block's level, under BLOCK_BYTES
    )
    shape.bits = np.zeros((size + 63) // 64, np.uint64)
    shape.bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return shape


def _admitted(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for b in batches:
            names = b.column("key")
            yield pa.RecordBatch.from_arrays([names.filter(pa.array(shared.value.admits(names.to_pylist())))], ["key"])

    return keys.select("key").mapInArrow(run, "key string")


def fit_cascade(universe: DataFrame) -> list[list[Level]]:
    """Levels of each block from distinct rows (``key``, ``listed``)."""
    universe = written(universe, "url-universe")
    listed = universe.where("listed").count()
    blocks = max(1, math.ceil(listed / BLOCK_KEYS))
    out = []
    for block in range(blocks):
        own = universe
        if blocks > 1:

            def run(batches, block=block):
                for b in batches:
                    yield b.filter(pa.array(block_of(b.column("key").to_pylist(), blocks) == block))

            own = written(universe.mapInArrow(run, universe.schema), "url-block")
        inside, outside = own.where("listed"), own.where("not listed")
        levels: list[Level] = []
        n = inside.count()
        while n:
            level = _encoded(inside, n, RATES[min(len(levels), 1)], seed=len(levels))
            levels.append(level)
            wrong = checkpointed(_admitted(outside, level))
            inside, outside, n = wrong, inside, wrong.count()
        out.append(levels)
    return out


def listed_among(df: DataFrame, column: str, cascade: list[list[Level]], out: str) -> DataFrame:
    """Add ``out``: the keys of the array ``column`` that the cascade lists, in order."""
    spark = df.sparkSession
    df = df.withColumn("__cut", F.concat_ws("", column)).withColumn(out, F.array().cast("array<string>"))
    for number, levels in enumerate(cascade):
        shared, blocks = spark.sparkContext.broadcast(levels), len(cascade)

        def setup(shared=shared, number=number, blocks=blocks):
            def each(piece: pa.RecordBatch) -> list:
                asked = piece.column(column).to_pylist()
                names = sorted({k for own in asked for k in own or ()})
                if blocks > 1:
                    names = [k for k, b in zip(names, block_of(names, blocks)) if b == number]
                found = {k for k, yes in zip(names, member(shared.value, names)) if yes}
                before = piece.column(out).to_pylist()
                return [
                    [[k for k in own or () if k in found or k in was] for own, was in zip(asked, before)]
                ]

            return each

        df = map_pieces(df, "__cut", [T.StructField(out, T.ArrayType(T.StringType()))], setup)
        if len(cascade) > 1:
            df = written(df, "url-pass")
    return df.drop("__cut")


def with_host_and_path(df: DataFrame, column: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    at = F.instr(column, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{column}`, instr(`{column}`, '://') + 3)")).otherwise(F.lit(""))
    raw = F.regexp_extract("__rest", "^[^/?#]*", 0)
    return (
        df.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        .withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(host) + 1)"), "^[^?#]*", 0))
        .drop("__rest")
    )


def host_suffixes(host: str = "host"):
    """The host and every domain above it, longest first."""
    labels = F.split(F.col(host), "\\.")
    return F.when(F.col(host) == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    )


def rule_keys(lengths: list[int]):
    """What rules a url can fit: a suffix of the host, then that much of the path."""
    none = F.array().cast("array<string>")

    def with_path(n: int):
        start = F.col("path").substr(1, n)
        return F.when(F.length("path") >= n, F.transform(host_suffixes(), lambda s: F.concat(s, start))).otherwise(none)

    per_length = [with_path(n) for n in lengths]
    return F.concat(*per_length)


def filter_urls(df: DataFrame, rules=RULES, unwanted=UNWANTED, column: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to rows with a url.

    The longest fitting rule decides. Without one the verdict is block if the
    host is on the list of unwanted hosts (a label of it holds one of
    ``unwanted`` between hyphens) and allow otherwise. Rules and hosts are
    looked up in cascades over all keys and hosts of ``df``.
    """
    parsed = with_host_and_path(df, column)
    lengths = sorted({len(p) for _, p, _ in rules})
    asked = parsed.withColumn("__keys", rule_keys(lengths))
    universe = asked.select(F.explode("__keys").alias("key")).distinct()
    hosts = parsed.select(F.col("host").alias("key")).distinct()
    marked = F.exists(F.split(F.col("key"), "[-.]"), lambda w: w.isin(*unwanted)) if unwanted else F.lit(False)
    for verdict in ("block", "allow"):
        names = [h + p for h, p, v in rules if v == verdict]
        cascade = fit_cascade(universe.withColumn("listed", F.col("key").isin(*names) if names else F.lit(False)))
        asked = listed_among(asked, "__keys", cascade, f"__{verdict}")
    cascade = fit_cascade(hosts.withColumn("listed", marked))
    asked = listed_among(asked.withColumn("__host", F.array("host")), "__host", cascade, "__listed")
    longest = lambda c: F.array_max(F.transform(c, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))
    fits = F.array_max(
        F.filter(
            F.array(
                F.struct(longest("__block").alias("m"), F.lit("block").alias("v")),
                F.struct(longest("__allow").alias("m"), F.lit("allow").alias("v")),
            ),
            lambda x: x["m"].isNotNull(),
        )
    )
    return (
        asked.withColumn("__fit", fits)
        .withColumn("rule", F.col("__fit.m.k"))
        .withColumn("verdict", F.coalesce("__fit.v", F.when(F.size("__listed") > 0, "block").otherwise("allow")))
        .drop("__fit", "__keys", "__block", "__allow", "__host", "__listed")
    )


def url_verdicts(pages: DataFrame) -> DataFrame:
    """The registered result for every page's url."""
    return filter_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
