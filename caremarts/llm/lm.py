"""Language-model scores by a log-bilinear model with noise-contrastive estimation (operator 6).

Every token of every training document is counted. The most frequent words are
classes of their own, all others share one class. The log-bilinear model predicts
the class of a token from the two before it: each context position maps the
predecessor's vector by its own matrix, the sum meets every class vector in a
batched matrix product, and a softmax over all classes normalises it. Text
probability is the product over its tokens and its end.

Inside the shared class, words sorted by frequency lie in blocks of ``BLOCK``. A
block's probability is its words' share of the smoothed counts; in the block each
word has a vector and a bias of its own, which the predicted vector meets in a
product over the block that a softmax normalises. So the vocabulary that has
vectors grows with the corpus, up to ``KNOWN`` words (a bound on what is
broadcast); words beyond keep the share of their smoothed counts.

Training covers all training documents: each partition takes one pass over its
own with noise-contrastive estimation (noise shared in a batch, drawn from the
unigram counts), and the partitions' parameters are averaged, weighted by tokens.
The parameters thus depend on how the input is partitioned. Then the tokens of each
block are shuffled to it, with the two classes before them, and its vectors take one
pass over them; a block of more than about ``SHARE`` tokens is learned in several
tasks and averaged likewise.

Counts of the most frequent words (``KNOWN`` at most) are broadcast; the
tokens beyond them meet their counts in a shuffle join, so nothing that grows
with the vocabulary is broadcast or collected.

Cases: null and empty texts are one end token; rows that repeat are scored
each; null ids count as the empty id text in the split; without any training
document all counts are zero and every model probability is uniform; an empty
table gives an empty table; other columns are not returned; of words that are
equally frequent, those of smaller hashes get a class of their own; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.llm.common import coded_words, hash_words, pieces, written

CLASSES = 1024  # the class of rare words, the end, and the most frequent words
KNOWN = 1 << 19  # words whose counts are broadcast, at most: 8 MiB
DIM = 16
NOISE = 96
BATCH = 1536
BLOCK = 256  # words of the shared class that are normalised together, at most 256
BLOCK_NOISE = 32
BLOCK_RATE = 0.1
SHARE = 1 << 22  # training tokens of a block in one task, about
RATE = 0.12
RARE, END = 0, 1
END_HASH = np.uint64(0xE2D0000000000001)
"""Stands for the end of a text; words hash elsewhere but for a chance of 2**-64 each."""


def hashed_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts as numbers, each text's offsets, and the hash of each number.

    Number 0 is the end, which closes every text.
    """
    offsets, codes, words = coded_words(column)
    n = np.diff(offsets)
    values = np.concatenate([[END_HASH], hash_words(words)]).astype(np.uint64)
    ends = offsets + np.arange(len(offsets))
    flat = np.zeros(int(ends[-1]), np.int64)
    spread = np.repeat(ends[:-1] - offsets[:-1], n) + np.arange(len(codes))
    flat[spread] = codes + 1
    return flat, ends, values


def token_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """(``token``, ``c``) over all documents of ``df``."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column, 16 << 20):
                flat, _, values = hashed_tokens(piece.column(column))
                n = np.bincount(flat, minlength=len(values))
                yield pa.RecordBatch.from_pydict(
                    {"token": pa.array(values.view(np.int64)), "n": pa.array(n.astype(np.int64))}
                )

    return df.select(column).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("c"))


class Counts:
    """Training totals, and the counts of the most frequent tokens."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.total, self.distinct = total, distinct
        top = np.lexsort((self.tokens, -self.counts))
        top = top[self.tokens[top] != END_HASH][: CLASSES - 2]
        self.class_of = np.full(len(self.tokens) + 1, RARE, np.int64)
        self.class_of[top] = np.arange(2, 2 + len(top))
        at = np.flatnonzero(self.tokens == END_HASH)
        self.class_of[at] = END
        self.class_count = np.zeros(CLASSES, np.int64)
        np.add.at(self.class_count, self.class_of[:-1], self.counts)
        own = self.class_of[:-1] != RARE
        self.class_count[RARE] = total - int(self.counts[own].sum())
        self.rare_distinct = distinct - int(own.sum())
        self.used = 2 + len(top)
        shared = np.flatnonzero(self.class_of[:-1] == RARE)
        shared = shared[np.lexsort((self.tokens[shared], -self.counts[shared]))]
        self.rank_of = np.full(len(self.tokens) + 1, -1, np.int64)
        self.rank_of[shared] = np.arange(len(shared))
        self.smoothed = self.counts[shared] + 1.0  # by rank
        self.block = BLOCK
        first = np.arange(0, len(shared), self.block)
        self.block_mass = np.add.reduceat(self.smoothed, first) if len(first) else np.zeros(0)
        self.blocks = len(first)
        self.shares = np.ceil(self.block_mass / SHARE).astype(np.int64)  # tasks that learn a block

    def look(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count (-1: not among the most frequent), class, and rank in the shared class (-1: none) of each hash."""
        at = np.searchsorted(self.tokens, values)
        inside = np.minimum(at, max(0, len(self.tokens) - 1))
        hit = self.tokens[inside] == values if len(self.tokens) else np.zeros(len(values), bool)
        count = np.where(hit, self.counts[inside] if len(self.tokens) else 0, -1)
        kind = np.where(hit, self.class_of[inside], RARE)
        kind[values == END_HASH] = END
        return count, kind, np.where(hit, self.rank_of[inside], -1)


def fitted_counts(counted: DataFrame) -> Counts:
    """Totals, and the counts from the least one that keeps ``KNOWN`` tokens or fewer."""
    bucket = F.floor(F.log2("c") * 64).cast("long")
    rows = counted.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.sum("c").alias("t"), F.min("c").alias("least")).collect()
    rows.sort(key=lambda r: -r["b"])
    kept, least = 0, None
    for r in rows:
        if kept + r["n"] > KNOWN:
            break
        kept, least = kept + r["n"], r["least"]
    known = counted.where(F.col("c") >= least).toArrow() if least is not None else None
    end = counted.where(F.col("token") == int(END_HASH.view(np.int64))).collect()
    tokens = known["token"].to_numpy().view(np.uint64) if known else np.zeros(0, np.uint64)
    counts = known["c"].to_numpy() if known else np.zeros(0, np.int64)
    if end and END_HASH not in tokens:
        tokens, counts = np.append(tokens, END_HASH), np.append(counts, end[0]["c"])
    return Counts(tokens, counts, sum(r["t"] for r in rows), sum(r["n"] for r in rows))


class LogBilinear:
    """Class vectors, context matrices and biases."""

    def __init__(self, counts: Counts):
        rng = np.random.default_rng(11)
        k = counts.used
        self.context = rng.normal(0, 0.1, (k, DIM)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (k, DIM)).astype(np.float32)
        self.maps = (np.stack([np.eye(DIM), np.eye(DIM) * 0.5]) + rng.normal(0, 0.05, (2, DIM, DIM))).astype(np.float32)
        share = (counts.class_count[:k] + 1) / (counts.class_count[:k] + 1).sum()
        self.noise = share
        self.bias = np.log(share).astype(np.float32)

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.target, self.maps, self.bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float64)

    def unpack(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for a in self.arrays():
            a[...] = flat[at : at + a.size].reshape(a.shape)
            at += a.size
        return self

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The vector that the two preceding classes (nearest first) predict."""
        return self.context[one] @ self.maps[0] + self.context[two] @ self.maps[1]

    def log_normaliser(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = np.empty(len(one), np.float32)
        for at in range(0, len(one), 4096):
            part = slice(at, at + 4096)
            score = self.predicted(one[part], two[part]) @ self.target.T + self.bias
            top = score.max(1)
            out[part] = np.log(np.exp(score - top[:, None]).sum(1)) + top
        return out


class Trainer:
    """One pass of noise-contrastive estimation with Adagrad over a partition."""

    def __init__(self, model: LogBilinear, seed: int):
        self.model, self.rng, self.tokens = model, np.random.default_rng(seed), 0
        self.memory = [np.full(a.shape, 0.02, np.float32) for a in model.arrays()]
        self.edges = np.cumsum(model.noise)
        self.log_noise = (np.log(model.noise) + math.log(NOISE)).astype(np.float32)

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        m = self.model
        self.tokens += len(word)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), len(m.bias) - 1)
        c1, c2 = m.context[one], m.context[two]
        hat = c1 @ m.maps[0] + c2 @ m.maps[1]
        goal, drawn = m.target[word], m.target[noise]
        real = np.einsum("bd,bd->b", hat, goal) + m.bias[word] - self.log_noise[word]
        fake = hat @ drawn.T + (m.bias - self.log_noise)[noise]
        g_real = -1 / (1 + np.exp(np.clip(real, -30, 30)))
        g_fake = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        n = np.float32(len(word))
        g_hat = (g_real[:, None] * goal + g_fake @ drawn) / n
        self._rows(1, np.concatenate([word, noise]), np.concatenate([g_real[:, None] * hat, g_fake.T @ hat]) / n)
        self._rows(3, np.concatenate([word, noise]), np.concatenate([g_real, g_fake.sum(0)]) / n)
        g_maps = np.stack([c1.T @ g_hat, c2.T @ g_hat])
        self._rows(0, np.concatenate([one, two]), np.concatenate([g_hat @ m.maps[0].T, g_hat @ m.maps[1].T]))
        self.memory[2] += g_maps**2 * n
        m.maps -= RATE * g_maps * math.sqrt(n) / np.sqrt(self.memory[2])

    def _rows(self, which: int, rows: np.ndarray, grad: np.ndarray) -> None:
        """Add up the gradients of equal rows, and step."""
        array, memory = self.model.arrays()[which], self.memory[which]
        total = np.zeros(array.shape, np.float32)
        if total.ndim == 1:
            total += np.bincount(rows, grad, len(total)).astype(np.float32)
        else:
            order = np.argsort(rows, kind="stable")
            own = rows[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            total[own[first]] = np.add.reduceat(grad[order], first, axis=0)
        scale = np.float32(BATCH)
        memory += total**2 * scale
        array -= RATE * total * math.sqrt(scale) / np.sqrt(memory)


def contexts(kinds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token; the end stands before a text."""
    one = np.concatenate([[END], kinds[:-1]])
    two = np.concatenate([[END, END], kinds[:-2]])[: len(kinds)]
    first = ends[:-1]
    one[first] = END
    two[first] = END
    second = first + 1
    two[second[second < ends[1:]]] = END
    return one, two


def fit(df: DataFrame, counts: Counts, column: str = "text") -> LogBilinear:
    """The average of the partitions' models, each trained on all of its documents."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(counts)

    def run(batches):
        trainer = None
        for batch in batches:
            for piece in pieces(batch, column):
                flat, ends, values = hashed_tokens(piece.column(column))
                trainer = trainer or Trainer(LogBilinear(shared.value), len(flat))
                kinds = shared.value.look(values)[1][flat]
                one, two = contexts(kinds, ends)
                order = trainer.rng.permutation(len(kinds))
                for at in range(0, len(order), BATCH):
                    own = order[at : at + BATCH]
                    trainer.step(one[own], two[own], kinds[own])
        if trainer is not None:
            flat = trainer.model.packed() * trainer.tokens
            yield pa.RecordBatch.from_pydict(
                {
                    "place": pa.array(np.arange(-1, len(flat))),
                    "value": pa.array(np.concatenate([[float(trainer.tokens)], flat])),
                }
            )

    summed = df.select(column).mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    rows = summed.toArrow()  # one row for each parameter
    model = LogBilinear(counts)
    if rows.num_rows:
        order = np.argsort(rows["place"].to_numpy())
        flat = rows["value"].to_numpy()[order]
        model.unpack(flat[1:] / flat[0])
    return model


class BlockWords:
    """Vectors and biases of the words of the shared class, by rank."""

    def __init__(self, counts: Counts):
        n, self.block = len(counts.smoothed), counts.block
        self.target = np.zeros((n, DIM), np.float16)
        self.bias = np.log(counts.smoothed / np.repeat(counts.block_mass, self.block)[:n]).astype(np.float32)

    def log_words(self, ranks: np.ndarray, pair: np.ndarray, hat: np.ndarray) -> np.ndarray:
        """Log-probability of each word, given its block; ``pair`` is its row of ``hat``.

        A block meets each of its contexts once.
        """
        out = np.empty(len(ranks), np.float64)
        order = np.lexsort((pair, ranks // self.block))
        blocks, first = np.unique(ranks[order] // self.block, return_index=True)
        ends = [*first[1:].tolist(), len(order)]
        pairs, places = pair[order], ranks[order] % self.block
        for block, lo, end in zip(blocks.tolist(), first.tolist(), ends):
            rows = slice(block * self.block, (block + 1) * self.block)
            target, bias = self.target[rows].astype(np.float32).T, self.bias[rows]
            for at in range(lo, end, 1 << 14):
                own = slice(at, min(end, at + (1 << 14)))
                new = np.ones(own.stop - at, bool)
                np.not_equal(pairs[at + 1 : own.stop], pairs[at : own.stop - 1], out=new[1:])
                context = np.cumsum(new) - 1
                score = hat[pairs[own][new]] @ target
                score += bias
                score -= score.max(1)[:, None]
                goal = score[context, places[own]]
                out[order[own]] = goal - np.log(np.exp(score, out=score).sum(1))[context]
        return out


class BlockTrainer:
    """One pass of noise-contrastive estimation with Adagrad over the tokens of one block.

    The predicted vectors stand; the words' vectors begin at zero and their
    biases at the smoothed counts, so a word that is hardly met keeps its share.
    """

    def __init__(self, bias: np.ndarray):
        n = len(bias)
        self.bias, self.target = bias.copy(), np.zeros((n, DIM), np.float32)
        self.memory = np.ones((n, DIM + 1), np.float32)
        self.edges = np.cumsum(np.exp(bias.astype(np.float64)))
        self.log_noise = bias + np.float32(math.log(BLOCK_NOISE))
        self.rng, self.tokens = np.random.default_rng(n), 0

    def step(self, place: np.ndarray, hat: np.ndarray) -> None:
        self.tokens += len(place)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(BLOCK_NOISE)), len(self.bias) - 1)
        shifted = self.bias - self.log_noise
        real = np.einsum("bd,bd->b", hat, self.target[place]) + shifted[place]
        fake = hat @ self.target[noise].T + shifted[noise]
        g_real = -1 / (1 + np.exp(np.clip(real, -30, 30)))
        g_fake = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        pull = np.zeros((len(self.bias), len(place)), np.float32)  # what each token does to each word
        pull[place, np.arange(len(place))] = g_real
        np.add.at(pull, noise, g_fake.T.astype(np.float32))
        grad = np.concatenate([pull @ hat, pull.sum(1)[:, None]], 1)
        self.memory += grad**2
        move = BLOCK_RATE * grad / np.sqrt(self.memory)
        self.target -= move[:, :DIM]
        self.bias -= move[:, DIM]

    def packed(self) -> np.ndarray:
        return np.concatenate([self.target, self.bias[:, None]], 1).ravel()


def block_tokens(df: DataFrame, counts: Counts, column: str = "text") -> DataFrame:
    """The training tokens of the shared class: a row for each block and piece of the texts.

    ``place`` holds a byte for each token, its word's place in the block, ``pair``
    four bytes, the classes before it. ``share`` spreads a block over tasks.
    """
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        counts = shared.value
        k, size = counts.used, counts.block
        for batch in batches:
            for piece in pieces(batch, column, 8 << 20):
                flat, ends, values = hashed_tokens(piece.column(column))
                _, kind, rank = counts.look(values)
                one, two = contexts(kind[flat], ends)
                ranks = rank[flat]
                at = np.flatnonzero(ranks >= 0)
                at = at[np.argsort(ranks[at] // size, kind="stable")]
                blocks, first = np.unique(ranks[at] // size, return_index=True)
                place = (ranks[at] % size).astype(np.uint8)
                pair = (one[at] * k + two[at]).astype(np.int32)
                cut = lambda a: [x.tobytes() for x in np.split(a, first[1:])][: len(blocks)]
                places, pairs = cut(place), cut(pair)
                share = [zlib.crc32(p) % int(counts.shares[b]) for b, p in zip(blocks, pairs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.int32()), pa.array(share, pa.int32()), pa.array(places, pa.binary()), pa.array(pairs, pa.binary())],
                    names=["block", "share", "place", "pair"],
                )

    return df.select(column).mapInArrow(run, "block int, share int, place binary, pair binary")


def fit_blocks(df: DataFrame, counts: Counts, model: LogBilinear, column: str = "text") -> BlockWords:
    """The vectors and biases of the shared class, each block trained on all of its tokens."""
    words = BlockWords(counts)
    if not counts.blocks:
        return words
    shared = df.sparkSession.sparkContext.broadcast((counts, model, words.bias))

    def train(batches):
        counts, model, bias = shared.value
        k, size, key, trainer = counts.used, counts.block, None, None
        none = held = np.zeros(0, np.uint8), np.zeros(0, np.int32)  # tokens short of a batch

        def learn(place, pair):
            for at in range(0, len(place), BATCH):
                own = pair[at : at + BATCH]
                trainer.step(place[at : at + BATCH], model.predicted(own // k, own % k))

        def done():
            learn(*held)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([key[0]], pa.int32()),
                    "tokens": pa.array([trainer.tokens], pa.int64()),
                    "value": pa.array([trainer.packed().astype(np.float32).tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for block, share, place, pair in rows:
                if key != (block, share):
                    if trainer is not None:
                        yield from done()
                    key = (block, share)
                    trainer, held = BlockTrainer(bias[block * size : (block + 1) * size]), none
                more = np.frombuffer(place, np.uint8), np.frombuffer(pair, np.int32)
                held = tuple(np.concatenate(x) for x in zip(held, more))
                full = len(held[0]) // BATCH * BATCH
                if full:
                    learn(held[0][:full], held[1][:full])
                    held = held[0][full:], held[1][full:]
        if trainer is not None:
            yield from done()

    def averaged(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for block, tokens, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held = total.setdefault(block, [0, 0.0])
                held[0] += tokens
                held[1] = held[1] + tokens * np.frombuffer(value, np.float32).astype(np.float64)
        for block, (tokens, value) in total.items():
            value = (value / tokens).reshape(-1, DIM + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "target": pa.array([value[:, :DIM].astype(np.float16).tobytes()], pa.binary()),
                    "bias": pa.array([value[:, DIM].astype(np.float32).tobytes()], pa.binary()),
                }
            )

    rows = (
        block_tokens(df, counts, column)
        .repartition("block", "share")
        .sortWithinPartitions("block", "share", "pair")
        .mapInArrow(train, "block int, tokens long, value binary")
        .repartition("block")
        .mapInArrow(averaged, "block int, target binary, bias binary")
        .toArrow()  # KNOWN words at most, 36 bytes each
    )
    for block, target, bias in zip(*(rows.column(i).to_pylist() for i in range(3))):
        own = slice(block * words.block, (block + 1) * words.block)
        words.target[own] = np.frombuffer(target, np.float16).reshape(-1, DIM)
        words.bias[own] = np.frombuffer(bias, np.float32)
    return words


PARTS = (
    "row_key long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "log_known double, log_class double, n_rare long, log_rare double, open array<long>, times array<int>"
)


def scored_parts(df: DataFrame, counts: Counts, model: LogBilinear, words: BlockWords) -> DataFrame:
    """What each text's scores need, but for the counts of its tokens beyond the broadcast ones.

    ``open`` lists those tokens and ``times`` how often each occurs.
    """
    shared = df.sparkSession.sparkContext.broadcast((counts, model, words))

    def run(batches):
        counts, model, words = shared.value
        k = counts.used
        log_z = np.full(k * k, np.nan, np.float32)
        for batch in batches:
            for piece in pieces(batch, "text"):
                flat, ends, values = hashed_tokens(piece.column("text"))
                count, kind, rank = counts.look(values)
                if not counts.distinct:
                    count[:] = 0
                n, kinds = count[flat], kind[flat]
                one, two = contexts(kinds, ends)
                pair = one * k + two
                new = np.unique(pair[np.isnan(log_z[pair])])
                log_z[new] = model.log_normaliser(new // k, new % k)
                hat_pairs, back = np.unique(pair, return_inverse=True)
                hat = model.predicted(hat_pairs // k, hat_pairs % k)
                score = np.empty(len(flat), np.float64)
                for at in range(0, len(flat), 1 << 17):
                    part = slice(at, at + (1 << 17))
                    score[part] = np.einsum("bd,bd->b", hat[back[part]], model.target[kinds[part]])
                score = (score + model.bias[kinds] - log_z[pair]) / math.log(10)
                logs = np.log10(np.maximum(n, 0) + 1.0)
                rare, starts = kinds == RARE, ends[:-1]
                inside = np.where(rare, logs, 0.0)
                own = np.flatnonzero(rank[flat] >= 0)
                ranks = rank[flat[own]]
                shares = words.log_words(ranks, back[own], hat) / math.log(10)
                inside[own] = shares + np.log10(counts.block_mass[ranks // counts.block])
                add = lambda x: np.add.reduceat(x, starts)
                owner = np.repeat(np.arange(len(starts)), np.diff(ends))
                left = np.flatnonzero(n < 0)
                pairs, times = np.unique(owner[left] * len(values) + flat[left], return_counts=True)
                at = np.searchsorted(pairs // len(values), np.arange(len(starts) + 1)).astype(np.int32)
                item = lambda a, t: pa.ListArray.from_arrays(pa.array(at), pa.array(a, t))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row_key"),
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.array(add((n > 0).astype(np.int64))),
                        pa.array(add(logs)),
                        pa.array(add(score)),
                        pa.array(add(rare.astype(np.int64))),
                        pa.array(add(inside)),
                        item(values[pairs % len(values)].view(np.int64), pa.int64()),
                        item(times.astype(np.int32), pa.int32()),
                    ],
                    names=[c.split()[0] for c in PARTS.split(", ")],
                )

    return df.select("row_key", "doc_id", "held_out", "text").mapInArrow(run, PARTS)


def score_texts(df: DataFrame, training: str) -> DataFrame:
    """Score every text of ``df`` (``doc_id``, ``text``); rows where ``training`` holds teach."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("held_out", ~F.expr(training))
    return scored(rows, *taught(rows.where("not held_out")))


def taught(learn: DataFrame) -> tuple[DataFrame, Counts, LogBilinear, BlockWords]:
    """What the texts of ``learn`` teach: all counts (written), the most frequent ones, and the model's two levels."""
    counted = written(token_counts(learn), "lm-counts")
    counts = fitted_counts(counted)
    model = fit(learn, counts)
    return counted, counts, model, fit_blocks(learn, counts, model)


def scored(rows: DataFrame, counted: DataFrame, counts: Counts, model: LogBilinear, words: BlockWords) -> DataFrame:
    """Score ``rows`` (``doc_id``, ``text``, ``held_out``) by what was taught."""
    keyed = rows.withColumn("row_key", F.monotonically_increasing_id())
    parts = written(scored_parts(keyed, counts, model, words), "lm-parts")
    waiting = parts.select("row_key", F.explode(F.arrays_zip("open", "times")).alias("t")).select(
        "row_key", F.col("t.open").alias("token"), F.col("t.times").alias("times")
    )
    met = (
        waiting.join(counted, "token")
        .groupBy("row_key")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_log"))
    )
    base = math.log10(counts.total + counts.distinct + 1)
    rare = math.log10(max(counts.class_count[RARE], 0) + counts.rare_distinct + 1)
    more = F.coalesce("more_log", F.lit(0.0))
    return parts.join(met, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("log_known") + more - F.col("n_tokens") * base).alias("base_score"),
        (F.col("log_class") + F.col("log_rare") + more - F.col("n_rare") * rare).alias("score"),
    )


def lm_scores(docs: DataFrame) -> DataFrame:
    """The registered result: every document scored by what the training documents teach."""
    flagged = docs.select("doc_id", "text")
    return score_texts(flagged, "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 != 2")
