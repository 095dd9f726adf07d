"""Toxicity scores by a convolutional text classifier trained in numpy (operator 2).

Words become sums of hashed embeddings (the word and its leading letters);
filters of several widths slide over them, each filter keeps its maximum over
the whole text, and a linear layer gives the logit. Every labelled row is used:
a fifth, drawn by a hash of the id, is held back to calibrate, for each
language, the threshold from which a text is rejected, and all others teach.
Training begins with some rows of both classes (about ``FIRST_TOXIC`` and
``FIRST_CLEAN``; with fewer labels, all) in one task, passes over them a few
times and corrects the logit for their class balance. The rows that are left
then teach in ``ROUNDS`` rounds, each row in one of them: the tasks of a round
go on from the same weights, each over its own rows, and a weight's new value
is the mean of the tasks' values by the texts that moved it. Texts are used
whole; what tasks return has the size of the weights.

Scoring broadcasts the model, whose size is fixed by its parameters, and maps
all texts. Scores depend on the text alone; the language only picks the
threshold.

Cases: null and empty texts get the score of a text without words; labels of
null ids or null values teach nothing; several labels of one document count as
their maximum; repeated rows get equal scores; without any labelled row of
both classes every score is the share of toxic labels (0 without labels);
columns named like output columns are replaced; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import coded_words, crc_mod, map_pieces, mixed, pieces, quoted

FIRST_TOXIC = 2000  # labelled rows of either class that teach first, in one task, about
FIRST_CLEAN = 3000
ROUNDS = 2  # in which the other rows teach, in many tasks
TASK_ROWS = 1 << 14  # that teach in one task: it returns 5 MB of weights, however many rows it reads
HELD = 5  # one of so many labelled rows calibrates
GRID = 1 << 12  # thresholds are multiples of its inverse
BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
STEPS = 900  # batches, or passes enough over a small sample
EPOCHS = (6, 30)
BATCH = 32
RATE = 0.08
LEAST_DOCS = 3
PREFIXES = (4, 5, 6)
STRIPPED = "\"'.,;:!?()[]{}<>«»„“”‘’…-–—*_"
DEFAULT_THRESHOLD = 0.3


def word_features(words: pa.Array) -> np.ndarray:
    """Hash buckets of each word, stripped and lower-cased: the word, and its leading bytes."""
    words = pc.utf8_lower(pc.utf8_trim(words, STRIPPED)).cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    first, size = offsets[:-1] - offsets[0], np.diff(offsets)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    out = np.empty((len(words), 1 + len(PREFIXES)), np.int64)
    place = np.arange(len(data)) - np.repeat(first, size)
    value = mixed(data.astype(np.uint64) + np.uint64(257) * place.astype(np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    for i, n in enumerate((1 << 40, *PREFIXES)):
        key = mixed(sums[first + np.minimum(size, n)] - sums[first] + np.uint64(i))
        out[:, i] = (key % np.uint64(BUCKETS)).astype(np.int64)
    return out


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each text, where every text is followed by padding."""
    pad = max(WIDTHS) - 1
    size = np.diff(offsets) + pad + 1
    return np.concatenate([[0], np.cumsum(size)[:-1]]), size


@dataclass
class TextCnn:
    """Parameters of the classifier; ``balance`` moves logits to the corpus's class balance."""

    table: np.ndarray
    convs: list[np.ndarray]  # for each width: offsets x DIM x FILTERS
    shift: np.ndarray
    dense: np.ndarray
    bias: float
    balance: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> TextCnn:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        return cls(
            rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32),
            [rng.normal(0, 0.4, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS],
            np.full(n, 0.05, np.float32),
            rng.normal(0, 0.3, n).astype(np.float32),
            0.0,
        )

    def pooled(
        self, features: np.ndarray, codes: np.ndarray, offsets: np.ndarray, where: bool = False
    ) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Each text's maximum of every filter, and where it was met.

        ``features`` has a row for each distinct word and ``codes`` the words of
        all texts; padding is a zero embedding at index ``len(features)``.
        """
        emb = np.zeros((len(features) + 1, DIM), np.float32)
        emb[:-1] = self.table[features].sum(1) if len(features) else 0
        starts, size = _spans(offsets)
        flat = np.full(int(size.sum()), len(features), np.int64)
        spread = np.repeat(starts - offsets[:-1], np.diff(offsets)) + np.arange(len(codes))
        flat[spread] = codes
        best = np.empty((len(size), len(self.shift)), np.float32)
        arg = np.empty(best.shape, np.int64) if where else None
        for i, conv in enumerate(self.convs):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            # doubles: a word's product must not depend on which other words are there
            each = [(emb.astype(np.float64) @ part).astype(np.float32) for part in conv]
            total = each[0][flat]
            for j in range(1, len(conv)):
                total[:-j] += each[j][flat[j:]]
            for j in range(1, max(WIDTHS)):  # from there a filter would reach into the next text
                total[starts + size - j] = 0
            best[:, own] = np.maximum.reduceat(total, starts, axis=0)
            if where:
                for d, (s, n) in enumerate(zip(starts.tolist(), size.tolist())):
                    arg[d, own] = s + total[s : s + n].argmax(0)
        return best + self.shift, arg, flat

    def logits(self, features: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        best, _, _ = self.pooled(features, codes, offsets)
        return np.maximum(best, 0).astype(np.float64) @ self.dense + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability that each text is toxic."""
        if self.constant is not None:
            return np.full(len(column), self.constant)
        offsets, codes, words = coded_words(column)
        features = word_features(words)
        logit = self.logits(features, codes, offsets) + self.balance
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -60, 60)))

    def dumped(self) -> bytes:
        out = io.BytesIO()
        langs = sorted(self.thresholds)
        np.savez(
            out,
            table=self.table.astype(np.float32),
            shift=self.shift,
            dense=self.dense,
            scalars=np.array([self.bias, self.balance, math.nan if self.constant is None else self.constant]),
            langs=np.array(langs, dtype=np.str_),
            limits=np.array([self.thresholds[x] for x in langs]),
            **{f"conv{i}": c for i, c in enumerate(self.convs)},
        )
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> TextCnn:
        z = np.load(io.BytesIO(data))
        bias, balance, constant = z["scalars"].tolist()
        return cls(
            z["table"],
            [z[f"conv{i}"] for i in range(len(WIDTHS))],
            z["shift"],
            z["dense"],
            bias,
            balance,
            None if math.isnan(constant) else constant,
            dict(zip(z["langs"].tolist(), z["limits"].tolist())),
        )


class Learner:
    """Adagrad on the maxima's positions.

    ``holders`` counts the texts of each bucket: one that fewer than LEAST_DOCS
    texts share can only be learned by heart, so it stays zero.
    """

    def __init__(self, net: TextCnn, memory: np.ndarray | None = None, holders: np.ndarray | None = None):
        self.net = replace(net, table=net.table.copy(), convs=[c.copy() for c in net.convs], shift=net.shift.copy(), dense=net.dense.copy())
        self.holders = np.zeros(BUCKETS, np.int64) if holders is None else holders.copy()
        self.memory = [np.full(p.shape, 1e-3, np.float32) for p in self.params()]
        if memory is not None:
            self._unpack(self.memory, memory)

    def params(self) -> list[np.ndarray]:
        net = self.net
        return [net.table, *net.convs, net.shift, net.dense, np.full(1, net.bias)]

    @staticmethod
    def _pack(arrays: list[np.ndarray]) -> np.ndarray:
        """The arrays as rows of DIM numbers: a row for each bucket, then the others."""
        rest = np.concatenate([x.ravel() for x in arrays[1:]])
        rest = np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)
        return np.concatenate([arrays[0], rest]).astype(np.float64)

    @staticmethod
    def _unpack(arrays: list[np.ndarray], rows: np.ndarray) -> None:
        arrays[0][:] = rows[:BUCKETS]
        rest, at = rows[BUCKETS:].ravel(), 0
        for x in arrays[1:]:
            x[:] = rest[at : at + x.size].reshape(x.shape)
            at += x.size

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights and memory as rows of DIM numbers."""
        return self._pack(self.params()), self._pack(self.memory)

    def moved(self, weights: np.ndarray, memory: np.ndarray) -> None:
        params = self.params()
        self._unpack(params, weights)
        self.net.bias = float(params[-1][0])
        self._unpack(self.memory, memory)

    def count(self, features: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> None:
        for d in range(len(offsets) - 1):
            self.holders[np.unique(features[np.unique(codes[offsets[d] : offsets[d + 1]])])] += 1

    def learn(
        self,
        features: np.ndarray,
        codes: np.ndarray,
        offsets: np.ndarray,
        toxic: np.ndarray,
        order: np.ndarray,
        rate: float,
        weight: np.ndarray | None = None,
        alive: np.ndarray | None = None,
    ) -> None:
        """One pass over the texts in ``order``, in batches."""
        net = self.net
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            own = np.concatenate([codes[offsets[d] : offsets[d + 1]] for d in docs])
            bounds = np.concatenate([[0], np.cumsum(offsets[docs + 1] - offsets[docs])])
            used, local = np.unique(own, return_inverse=True)
            best, arg, flat = net.pooled(features[used], local, bounds, where=True)
            act = np.maximum(best, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ net.dense + net.bias, -30, 30)))
            err = p - toxic[docs] if weight is None else (p - toxic[docs]) * weight[docs]
            err = (err / len(docs)).astype(np.float32)
            g_dense = act.T @ err + 1e-4 * net.dense
            g_best = np.where(best > 0, err[:, None] * net.dense, 0).astype(np.float32)
            g_convs = []
            g_words = np.zeros((len(used) + 1, DIM), np.float32)
            emb = np.concatenate([net.table[features[used]].sum(1), np.zeros((1, DIM), np.float32)])
            for i, conv in enumerate(net.convs):
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                grad, pos = g_best[:, part], arg[:, part]
                g_conv = np.empty_like(conv)
                for j in range(len(conv)):
                    at_word = flat[np.minimum(pos + j, len(flat) - 1)]
                    g_conv[j] = np.einsum("dfe,df->ef", emb[at_word], grad)
                    np.add.at(g_words, at_word.ravel(), (grad[:, :, None] * conv[j].T[None]).reshape(-1, DIM))
                g_convs.append(g_conv + 1e-4 * conv)
            hit = np.flatnonzero(np.abs(g_words[:-1]).sum(1))
            rows = features[used[hit]].ravel()
            g_rows = np.repeat(g_words[hit], features.shape[1], axis=0)
            if alive is not None:
                keep = alive[rows]
                rows, g_rows = rows[keep], g_rows[keep]
            touched, back = np.unique(rows, return_inverse=True)
            g_table = np.zeros((len(touched), DIM), np.float32)
            np.add.at(g_table, back, g_rows)
            self.memory[0][touched] += g_table**2
            net.table[touched] -= rate * g_table / np.sqrt(self.memory[0][touched])
            grads = [*g_convs, g_best.sum(0), g_dense]
            for param, mem, grad in zip([*net.convs, net.shift, net.dense], self.memory[1:-1], grads, strict=True):
                mem += grad**2
                param -= rate * grad / np.sqrt(mem)
            self.memory[-1] += float(err.sum()) ** 2
            net.bias -= rate * float(err.sum()) / math.sqrt(self.memory[-1][0])


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Learner:
    """Fit the classifier on a few texts that stand in memory."""
    learner, rng = Learner(TextCnn.fresh(seed)), np.random.default_rng(seed)
    offsets, codes, words = coded_words(pa.array(texts))
    features = word_features(words)
    learner.count(features, codes, offsets)
    alive = learner.holders >= LEAST_DOCS
    learner.net.table[~alive] = 0
    epochs = int(np.clip(STEPS * BATCH / max(1, len(texts)), *EPOCHS))
    for epoch in range(epochs):
        rate = RATE / (1 + 1.8 * epoch / epochs)
        learner.learn(features, codes, offsets, toxic, rng.permutation(len(texts)), rate, alive=alive)
    return learner


STATE = "model binary, memory binary, holders binary"


def _first_task(rows: list[tuple], toxic_share: float) -> Learner:
    """Train on the first rows: (text, toxic, order)."""
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    y = np.array([r[1] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        untaught = Learner(TextCnn.fresh())
        untaught.net.constant = float(toxic_share)
        return untaught
    learner = train([r[0] for r in rows], y)
    learner.net.balance = odds(toxic_share) - odds(float(y.mean()))
    return learner


def odds(p: float) -> float:
    return math.log(p / (1 - p))


def first_rows(rows: DataFrame, share: float) -> Learner | None:
    """The learner after the first rows, taught in one task; none without rows."""

    def run(batches):
        found = []
        for b in batches:
            found += zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "lot")))
        learner = _first_task(found, share)
        state = [learner.net.dumped(), learner.packed()[1].tobytes(), learner.holders.tobytes()]
        yield pa.RecordBatch.from_pydict({c.split()[0]: pa.array([x], pa.binary()) for c, x in zip(STATE.split(", "), state)})

    states = rows.select("text", "toxic", "lot").repartition(1).mapInArrow(run, STATE).collect()
    if not states:
        return None
    state = states[0]
    memory = np.frombuffer(state["memory"], np.float64).reshape(-1, DIM)
    return Learner(TextCnn.loaded(state["model"]), memory, np.frombuffer(state["holders"], np.int64))


def taught(learner: Learner, rows: DataFrame, share: float) -> Learner:
    """The learner after one round over ``rows``, which every task takes up from where ``learner`` stands.

    Each class weighs what it weighed among the first rows, so that the
    balance of the model holds. A task returns the rows of weights that it
    moved; their mean counts each task by the texts that hold the bucket (of
    other weights, by all its texts).
    """
    start_weights, start_memory = learner.packed()
    shared = rows.sparkSession.sparkContext.broadcast((learner.net, start_memory, learner.holders))
    first = 1 / (1 + math.exp(learner.net.balance - odds(share)))
    heavy = (np.float32((1 - first) / (1 - share)), np.float32(first / share))
    numbers = [f"w{i}" for i in range(DIM)] + [f"m{i}" for i in range(DIM)]

    def run(batches):
        net, memory, _ = shared.value
        own, rng, n = Learner(net, memory), np.random.default_rng(7), 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                toxic = piece.column("toxic").to_numpy().astype(np.float32)
                offsets, codes, words = coded_words(piece.column("text"))
                features = word_features(words)
                own.count(features, codes, offsets)
                own.learn(features, codes, offsets, toxic, rng.permutation(len(toxic)), RATE / 2.8, np.where(toxic > 0, heavy[1], heavy[0]))
                n += len(toxic)
        if n:
            weights, memory = own.packed()
            held = np.concatenate([own.holders, np.full(len(weights) - BUCKETS, n)])
            at = np.flatnonzero(held)
            both = np.concatenate([weights, memory], axis=1)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(held[at]), *(pa.array(c.astype(np.float32)) for c in both.T)], names=["slot", "n", *numbers]
            )

    found = rows.select("text", "toxic").mapInArrow(run, "slot int, n long, " + ", ".join(f"{c} float" for c in numbers))
    means = [(F.sum(F.col("n") * F.col(c).cast("double")) / F.sum("n")).alias(c) for c in numbers]
    mean = found.groupBy("slot").agg(F.sum("n").alias("texts"), *means).toArrow()  # a row for each row of weights at most
    shared.unpersist()
    slot, texts = mean["slot"].to_numpy(), mean["texts"].to_numpy()
    after = Learner(learner.net, start_memory, learner.holders)
    bucket = slot < BUCKETS
    after.holders[slot[bucket]] += texts[bucket]
    kept = ~bucket | (after.holders[np.minimum(slot, BUCKETS - 1)] >= LEAST_DOCS)
    both = np.stack([mean[c].to_numpy() for c in numbers], axis=1)
    start_weights[slot[kept]] = both[kept, :DIM]
    start_memory[slot[kept]] = both[kept, DIM:]
    after.moved(start_weights, start_memory)
    return after


def calibrate(net: TextCnn, rows: DataFrame) -> None:
    """For each language the threshold with the fewest errors on all held-back rows.

    The middle of the best interval on a grid is taken, kept within 0.1 to 0.9;
    a language without both classes keeps ``DEFAULT_THRESHOLD``.
    """
    cell = F.least(F.floor(F.col("score") * GRID), F.lit(GRID - 1)).cast("int")
    counted = (
        score(rows.select("text", "lang", "toxic"), net, lang=None)
        .groupBy("lang", cell.alias("cell"))
        .agg(F.sum("toxic").cast("long").alias("toxic"), F.count("*").alias("n"))
        .toArrow()  # GRID rows of a language at most
    )
    langs, where, toxic, n = (counted[c].to_numpy(zero_copy_only=False) for c in ("lang", "cell", "toxic", "n"))
    for lang in sorted(set(langs)):
        own = langs == lang
        bad, good = np.zeros(GRID + 1, np.int64), np.zeros(GRID + 1, np.int64)
        np.add.at(bad, where[own] + 1, toxic[own])
        np.add.at(good, where[own], n[own] - toxic[own])
        if not bad.any() or not good.any():
            continue
        # from a threshold of k / GRID: toxic texts in lower cells pass, clean ones in its cell and higher are rejected
        cost = np.cumsum(bad) + np.cumsum(good[::-1])[::-1]
        net.thresholds[lang] = float(np.clip(np.flatnonzero(cost == cost.min()).mean() / GRID, 0.1, 0.9))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: str = "true",
    toxic_rows: int = FIRST_TOXIC,
    clean_rows: int = FIRST_CLEAN,
) -> TextCnn:
    """Fit on all labelled rows, beginning with about ``toxic_rows`` + ``clean_rows`` of them.

    ``training`` is an SQL condition on ``doc_id`` that says which labels may
    teach. Hashes of the id say which rows calibrate and which round a row
    teaches in; every labelled text crosses the network once.
    """
    lot = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(HELD)) == 0
    turn = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(ROUNDS))
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(training)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1)")
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    untaught = TextCnn.fresh()
    untaught.constant = share
    if not counts.get(0) or not counts.get(1):
        return untaught
    rates = [min(1.0, clean_rows / counts[0]), min(1.0, toxic_rows / counts[1])]
    begins = lot < F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"), lot.alias("lot")).where(training)

    first = known.where(~held).where(begins)
    learner = first_rows(texts.join(F.broadcast(first), "doc_id"), share)  # bounded: the first rows' ids
    if learner is None or learner.net.constant is not None:
        return learner.net if learner else untaught  # no labelled document is here
    if min(rates) < 1:
        for i in range(ROUNDS):
            rows = texts.where(~held & (turn == i)).join(known.where(~held & (turn == i) & ~begins).hint("merge"), "doc_id")
            learner = taught(learner, rows.coalesce(math.ceil(total / ROUNDS / TASK_ROWS)), share)
    calibrate(learner.net, texts.where(held).join(known.where(held).hint("merge"), "doc_id"))
    return learner.net


def score(df: DataFrame, net: TextCnn, column: str = "text", lang: str | None = "lang") -> DataFrame:
    """Add ``score``, the language's ``threshold`` and ``toxic_flag`` (score at or over it)."""
    shared = df.sparkSession.sparkContext.broadcast(net.dumped())

    def setup():
        model = TextCnn.loaded(shared.value)
        return lambda piece: [pa.array(model.scores(piece.column(column)))]

    scored = map_pieces(df, column, [T.StructField("score", T.DoubleType(), False)], setup)
    limit = F.lit(DEFAULT_THRESHOLD)
    if lang and lang in df.columns:
        for name, value in sorted(net.thresholds.items()):
            limit = F.when(quoted(lang) == name, value).otherwise(limit)
    return scored.withColumn("threshold", limit).withColumn("toxic_flag", F.col("score") >= F.col("threshold"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered result: every document scored, labels learned outside the held-out quarter."""
    net = fit(docs, labels, training="crc32(cast(cast(doc_id as string) as binary)) % 4 != 2")
    scored = score(docs.select("doc_id", "text", "lang"), net)
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        "threshold",
        "toxic_flag",
    )
