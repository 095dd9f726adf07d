"""BPE encoding and decoding by a pair occurrence index (operator 1).

Texts are split into words as the vocabulary file prescribes; the distinct
words of a partition's block are laid out in one symbol array. An index maps
each adjacent pair that has a merge rank to all of its positions in the block.
Active ranks leave a heap in ascending order: all positions of the pair merge
at once and only the lists of the neighbouring pairs are updated. A word's
merges do not depend on other words, so this equals merging each word by its
lowest rank, and every merge costs one vector step for the whole block.

Cases: null and empty texts have no ids and decode to the empty text; repeated
rows and equal texts get equal results; an empty table gives an empty table;
a column named like an output column is replaced; a very long text is worked on whole, by itself.
Invalid lone surrogates
cannot occur in Spark strings.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import coded_words, map_pieces

CACHED_CHUNKS = 150_000  # distinct chunks a task keeps encoded; beyond it they are encoded again
BLOCK_BYTES = 3 << 20  # text that is merged together


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = count(256)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A word-level BPE vocabulary: JSON with word-end suffix, lower-casing, no decoder."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**vocab, **self.special}.items()}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + end] for c in letters], np.int32)
        self.size = max(self.tokens) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.words = regex.compile(
            spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        )
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def pretokens(self, text: str) -> list[str]:
        """The words of a text, normalised; special tokens stand as they are."""
        if text.isascii() and text.isalpha():
            return [text.lower()]
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        out: list[str] = []
        for part in self.marks.split(text):
            out += [part] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # lower-casing is by code point: the word-final sigma rule does not apply
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each word has."""
        special = {i: self.special[w] for i, w in enumerate(words) if w in self.special}
        raw = [b"" if i in special else w.encode() for i, w in enumerate(words)]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids, sizes = self._merge(data, size)
        if special:
            starts = np.concatenate([[0], np.cumsum(sizes)])
            at = np.fromiter(special, np.int64, len(special))
            ids = np.insert(ids, starts[at], list(special.values()))
            sizes[at] = 1
        return ids, sizes

    def _merge(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        lasts = (np.cumsum(size) - 1)[size > 0]
        sym = self.inner[data]
        sym[lasts] = self.final[data[lasts]]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[lasts] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[np.concatenate([[0], lasts[:-1] + 1])] = -1
        index: dict[int, list[np.ndarray]] = defaultdict(list)
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Index the pairs that begin at these positions."""
            rank = self.ranks(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, own in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if r not in index:
                    heapq.heappush(active, r)
                index[r].append(own)

        enter(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = np.sort(np.concatenate(lists))
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            left, right, new = self.left[r], self.right[r], self.made[r]
            at = at[(sym[at] == left) & (after[at] >= 0)]
            at = at[sym[after[at]] == right]
            if left == right and len(at) > 1:
                at = self._apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            sym[at] = new
            sym[gone] = -1
            then = after[gone]
            after[at] = then
            inside = then >= 0
            before[then[inside]] = at[inside]
            prior = before[at]
            enter(np.concatenate([at[inside], prior[prior >= 0]]))
        alive = sym >= 0
        sums = np.concatenate([[0], np.cumsum(alive)])
        bounds = np.concatenate([[0], np.cumsum(size)])
        return sym[alive], sums[bounds[1:]] - sums[bounds[:-1]]

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of overlapping positions of a pair of equal symbols, every other one from the left."""
        out, blocked = [], -1
        for p, q in zip(at.tolist(), after[at].tolist()):
            if p != blocked:
                out.append(p)
                blocked = q
        return np.array(out, np.int64)


class BlockEncoder:
    """Encodes the texts of one task block by block.

    Pre-tokens never cross white space, so a text's ids are those of its
    white-space-delimited chunks; the task keeps the ids of the distinct
    chunks it has met, and only new ones are split and merged.
    """

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode the chunks, distinct and not met before."""
        number: dict[str, int] = defaultdict(count().__next__)
        code, flat, sizes = number.__getitem__, [], []
        for words in map(self.bpe.pretokens, chunks):
            flat.extend(map(code, words))
            sizes.append(len(words))
        per_chunk = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ids, sizes = self.bpe.encode_words(list(number))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        spread, ends = ranges(starts, np.array(flat, np.int64))
        self.codes.update(zip(chunks, range(len(self.codes), len(self.codes) + len(chunks))))
        self.ids = np.concatenate([self.ids, ids[spread].astype(np.uint32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends[per_chunk[1:]]])

    def encode(self, block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of each text."""
        offsets, local, distinct = coded_words(block, lower=False)
        chunks = distinct.to_pylist()
        if len(self.codes) > CACHED_CHUNKS:
            self._clear()
        new = [c for c in chunks if c not in self.codes]
        if new:
            self._learn(new)
        code = np.fromiter(map(self.codes.__getitem__, chunks), np.int64, len(chunks))
        spread, ends = ranges(self.starts, code[local])
        ids, ends = self.ids[spread], ends[offsets]
        pa.default_memory_pool().release_unused()
        return ids, ends


def ranges(starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ranges ``starts[c]:starts[c + 1]`` of all codes, and where each ends."""
    begin = starts[codes]
    size = starts[codes + 1] - begin
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(begin - ends[:-1], size) + np.arange(ends[-1]), ends


def _vocabulary(df: DataFrame, path: str) -> str:
    """Ship the vocabulary file to every executor; its name there."""
    df.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def _opened(name: str) -> WordBpe:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return WordBpe(f.read())


def _ids_column(ids: np.ndarray, ends: np.ndarray, packed: bool) -> pa.Array:
    if packed:
        data = pa.py_buffer(ids.astype("<u4").tobytes())
        offsets = pa.py_buffer((ends * 4).astype(np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, data])
    kind = pa.list_(pa.field("element", pa.int32(), False))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)), type=kind)


def _text(bpe: WordBpe, ids) -> str:
    """The tokens with one space between them; an id outside the vocabulary is left out."""
    return " ".join([t for t in map(bpe.tokens.get, ids) if t is not None])


def encode(
    df: DataFrame,
    vocabulary: str,
    column: str = "text",
    out: str = "ids",
    packed: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """Add the token ids of ``column`` as ``out``.

    ``vocabulary`` is the path of a tokenizer JSON file on the driver. The ids
    are an array of int, or with ``packed`` one binary value of little-endian
    unsigned 32-bit integers, which takes a third of the memory of an array.
    With ``decoded`` a column of that name has what the ids decode to, made in
    the same pass.
    """
    name = _vocabulary(df, vocabulary)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    added = [T.StructField(out, kind, False)]
    if decoded:
        added.append(T.StructField(decoded, T.StringType(), False))

    def setup():
        bpe = _opened(name)
        coder = BlockEncoder(bpe)

        def each(piece: pa.RecordBatch) -> list:
            ids, ends = coder.encode(piece.column(column))
            made = [_ids_column(ids, ends, packed)]
            if decoded:
                cuts = ends.tolist()
                made.append([_text(bpe, ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])])
            return made

        return each

    return map_pieces(df, column, added, setup, BLOCK_BYTES)


def decode(df: DataFrame, vocabulary: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of the ids in ``column`` (array of int, or packed) as ``out``.

    The vocabulary has no decoder of its own: the tokens stand as in the file,
    special ones included, with one space between them. Null ids decode to the
    empty text; an id outside the vocabulary is left out, as the file's own
    library does.
    """
    name = _vocabulary(df, vocabulary)
    packed = isinstance(df.schema[column].dataType, T.BinaryType)
    measure = column
    if not packed:  # pieces are cut by bytes of a binary or text column
        measure = "__ids_bytes"
        df = df.withColumn(measure, F.coalesce(F.repeat(F.lit("....."), F.size(column)), F.lit("")))

    def setup():
        bpe = _opened(name)

        def each(piece: pa.RecordBatch) -> list:
            rows = piece.column(column).to_pylist()
            if packed:
                rows = [None if r is None else np.frombuffer(r, "<u4").tolist() for r in rows]
            return [[_text(bpe, r or ()) for r in rows]]

        return each

    done = map_pieces(df, measure, [T.StructField(out, T.StringType(), False)], setup)
    return done if packed else done.drop(measure)


def encoded_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The registered result: digests of each text's ids and of their decoded text."""
    coded = encode(docs.select("doc_id", "text"), vocabulary, packed=True, decoded="decoded")
    return coded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
