"""Secret scans with multipart credential linking (operator 5).

A scan of each whole text yields strong spans (an assignment to a secret's
name, an access identifier, a long hexadecimal run) and weak parts: short
identifiers (named ones and e-mail addresses), key-like strings and endpoints
(urls, named hosts and IPv4 addresses). Weak parts alone are noise. An
interval join in Spark links parts of one text whose scopes (``SCOPE`` code
points on either side) meet, and a weak part is reported only if a
complementary part, a key beside an identifier or an endpoint, is in its scope.

Texts are scanned once, and the spans written. Parts are keyed by the text's
hash, so copies of a text are joined once; a text's parts spread over (text,
bin) keys; the join is a semi join and emits no pairs. Only rows whose text has
weak parts meet the result in a join, copies of one text spread by a salt.

Cases: null and empty texts have no spans; repeated rows get equal results;
rows with a null id are kept; an empty table gives an empty table; columns
named like output columns are replaced; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import map_pieces, quoted, texts, written

SCOPE = 200  # code points on either side of a part
SALTS = 16  # tasks over which the copies of one text are spread when they take their links

# The strong kinds' patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

# Weak parts, by class.
WEAK_ID = re.compile(
    r"""\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
WEAK_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+", re.ASCII)
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
WEAK_ENDPOINT = re.compile(
    r"""\b(?:[a-z][a-z0-9+.-]{1,9}://[^\s"'<>]+|(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d+)?)""",
    re.ASCII,
)
WEAK_ADDRESS = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])(?::[0-9]+)?")
KINDS = ("assign", "access", "hex", "weak_id", "weak_key", "weak_endpoint")
CLASS = {"assign": "key", "access": "id", "hex": "key", "weak_id": "id", "weak_key": "key", "weak_endpoint": "endpoint"}

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
SPANS = T.ArrayType(SPAN)


def key_like(token: str) -> bool:
    """Mixed characters of high entropy, as keys have and words have not."""
    kinds = sum(bool(re.search(p, token)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    n = len(token)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(token).values())
    return entropy >= 3.0 and (kinds == 3 or (kinds == 2 and bool(re.search("[0-9]", token)) and entropy >= 3.3))


def address(found: str) -> bool:
    """Whether four numbers can be an IPv4 address."""
    return all(int(n) < 256 for n in found.split(":")[0].split("."))


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong kinds, each leftmost and non-overlapping."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def weak_parts(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts that no strong span touches; none where the text has no key at all."""
    keys = [(m.start(), 4, m.end()) for m in WEAK_KEY.finditer(text) if key_like(m[0])]
    if not keys and not any(CLASS[KINDS[k]] == "key" for _, k, _ in strong):
        return []
    found = keys + [(m.start(), 3, m.end()) for m in WEAK_ID.finditer(text)]
    if "@" in text:
        found += [(m.start(), 3, m.end()) for m in WEAK_MAIL.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in WEAK_ENDPOINT.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in WEAK_ADDRESS.finditer(text) if address(m[0])]
    taken, out, at = sorted((s, e) for s, _, e in strong), [], 0
    for s, k, e in sorted(found):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at == len(taken) or e <= taken[at][0]:
            out.append((s, k, e))
    return out


def _listed(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"start": s, "ord": k, "end": e} for s, k, e in spans]


def scan(df: DataFrame, column: str = "text") -> DataFrame:
    """Add ``strong`` and ``weak``: the spans of each text before linking."""

    def setup():
        def each(piece: pa.RecordBatch) -> list:
            strong, weak = [], []
            for text in texts(piece, column):
                own = strong_spans(text)
                strong.append(_listed(own))
                weak.append(_listed(weak_parts(text, own)))
            return [strong, weak]

        return each

    return map_pieces(df, column, [T.StructField("strong", SPANS), T.StructField("weak", SPANS)], setup)


def _class(ord_column: str):
    kinds = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(i), F.lit(CLASS[k]))])
    return kinds[F.col(ord_column)]


def linked_parts(scanned: DataFrame) -> DataFrame:
    """The weak parts with a complementary part in scope: one row for each text hash.

    ``scanned`` has ``text_key``, ``strong`` and ``weak``. Intervals meet where
    they share a bin of ``SCOPE`` code points or lie in neighbouring ones; the end
    itself counts, so that a gap of exactly ``SCOPE`` reaches the neighbour at any place.
    """
    some = scanned.where(F.size("weak") > 0)
    parts = (
        some.select("text_key", F.explode(F.concat("strong", "weak")).alias("p"))
        .select("text_key", "p.*")
        .distinct()
        .withColumn("part", _class("ord"))
    )
    bins = lambda reach: F.explode(
        F.sequence(
            F.expr(f"cast(start div {SCOPE} as int)") - reach,
            F.expr(f"cast(end div {SCOPE} as int)") + reach,
        )
    )
    weak = parts.where("ord >= 3").withColumn("bin", bins(1)).alias("w")
    other = parts.withColumn("bin", bins(0)).alias("o")
    near = (
        (F.col("w.text_key") == F.col("o.text_key"))
        & (F.col("w.bin") == F.col("o.bin"))
        & (F.col("w.part") != F.col("o.part"))
        & ((F.col("w.part") == "key") | (F.col("o.part") == "key"))
        & (F.greatest(F.col("w.start") - F.col("o.end"), F.col("o.start") - F.col("w.end")) <= SCOPE)
    )
    found = weak.join(other, near, "left_semi").select("text_key", "start", "ord", "end").distinct()
    return found.groupBy("text_key").agg(F.collect_list(F.struct("start", "ord", "end")).alias("linked"))


def with_links(scanned: DataFrame) -> DataFrame:
    """Add ``linked`` to a written scan (``text_key``, ``strong``, ``weak`` and other columns)."""
    found = linked_parts(scanned.select("text_key", "strong", "weak"))
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    some = scanned.where(F.size("weak") > 0).withColumn("salt", F.spark_partition_id() % SALTS)
    empty = F.array().cast(SPANS)
    some = some.join(found, ["text_key", "salt"], "left").withColumn("linked", F.coalesce("linked", empty))
    none = scanned.where(F.size("weak") == 0).withColumn("linked", empty)
    return none.unionByName(some.drop("salt"))


def packed_scan(df: DataFrame, column: str, keep_text: bool) -> DataFrame:
    """The scan of ``df``, written: its other columns in the struct ``row`` by place."""
    others = [c for c in df.columns if c != column]
    row = F.struct(F.lit(0).alias("n"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(others)])
    rows = df.select(row.alias("row"), quoted(column).alias("text"))
    rows = rows.withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    scanned = scan(rows, "text")
    return written(scanned if keep_text else scanned.drop("text"), "secret-spans")


def find_secrets(df: DataFrame, column: str = "text") -> DataFrame:
    """Replace the text by ``strong``, ``linked`` and ``spans`` (both, by start, then kind)."""
    others = [c for c in df.columns if c != column]
    rows = with_links(packed_scan(df, column, False))
    added = ("strong", "linked", "spans")
    rows = rows.withColumn("spans", F.array_sort(F.concat("strong", "linked")))
    kept = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(others) if c.lower() not in added]
    return rows.select(*kept, *added)


def spelled(column: str):
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            F.col(column),
            lambda p: F.concat_ws(":", F.element_at(names, p["ord"] + 1), p["start"].cast("string"), p["end"].cast("string")),
        ),
    )


def redact(df: DataFrame, column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The texts with every reported span replaced by ``mark``; other columns pass through.

    Overlapping spans are replaced together. A null text stays null.
    """
    others = [c for c in df.columns if c != column]
    joined = with_links(packed_scan(df, column, True))

    def setup():
        def each(piece: pa.RecordBatch) -> list:
            out = []
            spans = zip(piece.column("strong").to_pylist(), piece.column("linked").to_pylist())
            for text, (strong, linked) in zip(piece.column("text").to_pylist(), spans):
                out.append(text and replaced(text, [(p["start"], p["end"]) for p in strong + linked], mark))
            return [out]

        return each

    done = map_pieces(joined, "text", [joined.schema["text"]], setup)
    place = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(others)}
    return done.select(*[place[c] if c in place else F.col("text").alias(c) for c in df.columns])


def replaced(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def secret_report(docs: DataFrame) -> DataFrame:
    """The registered result: span counts, digest of the strong spans, all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("strong", lambda p: p["ord"] == KINDS.index(k))).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spelled("strong"), 256).alias("base_sha256"),
        spelled("spans").alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
