"""CSV extracts: glob scan, missing-source check, missing-token parsing.

Every column is read as text; the table contract decides types (V1). That
keeps diagnosis codes such as ``4019`` as ``4019`` even when a column has
blanks (a type-inferring reader would turn them into ``4019.0``).
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from csv import reader as text_rows

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# -- fixed values: cell texts that mean "missing" (pandas' default NA tokens) --
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

SOURCE_FILE_COL = "_source_file"
#: A row's place in its source, taken at the scan: file, split of the file, row.
POSITION_COLS = (SOURCE_FILE_COL, "_block_start", "_row")
#: The text of a row with more cells than its file's header, else null.
MALFORMED_COL = "_malformed"


def least_split(spark: SparkSession) -> int:
    """Bytes up to which Spark never divides a file."""
    jvm = spark.sparkContext._jvm
    byte = lambda key: jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    return min(byte("spark.sql.files.maxPartitionBytes"), byte("spark.sql.files.openCostInBytes"))


def matching_files(spark: SparkSession, glob: str) -> dict[str, int]:
    """Files that match ``glob`` and their bytes; a folder stands for the files in it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(glob)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for s in fs.globStatus(path) or []:
        inner = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        out |= {str(x.getPath()): x.getLen() for x in inner if x.isFile() and x.getPath().getName()[0] not in "._"}
    return out


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of a file (all that is read of it here)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()
    return tuple(next(text_rows([line.removeprefix("\ufeff")]), []))


#: Quoted cells as in RFC 4180: doubled quotes, line ends inside, which stay as they are.
CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED_COL,
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "lineSep": "\n",
}


# -- records of files that are read in splits ----------------------------------
#
# A line end inside a quoted cell does not end a record, and whether a split
# begins inside one depends on all splits before it. A line maps the state it
# begins in (outside or inside a quoted cell) to the one it ends in; a split is
# such a map too. One pass takes the splits' maps, which compose along each file
# to every split's first state; the next joins the lines of each record.


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside (or outside) a quoted cell ends inside one.

    A quote opens a cell only as its first character; a doubled one inside stands
    for itself; what follows the closing one belongs to the cell up to the comma.
    """
    at = 0
    while True:
        if inside:
            quote = line.find('"', at)
            while quote >= 0 and line[quote + 1 : quote + 2] == '"':
                quote = line.find('"', quote + 2)
            if quote < 0:
                return True
            inside = False
        else:
            quote = line.find('"', at)
            if quote < 0:
                return False
            if quote == 0 or line[quote - 1] == ",":
                inside, at = True, quote + 1
                continue
        at = line.find(",", quote) + 1
        if at == 0:
            return False


def split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """(file, block) and lines of each stretch of lines of one split, in order."""
    for b in batches:
        files = b.column("file").dictionary_encode()
        code, block = files.indices.to_numpy(), b.column("block").to_numpy()
        first = np.flatnonzero(np.append(True, (np.diff(code) != 0) | (np.diff(block) != 0))[: len(code)])
        for i, j in zip(first, np.append(first[1:], len(code)), strict=True):
            yield (files.dictionary[int(code[i])].as_py(), int(block[i])), b.column("value").slice(i, j - i)


def line_states(lines: pa.Array, inside: bool) -> np.ndarray:
    """Whether each line ends inside a quoted cell; only lines that hold a quote are looked at."""
    states = np.empty(len(lines), bool)
    done = 0
    for k in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)):
        states[done:k] = inside
        states[k] = inside = ends_inside(lines[int(k)].as_py(), inside)
        done = k + 1
    states[done:] = inside
    return states


def splits_inside(lines: DataFrame) -> list[tuple[str, int | None]]:
    """Splits that begin inside a quoted cell, as (file, block); (file, None) for a file that ends inside one.

    One row per split is shuffled, and one per split found is collected: at most
    as many as the scan has tasks to plan.
    """

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], list[bool]] = {}
        for key, lines in split_runs(batches):
            now = ends.get(key, [False, True])
            ends[key] = [bool(line_states(lines, s)[-1]) for s in now] if now[0] != now[1] else [bool(line_states(lines, now[0])[-1])] * 2
        rows = [{"file": f, "block": b, "outside": x, "inside": y} for (f, b), (x, y) in ends.items()]
        yield pa.RecordBatch.from_pylist(rows, schema)

    def fold(table: pa.Table) -> pa.Table:
        found, inside = [], False
        rows = table.sort_by("block").to_pylist()
        for r in rows:
            if inside:
                found.append({"file": r["file"], "block": r["block"]})
            inside = r["inside"] if inside else r["outside"]
        return pa.Table.from_pylist(found + [{"file": rows[0]["file"], "block": None}] * inside, pa.schema(list(schema)[:2]))

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())])
    states = lines.mapInArrow(maps, "file string, block long, outside boolean, inside boolean")
    return [tuple(r) for r in states.groupBy("file").applyInArrow(fold, "file string, block long").collect()]


WHOLE, TAIL, HEAD, THROUGH = range(4)  # what a piece of a split is of a record


def split_records(lines: DataFrame, columns: tuple[str, ...], begin_inside: set, in_splits: bool) -> DataFrame:
    """``file, block, row, kind, record``: the records of each split, and its pieces of those that cross its ends.

    The first record of a file must be the header ``columns`` and is left out,
    as are empty lines. Unless files come ``in_splits``, what is open at the end
    of one is its last record.
    """
    kinds = [("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("kind", pa.int32()), ("record", pa.string())]

    def rows(key: tuple[str, int], at: int, kind: int, records: pa.Array) -> Iterator[pa.RecordBatch]:
        if kind in (WHOLE, HEAD):  # these end where a record ends
            records = pc.utf8_rtrim(records, "\r")
        place = np.arange(at, at + len(records))
        if key[1] == 0 and at == 0 and kind == WHOLE and len(records):
            own = tuple(next(text_rows([(records[0].as_py() or "").removeprefix("\ufeff")]), []))
            if own != columns:
                raise ValueError(f"{key[0]}: header {own} is not {columns}")
            records, place = records.slice(1), place[1:]
        if kind == WHOLE:
            full = pc.not_equal(records, "")
            records, place = records.filter(full), place[full.to_numpy(zero_copy_only=False)]
        cells = [pa.array([key[0]] * len(records), pa.string()), pa.array([key[1]] * len(records), pa.int64())]
        yield pa.RecordBatch.from_arrays([*cells, pa.array(place), pa.array([kind] * len(records), pa.int32()), records], schema=pa.schema(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, came_inside, at, carry = None, False, False, 0, []

        def rest() -> Iterator[pa.RecordBatch]:
            if carry:
                kind = WHOLE if not in_splits else THROUGH if came_inside else TAIL
                yield from rows(key, at, kind, pa.array(["\n".join(carry)]))

        for now, lines in split_runs(batches):
            if now != key:
                yield from rest()
                key, at, carry = now, 0, []
                inside = came_inside = now in begin_inside
            states = line_states(lines, inside)
            inside = bool(states[-1])
            ends = np.flatnonzero(~states) + 1 + len(carry)
            lines = pa.concat_arrays([pa.array(carry, pa.string()), lines.cast(pa.string())])
            last = int(ends[-1]) if len(ends) else 0
            carry = lines.slice(last).to_pylist()
            if not last:
                continue
            records = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), lines.slice(0, last)), "\n")
            if came_inside:
                yield from rows(key, at, HEAD, records.slice(0, 1))
                records, at, came_inside = records.slice(1), at + 1, False
            yield from rows(key, at, WHOLE, records)
            at += len(records)
        yield from rest()

    return lines.mapInArrow(run, "file string, block long, row long, kind int, record string")


def stitched(pieces: DataFrame) -> DataFrame:
    """The records that cross the ends of splits, each at the place where it begins."""

    def join(table: pa.Table) -> pa.Table:
        out, held = [], []
        for r in table.sort_by([("block", "ascending"), ("row", "ascending")]).to_pylist():
            held.append(r)
            if r["kind"] == HEAD:
                out.append({**held[0], "record": "\n".join(x["record"] for x in held)})
                held = []
        if held:  # a cell that is never closed
            out.append({**held[0], "record": "\n".join(x["record"] for x in held)})
        return pa.Table.from_pylist(out, table.schema)

    return pieces.groupBy("file").applyInArrow(join, pieces.schema)


def csv_rows(lines: DataFrame, columns: tuple[str, ...], in_splits: bool) -> DataFrame:
    """The rows of CSV files under ``columns`` from their lines (``value, file, block``), with their places.

    Files that may come ``in_splits`` are scanned for the splits' first states
    before; those in which a split begins inside a quoted cell once more, for the
    records that cross splits.
    """
    found = splits_inside(lines) if in_splits else []
    records = split_records(lines, columns, set(found), in_splits)
    whole = records.where(F.col("kind") == WHOLE)
    if found:
        some = sorted({f for f, _ in found})
        own = lines.where(F.col("file").isin(some)) if len(some) <= 1000 else lines
        crossing = split_records(own, columns, set(found), in_splits).where(F.col("kind") != WHOLE)
        whole = whole.unionByName(stitched(crossing))
    ddl = ", ".join(f"{quote(c)} string" for c in (*columns, MALFORMED_COL))
    parsed = whole.select(F.from_csv("record", ddl, CSV_OPTIONS).alias("cells"), "file", "block", "row")
    places = [F.col(c).alias(n) for c, n in zip(("file", "block", "row"), POSITION_COLS, strict=True)]
    return parsed.select("cells.*", *places).withColumn(
        MALFORMED_COL, F.when(too_long(MALFORMED_COL, len(columns)), F.col(MALFORMED_COL))
    )


def text_lines(reader, paths) -> DataFrame:
    """Lines of text files (a batch or stream reader's), with the file and the split each is of."""
    df = reader.option("lineSep", "\n").format("text").load(paths)
    return df.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def too_long(record: str, cells: int):
    """Whether a record has more than ``cells`` cells; a shorter one has nulls at its end, as text readers do."""
    bare = F.regexp_replace(record, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= cells


def read_source(
    spark: SparkSession,
    glob: str,
    *,
    renames: dict[str, str] | None = None,
    na_tokens: tuple[str, ...] = NA_TOKENS,
) -> DataFrame:
    """Scan every file matching ``glob`` by its own header row.

    Files with the same header are one scan (Spark lists and splits them); scans
    of different headers are united by column name, and a column that some files
    lack is null for them. Cells may hold quotes and line ends; large files are
    split between tasks all the same. Rows with more cells than the header keep
    their text in ``_malformed``, to be rejected. Missing tokens become null;
    ``renames`` maps source spellings to canonical names. Lines end in ``\\n`` or
    ``\\r\\n``. A file too small to be split is read once, others are read before
    for their splits' first states alone.
    """
    sizes = matching_files(spark, glob)
    files = sorted(sizes)
    if not files:
        raise FileNotFoundError(f"No source files match {glob!r}")
    whole_below = least_split(spark)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: header(spark, f), files))
    groups: dict[tuple, list[str]] = {}
    for path, columns in zip(files, headers, strict=True):
        groups.setdefault((columns, sizes[path] > whole_below), []).append(path)
    out: DataFrame | None = None
    for (columns, in_splits), paths in groups.items():
        df = csv_rows(text_lines(spark.read, paths), columns, in_splits)
        for old, new in (renames or {}).items():
            if old in df.columns:
                df = df.withColumnRenamed(old, new)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return na_token_recode(out, tokens=na_tokens)


def na_token_recode(
    df: DataFrame,
    columns: list[str] | None = None,
    tokens: tuple[str, ...] = NA_TOKENS,
) -> DataFrame:
    """Whole string cells equal to a missing token become null (S3).

    ``CASE WHEN c IN (tokens) THEN NULL ELSE c END``: the token list becomes a
    hash-set lookup and the cell is referenced twice, so the recode stays one
    cheap projection however many tokens there are. (``na.replace`` expands
    to one branch per token, each re-evaluating the cell's expression.)
    """
    strings = set(string_columns(df))
    targets = {
        c for c in (columns if columns is not None else strings) if c in strings and c not in (SOURCE_FILE_COL, MALFORMED_COL)
    }
    if not targets:
        return df
    token_sql = ", ".join(sql_string(t) for t in tokens)
    return df.selectExpr(
        *[
            f"CASE WHEN {quote(c)} IN ({token_sql}) THEN NULL ELSE {quote(c)} END AS {quote(c)}"
            if c in targets
            else quote(c)
            for c in df.columns
        ]
    )


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
