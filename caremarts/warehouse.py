"""Tables as manifests over immutable parts.

Layout under the warehouse root (any Hadoop-compatible URI)::

    raw/<table>/parts/<id>/[bucket=<b>/]part-*.parquet     data, never rewritten
    raw/<table>/commits/000000000003.json                  manifest: parts and schema
    marts/<table>/...   snapshots/<table>/...
    rejected/<table>/batch=<id>/part-*.parquet
    staging/<run>/<table>/...                              steps of a running job

A write makes a new part directory that no reader knows, then commits a
manifest listing the parts that make up the table: all new ones (publish), the
old ones and the new (append), or the old ones but for those that were
rewritten (rewrite). Each part keeps the columns that it still gives, with the
types that lie in its files: a column that the table dropped leaves them for
good, and one whose type changed is cast as it is read (K10). A commit renames a finished temporary file to the next
number with a rename that fails if that number exists, so a crash at any point
leaves the last committed table whole, and of two writers that start from the
same version one fails with ``ConcurrentCommit`` and loses nothing. The newest
committed manifest is the table; there is no pointer.

The rename is atomic on HDFS and local file systems; on object stores put a
table format (Delta, Iceberg) behind ``_commit``.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("raw", "marts", "snapshots", "rejected", "staging")
SLOT = "bucket"
WHOLE = ""  # the slot of parts that are not divided
ORPHAN_HOURS = 24  # parts that no manifest lists are kept this long: a writer may be at work


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version this one was about to commit."""


class DuplicateKeyError(ValueError):
    """A table would hold a key more than once."""


class SchemaChangeError(ValueError):
    """A column's new type cannot hold a value that the table has."""


@dataclass
class Manifest:
    version: int
    schema: T.StructType
    #: of each: path (relative), slot, bytes, columns (live ones, as in its files)
    parts: list[dict] = field(default_factory=list)
    #: what writers keep with a table from version to version: ``slots``, ``built_from``, ``epochs``
    notes: dict = field(default_factory=dict)

    @property
    def bytes(self) -> int:
        return sum(p["bytes"] for p in self.parts)

    def within(self, slots=None) -> list[dict]:
        return [p for p in self.parts if slots is None or p["slot"] in slots]


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types in one order; whether a column may be null is not compared."""
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def holds_all(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new."""
    whole = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
    if old == new or isinstance(new, T.StringType) and isinstance(old, T.AtomicType):
        return True
    if old in whole and new in whole:
        return whole[old] <= whole[new]
    if isinstance(new, T.DecimalType):
        digits = whole.get(old) if old in whole else old.precision - old.scale if isinstance(old, T.DecimalType) else None
        return digits is not None and digits <= new.precision - new.scale and getattr(old, "scale", 0) <= new.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def under_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` from ``df``: cast where the type differs, null where there is none."""
    if same_columns(df.schema, schema):
        return df
    own = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (column(f.name) if own.get(f.name) == f.dataType else column(f.name).cast(f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    # -- file system ------------------------------------------------------------
    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p, jvm

    def _list(self, path: str) -> list:
        fs, p, _ = self._hadoop(path)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def _bytes(self, path: str) -> int:
        fs, p, _ = self._hadoop(path)
        return int(fs.getContentSummary(p).getLength())

    def _read_text(self, path: str) -> str:
        fs, p, jvm = self._hadoop(path)
        stream = fs.open(p)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _delete(self, path: str) -> None:
        fs, p, _ = self._hadoop(path)
        fs.delete(p, True)

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    # -- manifests ----------------------------------------------------------------
    def versions(self, layer: str, table: str) -> list[int]:
        names = [s.getPath().getName() for s in self._list(f"{self.path(layer, table)}/commits")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, layer: str, table: str, version: int | None = None) -> Manifest | None:
        known = self.versions(layer, table)
        if not known:
            return None
        v = known[-1] if version is None else version
        spec = json.loads(self._read_text(f"{self.path(layer, table)}/commits/{v:012d}.json"))
        columns = [T.StructType.fromJson(c) for c in spec["columns"]]
        parts = [{**p, "columns": columns[p["columns"]]} for p in spec["parts"]]
        return Manifest(v, T.StructType.fromJson(spec["schema"]), parts, spec["notes"])

    def current_version(self, layer: str, table: str) -> int | None:
        known = self.versions(layer, table)
        return known[-1] if known else None

    def _commit(
        self, layer: str, table: str, base: Manifest | None, schema: T.StructType, parts: list[dict], notes: dict | None = None
    ) -> int:
        """Make ``parts`` the next version after ``base``; fails if that exists already.

        ``notes`` replace those of the same names; the others go on from ``base``.
        """
        version = (base.version if base else 0) + 1
        names, columns, listed = set(schema.fieldNames()), {}, []
        for p in parts:
            live = T.StructType([f for f in p["columns"] if f.name in names])
            listed.append({**p, "columns": columns.setdefault(live.json(), len(columns))})
        spec = {
            "schema": schema.jsonValue(),
            "columns": [json.loads(c) for c in columns],
            "parts": listed,
            "notes": {**(base.notes if base else {}), **(notes or {})},
        }
        folder = f"{self.path(layer, table)}/commits"
        fs, tmp, jvm = self._hadoop(f"{folder}/.{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(spec).encode()))
        finally:
            out.close()
        hadoop = jvm.org.apache.hadoop
        context = hadoop.fs.FileContext.getFileContext(tmp.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
        options[0] = getattr(hadoop.fs.Options.Rename, "NONE")
        try:
            context.rename(tmp, hadoop.fs.Path(f"{folder}/{version:012d}.json"), options)
        except Py4JJavaError as exc:
            fs.delete(tmp, False)
            if "FileAlreadyExists" in str(exc.java_exception.getClass().getName()):
                raise ConcurrentCommit(f"{layer}/{table} version {version} was committed by another writer") from exc
            raise
        return version

    def _write_part(self, layer: str, table: str, df: DataFrame, slot: Column | None) -> list[dict]:
        """Write rows as a new part (a directory for each slot); entries of what holds rows."""
        name = f"parts/{uuid.uuid4().hex}"
        path = f"{self.path(layer, table)}/{name}"
        if slot is None:
            df.write.parquet(path)
            has_rows = not self.spark.read.schema(df.schema).parquet(path).isEmpty()
            if has_rows:
                return [{"path": name, "slot": WHOLE, "bytes": self._bytes(path), "columns": df.schema}]
        else:
            # rows of a slot lie together where they are few; AQE splits a large slot between tasks
            marked = df.withColumn(SLOT, slot.cast("string")).hint("rebalance", F.col(SLOT))
            marked.write.partitionBy(SLOT).parquet(path)
            found = [s.getPath().getName() for s in self._list(path) if s.isDirectory()]
            slots = sorted(n.split("=", 1)[1] for n in found if n.startswith(f"{SLOT}="))
            if slots:
                sizes = {s: self._bytes(f"{path}/{SLOT}={s}") for s in slots}
                return [{"path": f"{name}/{SLOT}={s}", "slot": s, "bytes": sizes[s], "columns": df.schema} for s in slots]
        self._delete(path)
        return []

    def _frame(self, layer: str, table: str, schema: T.StructType, parts: list[dict]) -> DataFrame:
        """The rows of parts under a schema: one scan of those that have the same columns."""
        alike: dict[str, list[dict]] = {}
        for p in parts:
            alike.setdefault(p["columns"].json(), []).append(p)
        out: DataFrame | None = None
        for own in alike.values():
            paths = [f"{self.path(layer, table)}/{p['path']}" for p in own]
            df = under_schema(self.spark.read.schema(own[0]["columns"]).parquet(*paths), schema)
            out = df if out is None else out.union(df)
        return self.spark.createDataFrame([], schema) if out is None else out

    def _assert_castable(self, layer: str, table: str, schema: T.StructType, parts: list[dict]) -> None:
        """Refuse a change of type that some value of the parts does not survive.

        Types that hold all values of the old one need no look at the data; others
        cost one count over the changed columns.
        """
        types = {f.name: f.dataType for f in schema}
        alike: dict[str, list[dict]] = {}
        for p in parts:
            alike.setdefault(p["columns"].json(), []).append(p)
        for own in alike.values():
            changed = [f for f in own[0]["columns"] if f.name in types and not holds_all(f.dataType, types[f.name])]
            if not changed:
                continue
            rows = self._frame(layer, table, T.StructType(changed), own)
            lost = lambda f: F.count_if(column(f.name).isNotNull() & column(f.name).try_cast(types[f.name]).isNull())
            try:
                counts = rows.agg(*[lost(f).alias(str(k)) for k, f in enumerate(changed)]).first()
            except AnalysisException as exc:
                raise SchemaChangeError(f"{layer}/{table}: {exc}") from exc
            bad = [f"{f.name} ({n} values)" for f, n in zip(changed, counts, strict=True) if n]
            if bad:
                raise SchemaChangeError(f"{layer}/{table}: old values do not fit the new type of {', '.join(bad)}")

    def _assert_unique(self, layer: str, table: str, schema: T.StructType, parts: list[dict], key: str) -> None:
        """One partially aggregated count on the key column of the parts about to be committed."""
        rows = self._frame(layer, table, schema, parts).select(key).where(F.col(key).isNotNull())
        twice = rows.groupBy(key).count().where("count > 1").select(key).first()
        if twice is not None:
            for p in parts:
                self._delete(f"{self.path(layer, table)}/{p['path']}")
            raise DuplicateKeyError(f"{layer}/{table} would hold {key} = {twice[0]!r} more than once")

    # -- tables -------------------------------------------------------------------
    def exists(self, layer: str, table: str) -> bool:
        return self.current_version(layer, table) is not None

    def read(self, layer: str, table: str, slots=None, version: int | None = None) -> DataFrame | None:
        """A table (S5), or its given slots; None when never published.

        Parts are read under the table's schema: a column that an old part
        lacks is null there, one that the table dropped is not read, one that
        lies there in another type is cast.
        """
        m = self.manifest(layer, table, version)
        return None if m is None else self._frame(layer, table, m.schema, m.within(slots))

    def up_to_date(self, layer: str, table: str, inputs: dict) -> bool:
        """Whether the table was last written from exactly these input versions (``built_from``)."""
        m = self.manifest(layer, table)
        return m is not None and m.notes.get("built_from") == inputs

    def publish(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        *,
        key: str | None = None,
        slot: Column | None = None,
        notes: dict | None = None,
    ) -> int:
        """The table becomes ``df`` (K6, K7, K9); ``key`` must be unique in it."""
        base = self.manifest(layer, table)
        parts = self._write_part(layer, table, df, slot)
        if key:
            self._assert_unique(layer, table, df.schema, parts, key)
        return self._commit(layer, table, base, df.schema, parts, notes)

    def append(
        self, layer: str, table: str, df: DataFrame, *, key: str | None = None, notes: dict | None = None
    ) -> int | None:
        """Add the rows of ``df`` (H1): old parts stay as they are.

        The table takes the schema of ``df`` (K10); where old values do not fit
        it, nothing is written and ``SchemaChangeError`` says which columns.
        Nothing is written or committed either when there is no row and no
        change of schema.
        """
        base = self.manifest(layer, table)
        self._assert_castable(layer, table, df.schema, base.parts if base else [])
        parts = self._write_part(layer, table, df, None)
        if key and parts:
            self._assert_unique(layer, table, df.schema, parts, key)
        if base is not None and not parts and same_columns(base.schema, df.schema):
            return None
        return self._commit(layer, table, base, df.schema, (base.parts if base else []) + parts, notes)

    def rewrite(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        *,
        slot: Column,
        replaced: list[str],
        key: str | None = None,
        notes: dict | None = None,
    ) -> int:
        """Replace the slots ``replaced`` by the rows of ``df``; rows of other slots are added to them.

        Parts of slots that are not replaced are neither read nor written.
        """
        base = self.manifest(layer, table)
        kept = [p for p in (base.parts if base else []) if p["slot"] not in replaced]
        self._assert_castable(layer, table, df.schema, kept)
        new = self._write_part(layer, table, df, slot)
        if key:
            self._assert_unique(layer, table, df.schema, new, key)
        return self._commit(layer, table, base, df.schema, kept + new, notes)

    def replace_rows(
        self, layer: str, table: str, rows: DataFrame, key: str, *, slot: Column, notes: dict | None = None
    ) -> int:
        """Delete the rows that have a key of ``rows`` and insert those (H2).

        Only parts that hold such a key are read beyond the key column and
        written again, by ``slot``; the table takes the schema of ``rows``.
        """
        base = self.manifest(layer, table)
        keys = rows.select(key)
        of_part = F.regexp_extract(F.col("_metadata.file_path"), "/(parts/.*)/[^/]*$", 1)
        path = self.path(layer, table)
        held = []
        for p in {p["columns"].json(): p["columns"] for p in base.parts}.values():
            own = [f"{path}/{q['path']}" for q in base.parts if q["columns"] == p]
            scan = self.spark.read.schema(p).parquet(*own).select(F.col(key), of_part.alias("part"))
            held += [r["part"] for r in scan.join(keys, key, "left_semi").select("part").distinct().collect()]
        hit = [p for p in base.parts if p["path"] in held]
        kept = [p for p in base.parts if p["path"] not in held]
        self._assert_castable(layer, table, rows.schema, base.parts)
        stay = self._frame(layer, table, rows.schema, hit).join(keys, key, "left_anti") if hit else None
        new = self._write_part(layer, table, rows if stay is None else stay.select(*rows.columns).union(rows), slot)
        self._assert_unique(layer, table, rows.schema, new, key)
        return self._commit(layer, table, base, rows.schema, kept + new, notes)

    def publish_empty(self, layer: str, table: str) -> int | None:
        """Empty the table, keeping its schema (K4's truncate, K5); writes no data."""
        base = self.manifest(layer, table)
        return None if base is None else self._commit(layer, table, base, base.schema, [])

    def reset_raw(self, tables) -> list[str]:
        """K5: empty every existing raw table; snapshots and marts untouched."""
        return [t for t in tables if self.publish_empty("raw", t) is not None]

    def quarantine(self, table: str, rejected: DataFrame, batch_id: str, *, replay: bool = False) -> str:
        """K8: rejected source rows of one batch, in their own partition.

        ``batch_id`` must be new, so no rejects are ever lost to a later batch;
        only ``replay`` (the same batch delivered again) replaces its own.
        """
        path = f"{self.path('rejected', table)}/batch={batch_id}"
        rejected.write.mode("overwrite" if replay else "errorifexists").parquet(path)
        return path

    def stage(self, run: str, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """A step's result, written once in the shared warehouse and read by all later steps."""
        path = f"{self.path('staging', run)}/{name}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staging(self, run: str) -> None:
        self._delete(self.path("staging", run))

    # -- housekeeping -----------------------------------------------------------
    def vacuum(self, layer: str, table: str, keep: int = 2, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        """Keep the newest ``keep`` versions; delete older manifests and the parts only they list.

        Parts that no manifest lists (a writer failed, or is still at work) go
        when they are older than ``orphan_hours``.
        """
        known = self.versions(layer, table)
        if not known:
            return []
        base = self.path(layer, table)
        part = lambda p: p["path"].split("/")[1]
        used = {part(p) for v in known[-keep:] for p in self.manifest(layer, table, v).parts}
        old = {part(p) for v in known[:-keep] for p in self.manifest(layer, table, v).parts} - used
        for v in known[:-keep]:
            self._delete(f"{base}/commits/{v:012d}.json")
        limit = (time.time() - orphan_hours * 3600) * 1000
        removed = []
        for s in self._list(f"{base}/parts"):
            name = s.getPath().getName()
            if name in old or (name not in used and s.getModificationTime() < limit):
                self._delete(f"{base}/parts/{name}")
                removed.append(name)
        return removed
