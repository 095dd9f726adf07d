"""File-stream ingest of one raw table (T-1): readStream -> foreachBatch.

Each micro-batch runs the same steps as a batch ingest: prepare, validate
against the table contract, quarantine the rejects, upsert the valid rows by
natural key, and bring the incremental facts fed by that table up to date (H1).
``foreachBatch`` is at-least-once. The raw table's manifest keeps a ledger: the
last epoch of each stream that was loaded, committed together with its rows. A
replayed epoch that stands there is not read, validated or loaded again; only the
facts are looked at, and those that were built from the present versions are left
alone. An epoch that changed no row leaves no commit, and its replay finds that it
changes none. Rejects go into the epoch's own quarantine partition, which a replay
before the commit rewrites. The stream's id lives in its checkpoint, so a stream
with a new checkpoint never touches the ledger or the rejects of another.

Columns come from the header of the first file in the folder, in their own order
and spelling; a file with another header fails the stream, in the task that reads
it, instead of being read by position. Large files are split between tasks.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caremarts.operators import prepare as P
from caremarts.operators.contracts import CONTRACTS, SOURCE_RENAMES
from caremarts.operators.upsert import load_table
from caremarts.operators.validate import validate
from caremarts.plans.flow import INCREMENTAL_FACTS, raw_reader, update_facts
from caremarts.plans.ingest import stamp
from caremarts.plans.models import Models
from caremarts.session import checkpoint_dir
from caremarts.sources.csv import (
    csv_rows,
    header,
    matching_files,
    na_token_recode,
    text_lines,
)
from caremarts.warehouse import Warehouse

PREPARE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "beneficiary": lambda df: P.drop_helpers(P.dedup_keep_first(df, "BeneID")),
    "inpatient_claims": P.prepare_claims,
    "outpatient_claims": P.prepare_claims,
    "providers": lambda df: P.drop_helpers(P.dedup_keep_first(df, "Provider")),
    "diabetes_encounters": P.prepare_diabetes,
    "hospital_admissions": P.prepare_hospital,
}
#: The facts that a raw table feeds, and all raw tables that each of them reads.
FED_BY = {
    "fct_claims": ("inpatient_claims", "outpatient_claims", "beneficiary"),
    "fct_encounters": ("diabetes_encounters",),
    "fct_hospital_admissions": ("hospital_admissions",),
}


def facts_of(wh: Warehouse, table: str) -> list[str]:
    """Facts that ``table`` feeds and whose raw tables have all been loaded once."""
    return [f for f in INCREMENTAL_FACTS if table in FED_BY[f] and all(wh.exists("raw", t) for t in FED_BY[f])]


def folder_columns(spark: SparkSession, source_dir: str) -> tuple[str, ...]:
    """The header of the first file of a folder; the tasks hold the others against it."""
    files = matching_files(spark, source_dir)
    if not files:
        raise ValueError(f"no files in {source_dir}")
    return header(spark, min(files))


def stream_id(wh: Warehouse, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint; restarts have the same one."""
    return json.loads(wh._read_text(f"{checkpoint}/metadata"))["id"]


def micro_batch(
    wh: Warehouse, table: str, clock: Callable[[], dt.datetime], checkpoint: str, columns: tuple[str, ...]
) -> Callable[[DataFrame, int], None]:
    contract = CONTRACTS[table]
    renames = SOURCE_RENAMES.get(table, {})

    def load(batch: DataFrame, name: str, epochs: dict[str, int]) -> None:
        rows = csv_rows(batch, columns, in_splits=True).withColumnsRenamed({old: new for old, new in renames.items() if old in columns})
        v = validate(PREPARE[table](na_token_recode(rows)), contract)
        v = v.over(wh.stage(name, table, v.annotated))
        wh.quarantine(table, v.rejected, name, replay=True)
        load_table(wh, table, stamp(v.valid, clock()), contract.key, notes={"epochs": epochs})
        wh.drop_staging(name)

    def run(batch: DataFrame, epoch_id: int) -> None:
        stream = stream_id(wh, checkpoint)
        known = wh.manifest("raw", table)
        epochs = known.notes.get("epochs", {}) if known else {}
        if epochs.get(stream, -1) < epoch_id:
            load(batch, f"stream-{stream}-epoch-{epoch_id}", {**epochs, stream: epoch_id})
        facts = facts_of(wh, table)
        if facts:
            update_facts(wh, Models(wh.spark, raw_reader(wh)), facts)

    return run


def start_file_ingest(
    spark: SparkSession,
    table: str,
    source_dir: str,
    warehouse: str,
    *,
    checkpoint: str | None = None,
    columns: tuple[str, ...] | None = None,
    available_now: bool = True,
    clock: Callable[[], dt.datetime] | None = None,
) -> StreamingQuery:
    """Start ingesting CSV files dropped into ``source_dir`` into ``raw/<table>``.

    ``columns`` (source spelling, file order) is read from the files' header
    unless given. The checkpoint lies in the cluster's shared checkpoint folder
    (``spark.checkpoint.dir``) unless a location is given.
    """
    wh = Warehouse(spark, warehouse)
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/caremarts-stream-{table}"
    names = tuple(columns or folder_columns(spark, source_dir))
    stream = text_lines(spark.readStream, source_dir)
    now = clock or (lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None))
    writer = (
        stream.writeStream.foreachBatch(micro_batch(wh, table, now, location, names))
        .option("checkpointLocation", location)
        .queryName(f"ingest_{table}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
