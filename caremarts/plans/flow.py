"""End-to-end job (E1-E3): ingest -> seeds -> snapshot -> models -> tests -> gate.

Modes (E2): ingest only, transform only, both (default, idempotent
accumulation), and reset (replace loads + full refresh of the incremental
models; history is kept).

Every published table is a lineage cut: later steps read the Parquet version
just written, so a lost executor only recomputes from the last table, never
from the raw extracts.

A table records the versions of the tables it was built from. A model, the
snapshot or the check suite whose inputs have not moved since is not run again:
a rerun over the same extracts writes no data into any of them.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from caremarts import __version__
from caremarts.operators import quality as Q
from caremarts.operators.contracts import CONTRACTS, SOURCE_RENAMES
from caremarts.operators.incremental import incremental_append
from caremarts.operators.scd2 import snapshot_table
from caremarts.operators.upsert import key_slot, load_table, slots_for
from caremarts.operators.validate import Validation, validate
from caremarts.plans import ingest
from caremarts.plans import intermediate as I
from caremarts.plans import marts as M
from caremarts.plans.models import MART_READS, Models
from caremarts.session import configure
from caremarts.sources.csv import read_source
from caremarts.sources.fixtures import RawSources, raw_sources
from caremarts.warehouse import Warehouse

# -- fixed values: file globs of the three source extracts --------------------
CSV_GLOBS = {
    "beneficiary": ("claims_fraud/Train_Beneficiarydata-*.csv", "claims_fraud/Test_Beneficiarydata-*.csv"),
    "inpatient_claims": ("claims_fraud/Train_Inpatientdata-*.csv", "claims_fraud/Test_Inpatientdata-*.csv"),
    "outpatient_claims": ("claims_fraud/Train_Outpatientdata-*.csv", "claims_fraud/Test_Outpatientdata-*.csv"),
    "providers": ("claims_fraud/Train-*.csv", "claims_fraud/Test-*.csv"),
    "diabetes_encounters": ("diabetes_readmission/diabetic_data.csv",),
    "hospital_admissions": ("synthetic_hospital/HospitalSynthetic1.csv",),
}

INCREMENTAL_FACTS = {
    "fct_claims": "claim_id",
    "fct_encounters": "encounter_id",
    "fct_hospital_admissions": "admission_id",
}
SNAPSHOT = "snap_provider_fraud"
#: The rows of the last run of the check suite.
CHECKS = "check_results"
FACT_SLOT_BYTES = 512 << 20  # of a fact that is written whole; a replaced key rewrites its slot


@dataclass
class FlowConfig:
    warehouse: str
    source: str  # a test-data directory (fixtures) or a CSV root
    source_kind: str = "fixtures"  # fixtures | csv
    ingest: bool = True
    transform: bool = True
    reset: bool = False
    batch_ts: dt.datetime | None = None
    fail_on_test_error: bool = True
    on_match: str = "skip"  # what an incremental run does with known keys: skip | replace
    raw_slots: int = 16  # the fewest hash slots of a raw table; it gets more as it grows
    keep_versions: int = 3  # older versions of every table are vacuumed after the run


@dataclass
class FlowResult:
    summary: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)


def csv_sources(spark: SparkSession, root: str) -> RawSources:
    """The reference's CSV extracts, all columns as text."""

    def read(table: str, i: int):
        glob = f"{root.rstrip('/')}/{CSV_GLOBS[table][i]}"
        return read_source(spark, glob, renames=SOURCE_RENAMES.get(table))

    return RawSources(
        beneficiary_train=read("beneficiary", 0),
        beneficiary_test=read("beneficiary", 1),
        inpatient=read("inpatient_claims", 0).unionByName(
            read("inpatient_claims", 1), allowMissingColumns=True
        ),
        outpatient=read("outpatient_claims", 0).unionByName(
            read("outpatient_claims", 1), allowMissingColumns=True
        ),
        providers_train=read("providers", 0),
        providers_test=read("providers", 1),
        diabetes=read("diabetes_encounters", 0),
        hospital=read("hospital_admissions", 0),
    )


def _sources(spark: SparkSession, cfg: FlowConfig) -> RawSources:
    if cfg.source_kind == "fixtures":
        return raw_sources(spark, cfg.source)
    if cfg.source_kind == "csv":
        return csv_sources(spark, cfg.source)
    raise ValueError(f"unknown source kind {cfg.source_kind!r}")


def raw_reader(wh: Warehouse) -> Callable[[str], DataFrame]:
    def raw(table: str) -> DataFrame:
        df = wh.read("raw", table)
        if df is None:
            raise FileNotFoundError(f"raw table {table} has never been loaded")
        return df

    return raw


def input_versions(wh: Warehouse, tables: tuple[str, ...]) -> dict:
    """What a model over these tables is built from: their versions, and that of this library."""
    return {"code": __version__, **{t: wh.current_version(*t.split("/")) for t in tables}}


def update_facts(
    wh: Warehouse, models: Models, names: list[str], *, full_refresh: bool = False, on_match: str = "skip"
) -> None:
    """Bring incremental facts up to date with the raw tables; one whose inputs have not moved is left alone."""
    how = {"full_refresh": full_refresh, "on_match": on_match}
    for name in names:
        key = INCREMENTAL_FACTS[name]
        if name == "fct_claims":
            # int_claims_enriched is itself incremental; fct_claims reads its new version
            enrich = lambda src: I.int_claims_enriched(src, models.stg_beneficiary)
            update_fact(wh, "int_claims_enriched", key, models.int_claims_unified, enrich, **how)
            update_fact(wh, name, key, wh.read("marts", "int_claims_enriched"), M.fct_claims, **how)
        elif name == "fct_encounters":
            update_fact(wh, name, key, models.int_encounters_enriched, M.fct_encounters, **how)
        else:
            update_fact(wh, name, key, models.int_admissions_enriched, M.fct_hospital_admissions, **how)


class TestFailure(RuntimeError):
    pass


# Independent tables are submitted as concurrent Spark jobs from driver
# threads: the scheduler interleaves their stages, so short stages of one
# table fill the executor slots another leaves idle.
MAX_CONCURRENT_JOBS = 6


def run_concurrently(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_JOBS, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def run_ingest(spark: SparkSession, wh: Warehouse, cfg: FlowConfig, ts: dt.datetime, run: str) -> dict:
    """The six tables in loader order with one batch time.

    A table's annotated rows are written once to the shared staging area and
    counted as they are; the rejects and the batch are read from there.
    """
    mode = "replace" if cfg.reset else "upsert"
    prepared = ingest.prepared_sources(_sources(spark, cfg))

    def one(table: str) -> Validation:
        v = validate(prepared[table], CONTRACTS[table])
        v = v.over(wh.stage(run, table, v.annotated))
        wh.quarantine(table, v.rejected, f"{run}-{table}")
        load_table(wh, table, ingest.stamp(v.valid, ts), ingest.NATURAL_KEYS[table], mode, cfg.raw_slots)
        return v

    done = run_concurrently({t: (lambda t=t: one(t)) for t in ingest.TABLE_ORDER})
    return {t: done[t].counts() for t in ingest.TABLE_ORDER}


def update_fact(
    wh: Warehouse, name: str, key: str, source: DataFrame, transform: Callable, *, full_refresh: bool, on_match: str
) -> None:
    """One incremental run of a fact table (H1-H3): unseen keys are appended as a new part.

    A run without unseen keys writes nothing, one whose inputs have not moved
    since the last does not look. ``on_match="replace"`` rewrites the parts that
    hold keys of the source (H2); a full refresh and the first run write the
    table anew, divided by key.
    """
    notes = {"built_from": input_versions(wh, MART_READS[name])} if name in MART_READS else {}
    if notes and not full_refresh and wh.up_to_date("marts", name, notes["built_from"]):
        return
    target = wh.read("marts", name)
    if target is None or full_refresh:
        rows, _ = incremental_append(source, None, key, transform)
        read = [wh.manifest(*t.split("/")) for t in MART_READS.get(name, ())]  # a fact is about as large as its inputs
        n = slots_for(sum(m.bytes for m in read if m), FACT_SLOT_BYTES, 1)
        wh.publish("marts", name, rows, key=key, slot=key_slot(key, n), notes={**notes, "slots": n})
    elif on_match == "replace":
        slots = wh.manifest("marts", name).notes.get("slots", 1)
        wh.replace_rows("marts", name, transform(source), key, slot=key_slot(key, slots), notes=notes)
    else:
        rows, _ = incremental_append(source, target, key, transform, on_match=on_match)
        wh.append("marts", name, rows, key=key, notes=notes)


def run_transform(spark: SparkSession, wh: Warehouse, cfg: FlowConfig, ts: dt.datetime, run: str) -> dict:
    """Seeds -> snapshot -> models (incremental facts, rebuilt dims) -> tests -> gate."""
    raw = raw_reader(wh)
    # snapshot reads raw providers directly, before the models
    labels = input_versions(wh, ("raw/providers",))
    if not wh.up_to_date("snapshots", SNAPSHOT, labels):
        snapshot_table(wh, SNAPSHOT, raw("providers"), ts, run, notes={"built_from": labels})
    models = Models(spark, raw, snapshot=wh.read("snapshots", SNAPSHOT))

    def build(name: str) -> None:
        built_from = input_versions(wh, MART_READS[name])
        if cfg.reset or not wh.up_to_date("marts", name, built_from):
            wh.publish("marts", name, models.mart(name), notes={"built_from": built_from})

    jobs: dict[str, Callable[[], object]] = {
        name: (lambda name=name: update_facts(wh, models, [name], full_refresh=cfg.reset, on_match=cfg.on_match))
        for name in INCREMENTAL_FACTS
    }
    jobs |= {name: (lambda name=name: build(name)) for name in Q.MART_NAMES if name not in INCREMENTAL_FACTS}
    run_concurrently(jobs)

    published = _Published(models, wh)
    checked = run_concurrently(
        {
            "tests": lambda: check_results(wh, published),
            "counts": lambda: Q.gate_marts(Q.mart_row_counts(published)),
        }
    )
    tests = {r["check_name"]: (r["severity"], r["failing_rows"], r["status"]) for r in checked["tests"]}
    failed = [n for n, (_, _, s) in tests.items() if s == "fail"]
    counts = checked["counts"]
    out = {
        "tests": {
            "total": len(tests),
            "pass": sum(1 for v in tests.values() if v[2] == "pass"),
            "warn": sum(1 for v in tests.values() if v[2] == "warn"),
            "fail": len(failed),
            "failed": sorted(failed),
        },
        "mart_row_counts": counts,
    }
    if failed and cfg.fail_on_test_error:
        raise TestFailure(f"data tests failed: {', '.join(sorted(failed))}")
    return out


def check_results(wh: Warehouse, published: _Published) -> list:
    """The rows of the check suite (Q15): of a new run, or the last one's where no table it reads has moved."""
    tables = [*(f"raw/{t}" for t in ingest.TABLE_ORDER), f"snapshots/{SNAPSHOT}", *(f"marts/{n}" for n in MART_READS)]
    inputs = input_versions(wh, tuple(tables))
    if not wh.up_to_date("marts", CHECKS, inputs):
        wh.publish("marts", CHECKS, Q.run_suite(published), notes={"built_from": inputs})
    return wh.read("marts", CHECKS).collect()


class _Published:
    """Models view for the test suite: marts from their published versions,
    staging and intermediate models as lazy views over the raw tables."""

    def __init__(self, models: Models, wh: Warehouse):
        self._models = models
        self._wh = wh

    def __getattr__(self, name: str) -> DataFrame:
        if name in Q.MART_NAMES or name == "int_claims_enriched":
            return self._wh.read("marts", name)
        return getattr(self._models, name)


def run_flow(spark: SparkSession, cfg: FlowConfig) -> FlowResult:
    """Run the selected steps in order; returns counts and step times."""
    configure(spark)
    ts = cfg.batch_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    run = f"{ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"  # unique: a second run of a batch time keeps its own rejects
    wh = Warehouse(spark, cfg.warehouse)
    res = FlowResult()
    if cfg.ingest:
        t = time.time()
        if cfg.reset:
            wh.reset_raw(ingest.TABLE_ORDER)
        res.summary["ingestion"] = run_ingest(spark, wh, cfg, ts, run)
        res.timings["ingest"] = round(time.time() - t, 2)
    if cfg.transform:
        t = time.time()
        res.summary.update(run_transform(spark, wh, cfg, ts, run))
        res.timings["transform"] = round(time.time() - t, 2)
    elif wh.exists("marts", "fct_claims"):
        res.summary["mart_row_counts"] = Q.gate_marts(Q.mart_row_counts(_Published(None, wh)))
    tables = [("raw", x) for x in ingest.TABLE_ORDER] + [("snapshots", SNAPSHOT), ("marts", "int_claims_enriched"), ("marts", CHECKS)]
    for layer, table in tables + [("marts", x) for x in Q.MART_NAMES]:
        wh.vacuum(layer, table, keep=cfg.keep_versions)
    wh.drop_staging(run)
    return res
