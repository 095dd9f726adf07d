from __future__ import annotations

import os
from urllib.parse import urlparse

from caremarts.plans import scenarios as SC
from caremarts.plans.registry import context
from caremarts.session import cut_lineage

TINY = "/root/testdata/sf0.001"


def test_a_cut_reads_only_the_columns_asked_for(spark):
    df = spark.range(20).selectExpr("id", "cast(id % 3 as int) as part", "cast(null as string) as none")
    cut = cut_lineage(df)
    plan = cut.select("part")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<part:int>" in plan
    assert cut.dtypes == df.dtypes and sorted(cut.collect()) == sorted(df.collect())


def test_incremental_runs_read_the_extracts_once(spark):
    """What follows the written tables scans them alone, not the extracts again."""
    for how in ("skip", "replace"):
        run = SC.incremental_claims(context(spark, TINY).valid, on_match=how)
        for df in (run.enriched_a, run.enriched_b, run.fct_a, run.fct_b, run.claims):
            files = [urlparse(f).path for f in df.inputFiles()]
            assert files and not any(f.startswith(os.path.dirname(TINY)) for f in files)
