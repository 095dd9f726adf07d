"""caremarts: healthcare extracts to three tested star schemas, as Spark jobs.

Layers (all lazy ``DataFrame -> DataFrame`` functions unless noted):

* ``sources``    scans: CSV globs, seeds, the driver's test tables, clinical fixture views
* ``functions``  column expressions (keys, buckets, ages, exact means, token recodes)
* ``operators``  contracts + validation, frame preparation, upsert, incremental, SCD2, checks
* ``plans``      staging / intermediate / mart models, analytics, proofs, the pipeline
* ``streaming``  file-stream ingest with ``foreachBatch``
"""

__version__ = "0.1.0"
