"""What several test modules share."""

from __future__ import annotations

SF_SMOKE = "/root/testdata/sf0.001"


def text_frame(spark, rows: list[dict], columns: list[str] | None = None):
    """Rows as a frame of text columns, as a header CSV read yields them."""
    from pyspark.sql import types as T

    cols = columns or list(rows[0].keys())
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows]
    return spark.createDataFrame(data, schema)
