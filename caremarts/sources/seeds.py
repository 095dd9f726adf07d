"""Static lookup seeds.

The built-in seeds have 8 and 3 rows; a seed file may have any number. Joins
carry no hint: the optimizer broadcasts a seed whose size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# -- fixed values: the admission-type seed (id, label) ------------------------
ADMISSION_TYPES = (
    (1, "Emergency"),
    (2, "Urgent"),
    (3, "Elective"),
    (4, "Newborn"),
    (5, "Not Available"),
    (6, "Unknown"),
    (7, "Trauma Center"),
    (8, "Not Mapped"),
)

# -- fixed values: the severity seed (category, rank, description) ------------
SEVERITIES = (
    ("Minor", 1, "Lowest acuity — least severe presentation"),
    ("Moderate", 2, "Intermediate acuity"),
    ("Extreme", 3, "Highest acuity — most severe presentation"),
)

ADMISSION_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("admission_type_id", T.IntegerType(), False),
        T.StructField("admission_type_label", T.StringType(), False),
    ]
)

SEVERITY_SCHEMA = T.StructType(
    [
        T.StructField("severity_of_illness", T.StringType(), False),
        T.StructField("severity_rank", T.IntegerType(), False),
        T.StructField("severity_description", T.StringType(), True),
    ]
)

def admission_type_mapping(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The admission-type seed, from ``path`` (CSV with header) or built in."""
    if path:
        return read_seed(spark, path, ADMISSION_TYPE_SCHEMA)
    return spark.createDataFrame(list(ADMISSION_TYPES), ADMISSION_TYPE_SCHEMA)


def severity_mapping(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The severity seed, from ``path`` (CSV with header) or built in."""
    if path:
        return read_seed(spark, path, SEVERITY_SCHEMA)
    return spark.createDataFrame(list(SEVERITIES), SEVERITY_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Explicit-schema CSV read of a seed file."""
    return spark.read.option("header", True).schema(schema).csv(path)


def seed_join(facts: DataFrame, seed: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a fact to a seed; AQE broadcasts a seed as small as these, so the fact is not shuffled."""
    return facts.join(seed, key, how)
