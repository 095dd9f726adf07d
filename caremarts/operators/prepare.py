"""Frame preparation before validation.

Order matters and follows the source loaders: read -> split union -> keep-first
dedup (beneficiary, providers only) -> recodes -> surrogate key -> validate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.functions.columns import recode, surrogate_key
from caremarts.sources.csv import MALFORMED_COL, POSITION_COLS, quote, sql_string

SPLIT_RANK_COL = "_split_rank"

# -- fixed values: cleaning constants of the sources --------------------------
MISSING_SENTINEL = "?"
BRACKET_ARTIFACT = {"20-Nov": "11-20"}
BRACKET_COLS = ("Age", "Stay")


def split_union(*splits: DataFrame) -> DataFrame:
    """Row concat of train/test splits.

    Columns present in only some splits are null elsewhere (the test split of
    providers has no label). ``_split_rank`` records which split a row came
    from so "train before test" survives the unordered union.
    """
    if not splits:
        raise ValueError("split_union needs at least one split")
    out: DataFrame | None = None
    for rank, df in enumerate(splits):
        part = df.withColumn(SPLIT_RANK_COL, F.lit(rank))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def dedup_keep_first(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """First row per ``key`` (P3, W2) by the rows' places: split, file, block, row.

    The places are columns taken at the scan (``sources.csv.POSITION_COLS``),
    before any shuffle; ``order`` names others. Rows of equal or unknown place
    are ordered by their values, so the survivor is deterministic. Rows that
    the reader marked malformed are not compared: all of them stay, to be
    rejected with their reason.

    Runs as ``groupBy(key).agg(min(row))`` with the place leading the row: a
    partial aggregate keeps one candidate per key per task before the shuffle,
    so a key holding a third of the rows never gathers in one task. No window,
    no ``dropDuplicates`` (whose survivor is arbitrary).
    """
    columns = df.columns
    if MALFORMED_COL in columns:
        whole = dedup_keep_first(df.where(F.col(MALFORMED_COL).isNull()).drop(MALFORMED_COL), key, order)
        odd = df.where(F.col(MALFORMED_COL).isNotNull())
        return whole.withColumn(MALFORMED_COL, F.lit(None).cast("string")).unionByName(odd).select(*map(quote, columns))
    if order is None:
        order = [c for c in (SPLIT_RANK_COL, *POSITION_COLS) if c in columns]
    rest = [c for c in columns if c != key and c not in order]
    row = F.struct(*[F.col(quote(c)) for c in [*order, *rest] if c != key])
    return (
        df.groupBy(F.col(quote(key)))
        .agg(F.min(row).alias("__first"))
        .select(*[F.col(quote(c)) if c == key else F.col(f"__first.{quote(c)}").alias(c) for c in columns])
    )


def sentinel_recode(df: DataFrame, sentinel: str = MISSING_SENTINEL) -> DataFrame:
    """Every string cell equal to ``sentinel`` becomes null."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    lit = sql_string(sentinel)
    return df.selectExpr(
        *[
            f"CASE WHEN {quote(c)} = {lit} THEN NULL ELSE {quote(c)} END AS {quote(c)}"
            if c in strings
            else quote(c)
            for c in df.columns
        ]
    )


def bracket_recode(
    df: DataFrame,
    columns: tuple[str, ...] = BRACKET_COLS,
    mapping: dict[str, str] | None = None,
) -> DataFrame:
    """``20-Nov`` (a spreadsheet's date rendering of ``11-20``) back to ``11-20`` (P5)."""
    mapping = mapping or BRACKET_ARTIFACT
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, recode(c, mapping))
    return df


def mint_admission_id(df: DataFrame) -> DataFrame:
    """``admission_id = md5("{case_id}-{patientid}")``."""
    return df.withColumn("admission_id", surrogate_key("case_id", "patientid"))


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(SPLIT_RANK_COL, *POSITION_COLS)


# Per-source preparation, in loader order -------------------------------------


def prepare_beneficiary(train: DataFrame, test: DataFrame) -> DataFrame:
    return drop_helpers(dedup_keep_first(split_union(train, test), "BeneID"))


def prepare_providers(train: DataFrame, test: DataFrame) -> DataFrame:
    return drop_helpers(dedup_keep_first(split_union(train, test), "Provider"))


def prepare_claims(*splits: DataFrame) -> DataFrame:
    """Claims are unioned but never deduplicated: duplicates are rejected."""
    return drop_helpers(split_union(*splits))


def prepare_diabetes(df: DataFrame) -> DataFrame:
    return drop_helpers(sentinel_recode(df))


def prepare_hospital(df: DataFrame) -> DataFrame:
    return drop_helpers(mint_admission_id(bracket_recode(df)))
