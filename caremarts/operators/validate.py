"""Declarative, reject-and-continue validation.

Every declared column is coerced once; the rules of a contract set one bit each
in a mask, and the names of the set bits become ``_reject_reasons`` of the rows
that have any. A row with at least one failure is rejected, every other row
passes with its declared columns coerced. ``valid + rejected = input`` always
holds.

Uniqueness (V3) is the only rule that needs other rows: duplicate keys are
found by a scan of the key column alone with a partially aggregated
``groupBy(key).count()`` (map-side combine, so a hot key costs one row per
task, not one task for all its rows), and joined back; AQE sizes that join and
splits it if one key dominates. All copies of a duplicated key are rejected; no
survivor is picked.

Nothing runs or is cached while a validation is built. A job that needs the
halves more than once writes ``annotated`` to a shared table and takes them from
there (``Validation.over``); the counts of both halves are taken as it is written
(``Validation.counts``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caremarts.operators.contracts import ColumnRule, Contract
from caremarts.sources.csv import MALFORMED_COL

REASONS_COL = "_reject_reasons"
_TYPED = "__v_"  # prefix of the coerced copy of a declared column
_MASK_BITS = 62


class ContractError(ValueError):
    """The frame cannot be validated at all (a declared column is missing)."""


@dataclass
class Validation:
    """Result of ``validate``: the annotated frame and its two halves, all lazy."""

    annotated: DataFrame  # source columns as read + _reject_reasons
    contract: Contract
    typed: DataFrame | None = None  # the same rows with the coerced columns beside them
    observation: Observation | None = None

    @property
    def valid(self) -> DataFrame:
        """Rows without a failure: declared columns coerced, extras untouched."""
        declared = self.contract.columns
        rows = self.annotated if self.typed is None else self.typed

        def cell(c: str) -> str:
            if c not in declared:
                return ident(c)
            has_copy = self.typed is not None and declared[c].dtype != "str"
            return f"{ident(_TYPED + c) if has_copy else coerced_sql(c, declared[c])} AS {ident(c)}"

        names = [c for c in self.annotated.columns if c not in (REASONS_COL, MALFORMED_COL)]
        return rows.where(F.size(REASONS_COL) == 0).selectExpr(*[cell(c) for c in names])

    @property
    def rejected(self) -> DataFrame:
        """Rows with a failure, as read, with the reasons."""
        return self.annotated.where(F.size(REASONS_COL) > 0)

    def over(self, annotated: DataFrame) -> Validation:
        """The same validation over a stored copy of ``annotated``."""
        return Validation(annotated, self.contract, None, self.observation)

    def counts(self) -> dict[str, int]:
        """Loaded and rejected rows, counted by the first job that ran over all of ``annotated``.

        No job is run for them; to be asked after that job.
        """
        seen = self.observation.get
        return {"loaded": seen.get("loaded") or 0, "rejected": seen.get("rejected") or 0}


def check_columns(df: DataFrame, contract: Contract) -> None:
    """V7: a declared column absent from the frame fails the whole load."""
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ContractError(
            f"{contract.name}: declared column(s) missing from input: {', '.join(missing)}"
        )


def ident(name: str) -> str:
    """A quoted SQL identifier (source names may hold spaces or hyphens)."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def coerced(name: str, rule: ColumnRule) -> Column:
    """V1: the declared type, or null when the cell cannot be converted."""
    return F.expr(coerced_sql(name, rule))


def coerced_sql(name: str, rule: ColumnRule) -> str:
    """The cast as SQL; a whole number may be written with a fraction of zeros (``12.0``), which few cells are."""
    plain = f"try_cast({ident(name)} AS {rule.spark_type})"
    if rule.dtype != "int":
        return plain
    return f"coalesce({plain}, try_cast(regexp_replace({ident(name)}, '[.]0*$', '') AS {rule.spark_type}))"


def rule_failures(name: str, rule: ColumnRule, dup_flag: str | None, value: str | None = None) -> list[tuple[str, str]]:
    """The rules of one column as SQL: ``(reason, condition of failure)``.

    Rules are rendered as SQL text and handed to Spark in one projection:
    building a few hundred ``Column`` objects one call at a time costs the
    driver seconds per table, the text costs one parse. ``value`` is the coerced
    cell.
    """
    raw = ident(name)
    value = value or coerced_sql(name, rule)
    out = [("dtype", f"{raw} IS NOT NULL AND {value} IS NULL")] if rule.dtype != "str" else []
    if not rule.nullable:
        out.append(("not_null", f"{raw} IS NULL"))
    if rule.unique and dup_flag is not None:
        out.append(("unique", dup_flag))
    if rule.isin is not None:
        values = ", ".join(literal(v) for v in rule.isin)
        out.append(("isin", f"{value} IS NOT NULL AND NOT ({value} IN ({values}))"))
    if rule.ge is not None:
        out.append(("ge", f"{value} IS NOT NULL AND {value} < {literal(rule.ge)}"))
    if rule.between is not None:
        lo, hi = rule.between
        out.append(("in_range", f"{value} IS NOT NULL AND NOT ({value} BETWEEN {literal(lo)} AND {literal(hi)})"))
    return [(f"{name}:{tag}", cond) for tag, cond in out]


def duplicate_keys(df: DataFrame, key_col: str) -> DataFrame:
    """Non-null values of ``key_col`` that occur more than once."""
    return (
        df.select(key_col)
        .filter(F.col(key_col).isNotNull())
        .groupBy(key_col)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
        .select(key_col, F.lit(True).alias(key_col + "_flag"))
    )


def unfused(input_sql: str) -> str:
    """SQL of a zero that keeps the projection it stands in out of whole-stage code.

    There all rules of a table would be one generated method, larger than the
    JVM compiles; beside an expression that has no generated code of its own,
    Spark makes a method of every few of them.
    """
    return f"aggregate(array({input_sql}), 0L, (zero, one) -> zero)"


def validate(df: DataFrame, contract: Contract) -> Validation:
    """Mark each row of ``df`` with the rules of ``contract`` that it fails.

    Lazy: the source is scanned once for its rows and once, for the key column
    only, for duplicates.
    """
    check_columns(df, contract)
    source = [ident(c) for c in df.columns]
    copied = [n for n, r in contract.columns.items() if r.dtype != "str"]
    value = {n: ident(_TYPED + n) if n in copied else ident(n) for n in contract.columns}
    dup_flags: dict[str, str] = {}
    # the source's own column expressions, however many, merge into this projection
    typed, keys_typed = df.selectExpr(*source, f"{unfused('spark_partition_id()')} AS __zero"), []
    for name in contract.unique_columns:
        key = name
        if name in copied:
            key = _TYPED + name
            keys_typed.append(name)
            typed = typed.selectExpr("*", f"{coerced_sql(name, contract.columns[name])} AS {ident(key)}")
        keys = df.selectExpr(f"{coerced_sql(name, contract.columns[name])} AS {ident(key)}")
        typed = typed.join(duplicate_keys(keys, key), key, "left")
        dup_flags[name] = f"coalesce({ident(key + '_flag')}, false)"
    first = f"{ident(next(iter(contract.columns)))} IS NULL"
    copies = [f"{coerced_sql(n, contract.columns[n])} AS {value[n]}" for n in copied if n not in keys_typed]
    typed = typed.selectExpr("*", *copies, f"{unfused(first)} AS __none")

    rules = [("row:malformed", f"{ident(MALFORMED_COL)} IS NOT NULL")] if MALFORMED_COL in df.columns else []
    for name, rule in contract.columns.items():
        rules.extend(rule_failures(name, rule, dup_flags.get(name), value[name]))
    chunks = [rules[at : at + _MASK_BITS] for at in range(0, len(rules), _MASK_BITS)]
    bits = [" | ".join(f"if({cond}, {1 << k}L, 0L)" for k, (_, cond) in enumerate(chunk)) for chunk in chunks]
    masks = [f"({b} | __zero | __none | {unfused(first)}) AS __m{k}" for k, b in enumerate(bits)]
    named = [
        f"filter(array({', '.join(literal(tag) for tag, _ in chunk)}), (tag, i) -> shiftright(__m{k}, i) & 1L = 1L)"
        for k, chunk in enumerate(chunks)
    ]
    passes = " AND ".join(f"__m{k} = 0L" for k in range(len(chunks)))
    reasons = f"CASE WHEN {passes} THEN cast(array() AS array<string>) ELSE concat({', '.join(named)}) END"
    copies = [value[n] for n in copied]
    typed = typed.selectExpr(*source, *copies, *masks).selectExpr(*source, *copies, f"{reasons} AS {REASONS_COL}")
    # Counted as rows pass, and read by ``Validation.counts``. Filters on the
    # reasons stay above this node instead of taking a copy of every rule.
    ok = F.size(REASONS_COL) == 0
    observation = Observation(f"validate_{contract.name}_{uuid.uuid4().hex}")
    typed = typed.observe(observation, F.count_if(ok).alias("loaded"), F.count_if(~ok).alias("rejected"))
    return Validation(typed.drop(*[_TYPED + n for n in copied]), contract, typed, observation)


def ingest_summary(results: dict[str, Validation]) -> DataFrame:
    """One row per table with loaded (valid) and rejected counts.

    Each table is counted in a single aggregate over its annotated frame.
    """
    parts = []
    for table, v in results.items():
        ok = F.size(REASONS_COL) == 0
        parts.append(
            v.annotated.agg(
                F.lit(table).alias("table_name"),
                F.count_if(ok).cast("bigint").alias("loaded"),
                F.count_if(~ok).cast("bigint").alias("rejected"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
