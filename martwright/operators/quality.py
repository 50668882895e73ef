"""Data-quality checks as DataFrames: how many rows, or keys, break each rule.

All rules of one table that look at single rows share one aggregation pass. Uniqueness of all
its key columns takes one shuffle, and each reference to another table one more, in which every
key counts once per map task however many rows hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martwright.operators.joins import orphan_keys

RESULT_COLUMNS = ["check_name", "table_name", "column_name", "failed_rows", "status"]


@dataclass(frozen=True)
class RowCheck:
    """Fails for each row where ``broken`` is true."""

    name: str
    column: str
    broken: Column


@dataclass(frozen=True)
class UniqueCheck:
    """``per_key``: fails for each repeated key, nulls ignored. Otherwise fails for each surplus
    row, and null counts as a value."""

    name: str
    column: str
    per_key: bool


@dataclass(frozen=True)
class ReferenceCheck:
    """Fails for each row whose key has no parent; a null key passes only if ``null_passes``."""

    name: str
    column: str
    parent: str
    parent_key: str
    null_passes: bool


@dataclass(frozen=True)
class NonEmptyCheck:
    """Fails once when the table has no row."""

    name: str
    column: str = "*"


Check = RowCheck | UniqueCheck | ReferenceCheck | NonEmptyCheck


@dataclass
class TableChecks:
    table: str
    checks: list[Check] = field(default_factory=list)


# Rules. In a declared rule a null passes (it has its own not-null rule); in an asserted rule,
# ``null_fails``, it breaks the rule like any other bad value.


def _breaks(bad: Column, null_fails: bool) -> Column:
    return F.coalesce(bad, F.lit(True)) if null_fails else bad


def _named(name: str, null_fails: bool) -> str:
    return f"{name}_strict" if null_fails else name


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def not_blank(column: str) -> RowCheck:
    """Null and the empty string fail."""
    return RowCheck("not_blank", column, F.col(column).isNull() | (F.col(column) == ""))


def accepted_values(column: str, values: Sequence, null_fails: bool = False) -> RowCheck:
    bad = ~F.col(column).isin(list(values))
    return RowCheck(_named("accepted_values", null_fails), column, _breaks(bad, null_fails))


def accepted_range(column: str, low=None, high=None, null_fails: bool = False) -> RowCheck:
    """Both bounds are inclusive; either may be left out."""
    c = F.col(column)
    sides = [c < F.lit(low)] if low is not None else []
    if high is not None:
        sides.append(c > F.lit(high))
    bad = reduce(Column.__or__, sides)
    return RowCheck(_named("accepted_range", null_fails), column, _breaks(bad, null_fails))


def positive(column: str) -> RowCheck:
    return RowCheck("positive", column, _breaks(F.col(column) <= 0, True))


def non_negative(column: str) -> RowCheck:
    return RowCheck("non_negative", column, _breaks(F.col(column) < 0, True))


def max_length(column: str, length: int) -> RowCheck:
    return RowCheck("max_length", column, F.length(column) > length)


def contains(column: str, part: str) -> RowCheck:
    return RowCheck("contains", column, _breaks(~F.col(column).contains(part), True))


def total_is_sum(total: str, gross: str, tax: str, tolerance: str = "0.03") -> RowCheck:
    """Total minus gross and tax must stay below the tolerance."""
    gap = F.abs(F.col(total) - (F.col(gross) + F.col(tax)))
    return RowCheck("total_is_sum", total, _breaks(gap >= F.expr(f"{tolerance}BD"), True))


def tax_rate(tax: str, gross: str, rate: str = "0.20", tolerance: str = "0.01") -> RowCheck:
    """Tax over gross near the rate, for rows with a gross amount above zero.

    |tax / gross - rate| >= tolerance, multiplied out so that no division rounds. On very cheap
    rows the rounding of the tax to pence alone can break the rule.
    """
    off = F.abs(F.col(tax) - F.col(gross) * F.expr(f"{rate}BD"))
    broken = off >= F.col(gross) * F.expr(f"{tolerance}BD")
    missing = F.col(gross).isNull() | F.col(tax).isNull()
    return RowCheck("tax_rate", tax, missing | ((F.col(gross) > 0) & broken))


def non_empty() -> NonEmptyCheck:
    return NonEmptyCheck("non_empty")


def unique(column: str) -> UniqueCheck:
    return UniqueCheck("unique", column, per_key=True)


def all_different(column: str) -> UniqueCheck:
    return UniqueCheck("all_different", column, per_key=False)


def relationship(
    column: str, parent: str, parent_key: str, null_passes: bool = True
) -> ReferenceCheck:
    name = _named("relationship", not null_passes)
    return ReferenceCheck(name, column, parent, parent_key, null_passes)


# Evaluation.


def _report(df: DataFrame, table: str, failures: Sequence[tuple[Check, Column]]) -> DataFrame:
    """One aggregation with a count per check, turned into a row per check."""
    counts = df.agg(*[failed.alias(f"n{i}") for i, (_, failed) in enumerate(failures)])
    rows = [
        F.struct(*map(F.lit, (check.name, table, check.column)), F.coalesce(F.col(f"n{i}").cast("bigint"), F.lit(0)))
        for i, (check, _) in enumerate(failures)
    ]
    shape = ", ".join(f"{name} {kind}" for name, kind in zip(RESULT_COLUMNS[:-1], ("string", "string", "string", "bigint"), strict=True))
    return counts.select(F.inline(F.array(*rows).cast(f"array<struct<{shape.replace(' ', ':')}>>".replace(",:", ","))))


def row_report(df: DataFrame, table: str, checks: Sequence[RowCheck | NonEmptyCheck]) -> DataFrame:
    def failed(check: RowCheck | NonEmptyCheck) -> Column:
        if isinstance(check, NonEmptyCheck):
            return F.when(F.count("*") == 0, 1).otherwise(0)
        return F.count_if(check.broken)

    return _report(df, table, [(check, failed(check)) for check in checks])


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each of the columns, all in one scan and one shuffle."""
    pairs = [
        F.struct(F.lit(i).alias("position"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(columns, start=1)
    ]
    pairs = df.select(F.inline(F.array(*pairs)))
    counts = pairs.groupBy("position", "value").agg(F.count("*").alias("rows"))
    names = F.array(*[F.lit(c) for c in columns])
    return counts.select(F.element_at(names, F.col("position")).alias("column_name"), "value", "rows")


def unique_report(df: DataFrame, table: str, checks: Sequence[UniqueCheck]) -> DataFrame:
    counts = key_counts(df, list(dict.fromkeys(c.column for c in checks)))
    rows, value = F.col("rows"), F.col("value")

    def failed(check: UniqueCheck) -> Column:
        here = F.col("column_name") == check.column
        if check.per_key:
            return F.count_if(here & value.isNotNull() & (rows > 1))
        return F.sum(F.when(here, rows - 1))

    return _report(counts, table, [(check, failed(check)) for check in checks])


def reference_report(
    child: DataFrame, table: str, checks: Sequence[ReferenceCheck], parent: DataFrame
) -> DataFrame:
    """Results of checks that share their columns, from one join."""
    column = checks[0].column
    lost = orphan_keys(child, parent, column, checks[0].parent_key)
    rows, has_key = F.col("rows"), F.col(column).isNotNull()
    failures = [(c, F.sum(F.when(has_key, rows) if c.null_passes else rows)) for c in checks]
    return _report(lost, table, failures)


def _merged(suite: Sequence[TableChecks]) -> dict[str, list[Check]]:
    """All checks per table, the same check only once."""
    merged: dict[str, dict] = {}
    for entry in suite:
        for check in entry.checks:
            merged.setdefault(entry.table, {}).setdefault(repr(check), check)
    return {table: list(checks.values()) for table, checks in merged.items()}


def run_checks(tables: dict[str, DataFrame], suite: Sequence[TableChecks]) -> DataFrame:
    """The report over all tables of the suite: one row per check with its failures.

    Suites that are run together share their passes over a table.
    """
    parts = []
    for table, checks in _merged(suite).items():
        df = tables[table]
        on_rows = [c for c in checks if isinstance(c, RowCheck | NonEmptyCheck)]
        on_keys = [c for c in checks if isinstance(c, UniqueCheck)]
        references: dict[tuple, list[ReferenceCheck]] = {}
        for c in checks:
            if isinstance(c, ReferenceCheck):
                references.setdefault((c.column, c.parent, c.parent_key), []).append(c)
        if on_rows:
            parts.append(row_report(df, table, on_rows))
        if on_keys:
            parts.append(unique_report(df, table, on_keys))
        for (_, parent, _), group in references.items():
            parts.append(reference_report(df, table, group, tables[parent]))
    report = reduce(DataFrame.unionAll, parts)
    status = F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL")
    return report.withColumn("status", status)


class ChecksFailed(RuntimeError):
    """Rows that were written broke a rule; ``report`` has the results of all checks."""

    def __init__(self, report: Sequence[tuple]) -> None:
        failed = [f"{table}.{column} {name}: {n}" for name, table, column, n, status in report if status != "PASS"]
        super().__init__("; ".join(failed))
        self.report = list(report)


def observed(df: DataFrame, table: str, suite: Sequence[TableChecks]) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The rows, and their results once they were written: the rules on single rows are counted on the
    way, without a further scan.

    The results have the columns of a report, and wait for the rows to be written.
    """
    checks = [c for c in _merged(suite).get(table, []) if isinstance(c, RowCheck | NonEmptyCheck)]
    if not checks:
        return df, list
    watch = Observation()
    counts = [F.count("*") if isinstance(c, NonEmptyCheck) else F.count_if(c.broken) for c in checks]
    watched = df.observe(watch, *(n.alias(f"n{i}") for i, n in enumerate(counts)))

    def results() -> list[tuple]:
        found = watch.get
        rows = []
        for i, check in enumerate(checks):
            n = found[f"n{i}"] or 0
            failed = int(n == 0) if isinstance(check, NonEmptyCheck) else n
            rows.append((check.name, table, check.column, failed, "FAIL" if failed else "PASS"))
        return rows

    return watched, results


def key_checks(tables: dict[str, DataFrame], suite: Sequence[TableChecks]) -> list[tuple]:
    """The results of the checks that compare rows, unique keys and references, as rows of a report."""
    kept = {t: [c for c in checks if not isinstance(c, RowCheck | NonEmptyCheck)] for t, checks in _merged(suite).items()}
    asked = [TableChecks(table, checks) for table, checks in kept.items() if checks]
    return [tuple(r) for r in run_checks(tables, asked).select(*RESULT_COLUMNS).collect()] if asked else []


def failing_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    """The rows behind a count."""
    return df.filter(check.broken)


def summary(report: DataFrame) -> DataFrame:
    """Checks passed and failed per table."""
    return report.groupBy("table_name").agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )
