"""Run many data-quality checks as one job with one result table.

Checks on the rows of one table share a single scan and aggregate, row counts included;
each key and reference check adds one aggregate over only its own columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.quality import orphans


@dataclass(frozen=True)
class RowCheck:
    """No row of the table may satisfy ``violates``."""

    table: str
    name: str
    violates: Column


@dataclass(frozen=True)
class CountCheck:
    """Rows (that satisfy ``where``) against an expected number, if there is one."""

    table: str
    name: str
    expected: int | None = None
    tolerance: float = 0.0
    where: Column | None = None


@dataclass(frozen=True)
class PairCheck:
    """Two conditions must hold for equally many rows."""

    table: str
    name: str
    left: Column
    right: Column


@dataclass(frozen=True)
class DomainCheck:
    """Number of distinct values, and how many lie outside ``allowed`` if given."""

    table: str
    name: str
    column: str
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class KeyCheck:
    """The columns identify a row."""

    table: str
    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class OrphanCheck:
    """Every key of the table occurs in the parent."""

    table: str
    name: str
    on: str
    parent: str
    parent_key: str
    ignore_null: bool = False
    distinct: bool = False
    unique_parent: bool = False


@dataclass(frozen=True)
class ReconcileCheck:
    """Rows of the parts add up to the rows of the whole.

    Rows of the ``repeats_in`` table beyond the first of each of ``keys`` count too.
    """

    table: str
    name: str
    parts: tuple[str, ...]
    expected: int | None = None
    whole: str | None = None
    tolerance: float = 0.0
    repeats_in: str | None = None
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class RepeatCount:
    """How many rows of ``source`` come after the first of their key; a plain figure."""

    table: str
    name: str
    source: str
    keys: tuple[str, ...]


Check = (
    RowCheck
    | CountCheck
    | PairCheck
    | DomainCheck
    | KeyCheck
    | OrphanCheck
    | ReconcileCheck
    | RepeatCount
)


RESULT = (
    "layer string, table_name string, check_name string, observed bigint, expected bigint, "
    "passed boolean"
)


def _long(value: int | None) -> Column:
    return F.lit(value).cast("long")


def _result(
    check: Check, observed: Column, expected: Column, tolerance: float = 0.0
) -> Column:
    gap = F.abs(observed - expected)
    passed = gap <= F.floor(F.lit(float(tolerance)) * expected) if tolerance else gap == 0
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        observed.alias("observed"),
        expected.alias("expected"),
        passed.alias("passed"),
    )


class Measures:
    """The numbers that checks compare, each computed once however many checks use it.

    All numbers from the rows of one table come from one scan. Numbers from the keys of
    a table come from one aggregate per key; a check on the first column of a composite
    key sums up that key's aggregate, whose shuffle Spark then runs once for both.
    """

    def __init__(self, tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> None:
        self.tables = tables
        self._composite = {
            (c.table, c.keys[0]): c.keys
            for c in checks
            if isinstance(c, KeyCheck) and len(c.keys) > 1
        }
        self._scans: dict[str, dict[str, Column]] = {}
        self._frames: dict[str, DataFrame] = {}

    def scan(self, table: str, name: str, value: Column) -> Column:
        """An aggregate over the rows of ``table``; one name is one aggregate."""
        self._scans.setdefault(table, {})[name] = value
        return self._number(f"{table}/{name}")

    def rows(self, table: str) -> Column:
        return self.scan(table, "rows", F.count(F.lit(1)))

    def of(self, name: str, df: DataFrame, value: Column) -> Column:
        """An aggregate over a frame of its own."""
        self._frames[name] = df.agg(entry(name, value))
        return self._number(name)

    def per_key(self, table: str, keys: Sequence[str]) -> DataFrame:
        """Rows per key, as ``_rows``."""
        wider = self._composite.get((table, keys[0])) if len(keys) == 1 else None
        count = F.count(F.lit(1)).alias("_rows")
        if wider is None:
            return self.tables[table].groupBy(*keys).agg(count)
        pairs = self.tables[table].groupBy(*wider).agg(count)
        return pairs.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))

    def label(self, check: Check, at: int) -> str:
        """What the numbers of a check are called inside one run."""
        return str(at)

    def parent(self, check: OrphanCheck) -> tuple[DataFrame, bool]:
        """Where a reference leads, and whether each key occurs there once."""
        return self.tables[check.parent], check.unique_parent

    def values(self, table: str, column: str) -> DataFrame:
        return self.tables[table].select(column).distinct()

    def _number(self, name: str) -> Column:
        return F.col("_numbers")[name]

    def all(self) -> DataFrame:
        """One row with every number asked for so far."""
        entries = reduce(DataFrame.unionByName, [*self.scanned(), *self.framed()])
        return entries.agg(F.map_from_entries(F.collect_list("_entry")).alias("_numbers"))

    def scanned(self) -> list[DataFrame]:
        """The numbers from the rows of each table."""
        return [
            self.tables[table]
            .agg(*[value.alias(f"_m{i}") for i, value in enumerate(values.values())])
            .select(
                F.explode(
                    F.array(*[entry(f"{table}/{n}", F.col(f"_m{i}")) for i, n in enumerate(values)])
                ).alias("_entry")
            )
            for table, values in self._scans.items()
        ]

    def framed(self) -> list[DataFrame]:
        """The numbers from frames of their own."""
        return [frame.toDF("_entry") for frame in self._frames.values()]


def entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("long").alias("n"))


def _orphan_rows(m: Measures, check: OrphanCheck) -> Column:
    """Rows are counted per key before the join, so a hot key is joined once."""
    parent, unique = m.parent(check)
    lost = orphans(
        m.per_key(check.table, [check.on]),
        parent,
        check.on,
        parent_key=check.parent_key,
        ignore_null=check.ignore_null,
        unique_parent=unique,
    )
    total = F.count(F.lit(1)) if check.distinct else F.coalesce(F.sum("_rows"), _long(0))
    name = f"{check.table}.{check.on} not in {check.parent}.{check.parent_key}"
    return m.of(f"{name} {check.ignore_null} {check.distinct}", lost, total)


def _repeats(m: Measures, table: str, keys: Sequence[str]) -> Column:
    """Rows after the first of their key."""
    surplus = F.coalesce(F.sum(F.col("_rows") - 1), _long(0))
    return m.of(f"repeats {table} {keys}", m.per_key(table, keys), surplus)


def result_of(m: Measures, check: Check, at: int) -> Column:
    """The result of one check as a struct over the numbers it asks ``m`` for."""
    label = m.label(check, at)
    if isinstance(check, RowCheck):
        return _result(check, m.scan(check.table, label, F.count_if(check.violates)), _long(0))
    if isinstance(check, CountCheck):
        if check.where is None:
            seen = m.rows(check.table)
        else:
            seen = m.scan(check.table, label, F.count_if(check.where))
        return _result(check, seen, _long(check.expected), check.tolerance)
    if isinstance(check, PairCheck):
        left, right = (
            m.scan(check.table, f"{label} {side}", F.count_if(condition))
            for side, condition in (("left", check.left), ("right", check.right))
        )
        return _result(check, left, right)
    if isinstance(check, KeyCheck):
        repeated = F.count_if(F.col("_rows") > 1)
        name = f"repeated {check.table} {check.keys}"
        return _result(check, m.of(name, m.per_key(check.table, check.keys), repeated), _long(0))
    if isinstance(check, OrphanCheck):
        return _result(check, _orphan_rows(m, check), _long(0))
    if isinstance(check, DomainCheck):
        values = m.values(check.table, check.column)
        if check.allowed is None:
            return _result(check, m.of(f"domain {label}", values, F.count(F.lit(1))), _long(None))
        known = F.coalesce(F.col(check.column).isin(*check.allowed), F.lit(False))
        return _result(check, m.of(f"domain {label}", values, F.count_if(~known)), _long(0))
    if isinstance(check, RepeatCount):
        return _result(check, _repeats(m, check.source, check.keys), _long(None))
    parts = [m.rows(part) for part in check.parts]
    if check.repeats_in is not None:
        parts.append(_repeats(m, check.repeats_in, check.keys))
    expected = _long(check.expected) if check.whole is None else m.rows(check.whole)
    return _result(check, reduce(Column.__add__, parts), expected, check.tolerance)


def run_checks(layer: str, tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``layer, table_name, check_name, observed, expected, passed`` per check.

    ``passed`` is NULL for a figure that has no expectation. No checks, no rows.
    """
    if not checks:
        return SparkSession.active().createDataFrame([], RESULT)
    return evaluate(layer, Measures(tables, checks), checks)


def evaluate(layer: str, measures: Measures, checks: Sequence[Check]) -> DataFrame:
    results = [result_of(measures, check, at) for at, check in enumerate(checks)]
    return measures.all().select(F.lit(layer).alias("layer"), F.inline(F.array(*results)))


def assert_checks(results: DataFrame) -> None:
    """Raise if a check failed. The result has one row per check."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        lines = [
            f"{r.layer}.{r.table_name} {r.check_name}: {r.observed}, expected {r.expected}"
            for r in failed
        ]
        raise AssertionError("data-quality checks failed:\n" + "\n".join(lines))
