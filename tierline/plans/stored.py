"""Check results of tables that grow load by load, from measures stored with each load.

Numbers from the rows of a table add up over loads. What checks ask of keys needs the keys:
each load stores its rows per key, and these add up as well. So after an append only the
new load's rows are read, and the suite over all loads reads the stored measures alone:
a few numbers, and for each key column its values with their counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans.checks import RESULT, Check, Measures, OrphanCheck, evaluate, result_of
from tierline.sources.files import LOAD, append_load, read_loads

NUMBERS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def _keys_path(path: str, table: str, keys: Sequence[str]) -> str:
    return f"{path}/keys/{table}/{'-'.join(keys)}"


class _Named(Measures):
    """Measures called by their check's name, which is the same in every load."""

    def label(self, check: Check, at: int) -> str:
        return check.name

    def keys_asked(self, keys: Sequence[str], table: str) -> tuple[str, ...]:
        wider = self._composite.get((table, keys[0])) if len(keys) == 1 else None
        return tuple(wider or keys)


class _Asked(_Named):
    """Notes which keys the checks need."""

    def __init__(self, tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> None:
        super().__init__(tables, checks)
        self.keys: set[tuple[str, tuple[str, ...]]] = set()

    def per_key(self, table: str, keys: Sequence[str]) -> DataFrame:
        self.keys.add((table, self.keys_asked(keys, table)))
        return super().per_key(table, keys)

    def parent(self, check: OrphanCheck) -> tuple[DataFrame, bool]:
        self.per_key(check.parent, [check.parent_key])
        return super().parent(check)

    def values(self, table: str, column: str) -> DataFrame:
        self.per_key(table, [column])
        return super().values(table, column)


class _Stored(_Named):
    """Measures read back, summed over loads."""

    def __init__(
        self, spark: SparkSession, path: str, checks: Sequence[Check], loads: Sequence[str] | None
    ) -> None:
        super().__init__({}, checks)
        self.spark, self.path, self.loads = spark, path, loads
        self.wanted: set[str] = set()

    def scan(self, table: str, name: str, value: Column) -> Column:
        self.wanted.add(f"{table}/{name}")
        return self._number(f"{table}/{name}")

    def per_key(self, table: str, keys: Sequence[str]) -> DataFrame:
        stored = self._stored_keys(table, self.keys_asked(keys, table))
        if self.loads is not None:
            stored = stored.where(F.col(LOAD).isin(*self.loads))
        return stored.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))

    def _stored_keys(self, table: str, keys: tuple[str, ...]) -> DataFrame:
        try:
            return self.spark.read.parquet(_keys_path(self.path, table, keys))
        except AnalysisException as error:
            # Loads without a single row leave no file to take the types from.
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            fields = [*(f"`{key}` string" for key in keys), "_rows long", f"{LOAD} string"]
            return self.spark.createDataFrame([], ", ".join(fields))

    def parent(self, check: OrphanCheck) -> tuple[DataFrame, bool]:
        return self.per_key(check.parent, [check.parent_key]), True

    def values(self, table: str, column: str) -> DataFrame:
        return self.per_key(table, [column]).select(column)

    def scanned(self) -> list[DataFrame]:
        if not self.wanted:
            return []
        numbers = read_loads(self.spark, f"{self.path}/numbers", NUMBERS, self.loads)
        known = {row.name for row in numbers.select("name").distinct().collect()}
        if self.wanted - known:
            raise KeyError(f"not measured when the loads were: {sorted(self.wanted - known)}")
        summed = numbers.groupBy("name").agg(F.sum("n").alias("n"))
        return [summed.select(F.struct("name", "n").alias("_entry"))]


def _check_names(checks: Sequence[Check]) -> None:
    names = [(check.table, check.name) for check in checks]
    if len(set(names)) < len(names):
        raise ValueError("checks of one table need names of their own")


def measure_load(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], path: str, load_id: str
) -> None:
    """Store what ``checks`` need of one load's rows; repeating a load replaces its measures."""
    _check_names(checks)
    asked = _Asked(tables, checks)
    for at, check in enumerate(checks):
        result_of(asked, check, at)
    if asked.scanned():
        numbers = reduce(DataFrame.unionByName, asked.scanned())
        append_load(numbers.select("_entry.name", "_entry.n"), f"{path}/numbers", load_id)
    for table, keys in sorted(asked.keys):
        counts = tables[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        append_load(counts, _keys_path(path, table, keys), load_id)


def run_stored_checks(
    spark: SparkSession,
    layer: str,
    checks: Sequence[Check],
    path: str,
    loads: Sequence[str] | None = None,
) -> DataFrame:
    """As ``run_checks`` over all measured loads together, or some, without their tables."""
    if not checks:
        return spark.createDataFrame([], RESULT)
    _check_names(checks)
    return evaluate(layer, _Stored(spark, path, checks, loads), checks)
