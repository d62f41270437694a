"""Small helpers the text operators share: written stages, batch mapping, words."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierline.session import shared_folder

# The characters that separate words.
WORD_PATTERN = "[^\x20\x09-\x0d]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Store:
    """A fresh folder under ``spark.checkpoint.dir`` for the tables of one operator."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = shared_folder(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: lineage is cut and nothing is computed twice."""
        path = f"{self.path(name)}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


SLICE_BYTES = 4 * 1024 * 1024


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, of at most ``rows`` rows and about ``SLICE_BYTES`` bytes each."""
    each = batch.nbytes // max(1, batch.num_rows) + 1
    step = max(1, min(rows, SLICE_BYTES // each))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_rows(
    df: DataFrame,
    columns: Sequence[str],
    row: Callable[..., Iterator[tuple]],
    schema: str,
    start: Callable[[], object] | None = None,
    slice_rows: int = 512,
) -> DataFrame:
    """Apply ``row(state, *values)``, which yields output tuples, to every row.

    ``start`` makes the state once per task. Output leaves in batches of at most
    ``slice_rows`` input rows, so memory does not grow with the task.
    """
    names = [part.split()[0].strip("`") for part in _fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start() if start else None
        types = [_arrow(part.split(None, 1)[1]) for part in _fields(schema)]
        for batch in batches:
            for part in slices(batch, slice_rows):
                values = [part.column(i).to_pylist() for i in range(part.num_columns)]
                out = [t for v in zip(*values) for t in row(state, *v)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=k) for c, k in zip(zip(*out), types)], names=names
                    )

    return df.select(*columns).mapInArrow(run, schema)


_KINDS = {
    "long": pa.int64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "double": pa.float64(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
}


def _fields(schema: str) -> list[str]:
    return [part.strip() for part in schema.split(",")]


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return _KINDS[kind.strip()]


def union(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other)
    return first


def chunked(items: Sequence, size: int) -> Iterator[Sequence]:
    it = iter(items)
    while part := list(itertools.islice(it, size)):
        yield part
