"""Packing token pieces into fixed-length sequences (operator 10).

The plan is made on the histogram of piece lengths, which has at most ``capacity``
entries whatever the number of documents:

1. Lengths are grouped into classes. Patterns of two or three classes that fill a
   sequence are enumerated, and repeat counts are fitted to the class histogram by
   non-negative least squares, then rounded down.
2. Each repeat is filled with real lengths; its last piece is the longest that fits.
3. What is left is packed best fit, longest first, into the gaps and new sequences.

Each step handles a whole run of equal lengths at once, so the plan is a short list of
slots: pieces ``rank .. rank + n`` of a length go to ``n`` consecutive sequences at one
offset. Ranks within a length come from counts per (length, slice), so a length that
holds a third of all pieces is numbered in many tasks.

Defined results: a null or empty text is the end id alone; repeated rows and equal ids
are packed each for itself; a null id stays null; an empty table gives no rows; only
documents longer than ``capacity`` are cut, and ties go to the longer remaining run.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import Store, slices
from tierline.llm.tokens import encoder

CAPACITY = 4096
CLASSES = 128
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame,
    vocabulary: str,
    *,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of each document's ids with the end id."""
    end = struct.pack("<I", end_id)

    def cut(doc_ids: list, texts: pa.Array) -> Iterator[tuple]:
        all_ids, starts = encoder(vocabulary, False).encode_all(texts)
        for doc_id, a, b in zip(doc_ids, starts[:-1].tolist(), starts[1:].tolist()):
            ids = all_ids[a:b].tobytes() + end
            for at in range(0, len(ids), 4 * capacity):
                part = ids[at : at + 4 * capacity]
                yield doc_id, at // (4 * capacity), at // 4, len(part) // 4, zlib.crc32(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in (part for whole in batches for part in slices(whole, 4096)):
            rows = zip(*cut(batch.column(0).to_pylist(), batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)

    keyed = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return keyed.mapInArrow(run, PIECES)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Active-set solution of min ||a x - b|| over x >= 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[active] = 0
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * max(1.0, float(b @ b)) ** 0.5:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            wanted = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (wanted > 0).all():
                x[:] = 0
                x[on] = wanted
                break
            low = wanted <= 0
            step = x[on][low] / np.maximum(x[on][low] - wanted[low], 1e-300)
            x[on] = np.maximum(x[on] + step.min() * (wanted - x[on]), 0)
            active &= x > 1e-12
    return x


def class_patterns(classes: int) -> list[tuple[int, ...]]:
    """Two or three classes, largest first, that together fill ``classes``."""
    pairs = [(a, classes - a) for a in range(classes - 1, (classes - 1) // 2, -1) if a >= classes - a]
    triples = [
        (a, b, classes - a - b)
        for a in range(classes - 2, 0, -1)
        for b in range(min(a, classes - a - 1), 0, -1)
        if b >= classes - a - b >= 1
    ]
    return pairs + triples


class _Plan:
    """Slots under construction: what is left of each length, and gaps of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {l: c for l, c in counts.items() if c}
        self.lengths = sorted(self.left)
        self.used: dict[int, int] = defaultdict(int)
        self.slots: list[tuple[int, int, int, int, int]] = []  # length, rank, n, sequence, offset
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (sequence, n)
        self.sizes: list[int] = []

    def place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.slots.append((length, self.used[length], n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def leave(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if not self.gaps[gap]:
                insort(self.sizes, gap)
            self.gaps[gap].append((sequence, n))

    def longest(self, low: int, high: int) -> int | None:
        """The longest length left in ``low .. high``."""
        at = bisect_right(self.lengths, high) - 1
        return self.lengths[at] if at >= 0 and self.lengths[at] >= low else None

    def repeat(self, pattern: tuple[int, ...], times: int, classes: int) -> None:
        """Fill sequences by ``pattern``; class ``k`` ends at ``k`` parts of ``classes`` of a sequence."""

        def top(size: int) -> int:
            return size * self.capacity // classes

        while times:
            chosen: list[int] = []
            room = self.capacity
            for k, size in enumerate(pattern):
                last = k == len(pattern) - 1
                low, high = (1, room) if last else (top(size - 1) + 1, min(top(size), room))
                length = self.longest(low, high)
                if length is None:
                    return
                chosen.append(length)
                room -= length
            n = min(times, *(self.left[l] // chosen.count(l) for l in chosen))
            if not n:
                return
            sequence, offset = self.open(n), 0
            for length in chosen:
                self.place(length, n, sequence, offset)
                offset += length
            self.leave(room, sequence, n)
            times -= n

    def best_fit(self) -> None:
        while self.lengths:
            length = self.lengths[-1]
            at = bisect_left(self.sizes, length)
            if at < len(self.sizes):
                gap = self.sizes[at]
                sequence, n = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    self.sizes.pop(at)
                take = min(n, self.left[length])
                self.place(length, take, sequence, self.capacity - gap)
                self.leave(gap - length, sequence, take)
                self.leave(gap, sequence + take, n - take)
                continue
            each = self.capacity // length
            n, each = max(1, self.left[length] // each), min(each, self.left[length])
            sequence = self.open(n)
            for k in range(each):
                self.place(length, n, sequence, k * length)
            self.leave(self.capacity - each * length, sequence, n)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, n, first sequence, offset) for a length histogram."""
    plan = _Plan(counts, capacity)
    classes = min(CLASSES, capacity)
    if plan.left:
        histogram = np.zeros(classes + 1)
        for length, n in plan.left.items():
            # The least class whose end, rounded down, reaches the length.
            histogram[-(-length * classes // capacity)] += n
        patterns = class_patterns(classes)
        a = np.zeros((classes + 1, len(patterns)))
        for k, pattern in enumerate(patterns):
            for size in pattern:
                a[size, k] += 1
        # The smallest classes fill gaps later; patterns of large pieces come first.
        times = np.floor(nonnegative_least_squares(a, histogram)).astype(int)
        for k in np.flatnonzero(times):
            plan.repeat(patterns[k], int(times[k]), classes)
    plan.best_fit()
    return plan.slots


def with_slice(pieces: DataFrame) -> DataFrame:
    """Number the slices that :func:`place_pieces` ranks in, by row position.

    So equal pieces spread as well. Write the result: a repeated task must see the same slice.
    """
    slices = max(8, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    position = F.xxhash64(F.monotonically_increasing_id())
    return pieces.withColumn("slice", F.pmod(position, F.lit(slices)).cast("int"))


def place_pieces(sliced: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the written pieces of :func:`with_slice`."""
    per_slice = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    base = per_slice.select(
        "length",
        "slice",
        (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("base"),
    )
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = sliced.withColumn("row", F.row_number().over(within) - 1).join(base, ["length", "slice"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("row"))

    counts = {r.length: r.n for r in sliced.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = sorted(plan_slots(counts, capacity))
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    keys = table[:, 0] * (1 << 44) + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            slot = table[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"{PIECES}, sequence_id long, offset long"
    )


def pack(docs: DataFrame, vocabulary: str, store: Store | None = None, **columns) -> DataFrame:
    """Pieces of ``docs`` with their sequence and offset."""
    store = store or Store(docs.sparkSession)
    return place_pieces(store.keep(with_slice(cut_pieces(docs, vocabulary, **columns)), "pieces"))
