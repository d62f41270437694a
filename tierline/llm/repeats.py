"""Removal of long repeated byte strings by bucket-pointer refinement (operator 1).

A window is a string of ``LENGTH`` bytes. Every window that also starts elsewhere, in the
same text or another, is removed with all its bytes. Sorting all suffixes would move every
byte many times over, so buckets of windows are refined instead, and only those leave the
task whose bucket still has two members:

1. The bucket identifier of a q-gram of 64 bytes is built by doubling: that of ``2h``
   bytes combines those of ``h`` bytes here and ``h`` bytes further on. Inside a window,
   the q-gram of smallest identifier (leftmost of equal ones) is its anchor; equal windows
   have equal anchors at equal places. Windows that share an anchor are handled together.
2. First buckets are the anchors' q-grams. Those of one member hold no repeated window.
3. The others are refined: an anchor's windows are split into blocks by the anchor's
   place in the window, first of 64 places, then 8, then 1. A block's common bytes lie in
   all its windows; their bucket is found from the q-gram identifiers at later offsets,
   which are reused in every round. Alone in that bucket, a block is done: nothing in it
   is repeated. If all bytes its windows span lie in a bucket of two, all are repeated.
   What neither settles goes to the next round; with one place a block is a window, and
   both tests are the same.

Certain repeats are settled by 128-bit identifiers, one half from the doubled ones and
one from the bytes themselves. Each round moves a few numbers per block; texts are
dealt once, into a bucketed table, and joined in place with what is undecided of them.
A bucket that a third of all rows share is counted with map-side sums, then joined with
a written table of unique keys, which adaptive execution splits.

Defined results: a null or empty text has no bytes and the digest of the empty string;
texts shorter than a window keep everything; repeated rows are repeats of each other; a
null id stays null; an empty table gives no rows; a text of any length is read in
overlapping parts of about a million windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Store, union

LENGTH = 400
GRAM = 64
PLACES = (64, 8, 1)
PART_WINDOWS = 1 << 20
BUFFER = 1 << 18

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)

Blocks = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * _A
    out ^= b
    out *= _B
    out ^= out >> _SHIFT
    return out


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Identifiers of the q-grams that start at each byte, by doubling."""
    ids = (data.astype(np.uint64) + np.uint64(1)) * _A
    ids ^= ids >> _SHIFT
    h = 1
    while h < GRAM:
        ids = _mix(ids[:-h], ids[h:])
        h *= 2
    return ids


def anchors(ids: np.ndarray, length: int) -> np.ndarray:
    """For each window, where the smallest of its q-grams starts."""
    width = length - GRAM + 1
    n = len(ids) - width + 1
    # The low bits hold the place, so that equal identifiers go to the leftmost.
    low = np.uint64((1 << 22) - 1)
    order = (ids & ~low) | np.arange(len(ids), dtype=np.uint64)
    whole = -(-len(order) // width) * width
    order = np.concatenate([order, np.full(whole - len(order), ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(order, axis=1).ravel()
    behind = np.minimum.accumulate(order[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def _string_ids(ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Identifiers of strings of at least a q-gram, from those at later offsets."""
    size = stop - start
    out = size.astype(np.uint64) * _B
    for k in range(0, int(size.max(initial=0)), GRAM):
        on = size > k
        at = np.minimum(start[on] + k, stop[on] - GRAM)
        out[on] = _mix(out[on], ids[at])
    return out


def blocks(
    data: bytes, active: np.ndarray, places: int, spans: bool, length: int
) -> Blocks:
    """Blocks of the active windows: first and last window, then the bucket of the bytes
    common to their windows, and both halves of that of all bytes they span."""
    ids = gram_ids(np.frombuffer(data, np.uint8))
    at = np.flatnonzero(active)
    anchor = anchors(ids, length)[at]
    place = (anchor - at) // places
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first = at[begin]
    last = at[np.append(begin[1:], len(at)) - 1] if len(at) else at
    anchor, low = anchor[begin], place[begin] * places
    high = np.minimum(low + places - 1, length - GRAM)
    common = _string_ids(ids, anchor - low, anchor - high + length)
    key = exact = np.zeros(len(first), np.uint64)
    if spans:
        stop = last + length
        key = _string_ids(ids, first, stop)
        view, h = memoryview(data), xxhash.xxh3_64_intdigest
        exact = np.fromiter((h(view[a:b]) for a, b in zip(first, stop)), np.uint64, len(first))
    return first, last, common.view(np.int64), key.view(np.int64), exact.view(np.int64)


def _parts(text: bytes, ranges: list[int] | None, length: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """A text's windows in parts: offset, bytes and which windows are active."""
    n = len(text) - length + 1
    if n <= 0:
        return
    for low in range(0, n, PART_WINDOWS):
        count = min(PART_WINDOWS, n - low)
        if ranges is None:
            active = np.ones(count, dtype=bool)
        else:
            pairs = np.clip(np.asarray(ranges, dtype=np.int64).reshape(-1, 2) + [0, 1], low, low + count) - low
            steps = np.zeros(count + 1, dtype=np.int64)
            np.add.at(steps, pairs[:, 0], 1)
            np.add.at(steps, pairs[:, 1], -1)
            active = np.cumsum(steps[:-1]) > 0
        if active.any():
            yield low, text[low : low + count + length - 1], active


BLOCK_SCHEMA = "row long, first int, last int, common long, key long, exact long"


def _emit(df: DataFrame, places: int, spans: bool, length: int) -> DataFrame:
    """Blocks of every text of ``df`` (row, text, ranges)."""

    def flush(held: list[tuple[int, int, bytes, np.ndarray]]) -> pa.RecordBatch:
        # Texts lie end to end; windows that reach into the next one are not active.
        data = b"".join(h[2] for h in held)
        starts = np.cumsum([0, *(len(h[2]) for h in held)])
        active = np.zeros(len(data) - length + 1, dtype=bool)
        for (_, _, part, on), at in zip(held, starts):
            active[at : at + len(on)] = on
        first, last, *keys = blocks(data, active, places, spans, length)
        of = np.searchsorted(starts, first, side="right") - 1
        rows = np.array([h[0] for h in held], dtype=np.int64)[of]
        shift = (np.array([h[1] for h in held], dtype=np.int64) - starts[:-1])[of]
        columns = [rows, (first + shift).astype(np.int32), (last + shift).astype(np.int32), *keys]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["row", "first", "last", "common", "key", "exact"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            row, text, ranges = batch.columns
            for k in range(batch.num_rows):
                known = ranges[k].as_py()
                for low, part, active in _parts(text[k].as_py() or b"", known, length):
                    held.append((row[k].as_py(), low, part, active))
                    size += len(part)
                    if size >= BUFFER:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return df.select("row", "text", "ranges").mapInArrow(run, BLOCK_SCHEMA)


def _deal(docs: DataFrame, store: Store, id_column: str, text_column: str) -> DataFrame:
    """Rows with a number of their own and their bytes, in a table bucketed by it."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"dealt_texts_{uuid.uuid4().hex}"
    (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(text_column).cast("binary").alias("text"),
        )
        .repartition(parts, "row")
        .write.bucketBy(parts, "row")
        .sortBy("row")
        .option("path", store.path("dealt"))
        .saveAsTable(name)
    )
    dealt = spark.table(name)
    # The frame knows its files and buckets; the name is only needed to get it.
    spark.sql(f"DROP TABLE {name}")
    return dealt


def _ranges(hits: DataFrame) -> DataFrame:
    """Per row, its blocks as one flat array of first and last windows."""
    pairs = F.flatten(F.collect_list(F.array("first", "last"))).alias("ranges")
    return hits.groupBy("row").agg(pairs)


def repeated_windows(dealt: DataFrame, store: Store, length: int = LENGTH) -> DataFrame:
    """``row, first, last``: runs of windows of the ``dealt`` texts that occur elsewhere."""
    if length < GRAM:
        raise ValueError(f"windows are at least {GRAM} bytes")
    sure, state = [], None
    for places, spans in ((length, False), *((p, True) for p in PLACES)):
        if state is None:
            given = dealt.withColumn("ranges", F.lit(None).cast("array<int>"))
        else:
            given = dealt.join(_ranges(state), "row")
        found = store.keep(_emit(given, places, spans, length), f"blocks-{places}")
        hits = found.join(_shared(found, ["common"], store, f"common-{places}"), "common")
        if not spans:
            state = store.keep(hits, f"hits-{places}")
            continue
        both = ["key", "exact"]
        twice = _shared(found, both, store, f"spans-{places}").withColumn("sure", F.lit(True))
        hits = store.keep(hits.join(twice, both, "left"), f"hits-{places}")
        settled, open_ = hits.where("sure"), hits.where("sure is null")
        sure.append(settled.select("row", "first", "last"))
        # Settled blocks leave, but one of each kind stays as a partner for those of
        # its bucket that are still open.
        one = settled.groupBy(*both).agg(F.min(F.struct("row", "first", "last", "common")).alias("b"))
        waiting = store.keep(open_.select("common").distinct(), f"open-{places}")
        partners = one.select("b.*").join(waiting, "common", "left_semi")
        state = store.keep(
            open_.select("row", "first", "last").unionByName(partners.select("row", "first", "last")),
            f"state-{places}",
        )
    return union(sure)


def _shared(found: DataFrame, keys: list[str], store: Store, name: str) -> DataFrame:
    """The buckets of two or more members, written so that a hot one can be split."""
    counted = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return store.keep(counted.where("n > 1").select(*keys), name)


def cut_out(text: bytes, ranges: list[int] | None, length: int = LENGTH) -> tuple[bytes, int]:
    """``text`` without the windows of ``ranges``, and how many runs were removed."""
    if not ranges:
        return text, 0
    pairs = np.asarray(ranges, dtype=np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0])] + [0, length]
    out, at, spans, stop = [], 0, 0, -1
    for a, b in pairs.tolist():
        if a > stop:
            spans += 1
            out.append(text[at:a])
        stop = max(stop, b)
        at = stop
    out.append(text[at:])
    return b"".join(out), spans


def remove_repeats(
    docs: DataFrame,
    store: Store,
    *,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, kept`` (binary) and ``n_spans`` of every row.

    ``kept`` may end inside a character; decoding it is up to the caller.
    """
    dealt = _deal(docs, store, id_column, text_column)
    removed = repeated_windows(dealt, store, length)
    given = dealt.join(_ranges(removed), "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                doc_id, text, ranges = part.columns
                texts = [t or b"" for t in text.to_pylist()]
                kept = [cut_out(t, r, length) for t, r in zip(texts, ranges.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id,
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([k for k, _ in kept], pa.binary()),
                        pa.array([n for _, n in kept], pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "kept", "n_spans"],
                )

    schema = "doc_id long, n_bytes long, kept binary, n_spans long"
    return given.select("doc_id", "text", "ranges").mapInArrow(run, schema)


def digest(removed: DataFrame) -> DataFrame:
    """Counts and the SHA-256 of what is kept, and the kept text as far as it is UTF-8."""
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        F.expr("make_valid_utf8(cast(kept AS string))").alias("text"),
    )
