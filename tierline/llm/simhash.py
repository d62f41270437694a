"""Near-duplicates by SimHash, found through Golay-code fuzzy hashing (operator 3).

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 values of
its shingles. Fingerprints within three bits are linked. To find them, the fingerprint is
cut into segments of 22, 21 and 21 bits. Each is decoded by the perfect binary Golay code
of length 23 to the 12-bit index of a nearby codeword. Of two segments one bit apart,
one has even and one odd weight: an even segment has one key, the index it decodes to; an
odd one has the indices of all its one-bit neighbours, at most six. So segments at most
one bit apart share a key. Three errors fall on the segments so that either

- one segment is exact and another has at most one error: key (exact, index), six kinds, or
- each segment has one error: key (index, index, index).

Fingerprints that share a key are verified. Only distinct fingerprints are compared, a
key's fingerprints are dealt in blocks, and each block yields a spanning forest of its
links instead of all pairs, which keeps the components whole.

Defined results: a null or empty text has fingerprint 0 and is linked like any other;
fewer words than a shingle make one shingle; repeated rows share a component; a null id
is no component id unless it is alone; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows
from tierline.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits

GOLAY = 0xC75  # fixed value: generator polynomial of the [23, 12, 7] code
BLOCK = 512


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 values of the runs of ``words`` words, in order."""
    found = (text or "").encode().lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: len(found) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], SEED) for a, b in zip(starts, stops)]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint as a signed number."""
    hashes = shingles(text, words)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at : at + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, *, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    def row(_, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        yield doc_id, fingerprint(text, words)

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(slim, slim.columns, row, "doc_id long, fp long")


class Golay:
    """Decoding of 23-bit words to codeword indices, by syndrome."""

    def __init__(self) -> None:
        columns = []
        for bit in range(23):
            value = 1 << bit
            for high in range(22, 10, -1):
                if value >> high & 1:
                    value ^= GOLAY << (high - 11)
            columns.append(value)
        self.columns = np.array(columns, dtype=np.int64)
        errors = [0, *(1 << a for a in range(23))]
        errors += [1 << a | 1 << b for a in range(23) for b in range(a)]
        errors += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
        self.leader = np.zeros(2048, dtype=np.int64)
        self.leader[self.syndrome(np.array(errors))] = errors

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(words.shape, dtype=np.int64)
        for bit, column in enumerate(self.columns):
            out ^= (words >> bit & 1) * column
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 message bits of the codeword within three bits."""
        return (words ^ self.leader[self.syndrome(words)]) >> 11

    def keys(self, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to six indices per word, and which of the six columns are real."""
        odd = np.bitwise_count(words) & 1 == 1
        flips = np.concatenate([[0], 1 << np.arange(bits)])
        found = self.index(np.where(odd[:, None], words[:, None] ^ flips, words[:, None]))
        found.sort(axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = 1 << 12
        found.sort(axis=1)
        found = found[:, :6]
        return found, found < 1 << 12


def fuzzy_keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, and for each key the number of its fingerprint in ``fp``."""
    words = fp.view(np.uint64)
    parts = [
        (words >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS
    ]
    fuzzy = [golay.keys(p, bits) for p, (_, bits) in zip(parts, SEGMENTS)]
    keys, rows, kind = [], [], 0
    for i, exact in enumerate(parts):
        for j in range(3):
            if i != j:
                index, real = fuzzy[j]
                key = kind << 40 | exact[:, None] << 12 | index
                keys.append(key[real])
                rows.append(np.nonzero(real)[0])
                kind += 1
    (a, ra), (b, rb), (c, rc) = fuzzy
    key = kind << 40 | a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :]
    real = ra[:, :, None, None] & rb[:, None, :, None] & rc[:, None, None, :]
    keys.append(key[real])
    rows.append(np.nonzero(real)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _forest(fp: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest linked member) inside runs of equal ``group``."""
    left, right = [], []
    on = np.arange(len(fp))
    shift = 1
    while True:
        on = on[on + shift < len(fp)]
        on = on[group[on] == group[on + shift]]
        if not len(on):
            break
        near = np.bitwise_count((fp[on] ^ fp[on + shift]).view(np.uint64)) <= max_bits
        left.append(on[near])
        right.append(on[near] + shift)
        shift += 1
    if not left:
        return fp[:0], fp[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(fp))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def links(distinct: DataFrame, store, *, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: fingerprints within ``max_bits`` (at most 3), enough to connect all such.

    ``distinct`` holds each fingerprint once, as ``fp``.
    """
    if max_bits > 3:
        raise ValueError("the keys are made for at most three differing bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 2048):
                fp = np.ascontiguousarray(values[at : at + 2048])
                key, row = fuzzy_keys(fp, golay)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    keyed = distinct.select("fp").mapInArrow(spread, "key long, fp long")
    shared = store.keep(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-keys"
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = (
        keyed.join(shared, "key")
        .select("key", "fp", blocks.alias("blocks"), own.alias("own"))
        .select(
            "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        )
        .select(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"), "fp"
        )
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_group, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out(group: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = _forest(fp, group, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            group = np.concatenate([held_group, batch.column(0).to_numpy()])
            fp = np.concatenate([held_fp, batch.column(1).to_numpy()])
            if not len(group):
                continue
            starts = np.flatnonzero(np.diff(group)) + 1
            at = 0
            while len(group) - at > 4096:
                later = starts[starts >= at + 4096]
                if not len(later):
                    break
                yield out(group[at : later[0]], fp[at : later[0]])
                at = later[0]
            held_group, held_fp = group[at:], fp[at:]
        if len(held_group):
            yield out(held_group, held_fp)

    together = dealt.repartition("group").sortWithinPartitions("group")
    return together.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    store,
    *,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``component_id`` of every row."""
    marked = store.keep(
        fingerprints(docs, words=words, id_column=id_column, text_column=text_column), "fingerprints"
    )
    classes = store.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, store, max_bits=max_bits), store)
    rooted = classes.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store.keep(rooted.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(column: str = "fp"):
    """16 lowercase hex digits of a signed fingerprint."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_first(
    docs: DataFrame, store, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component: the smallest id, of equal ids the first text.

    Rows are numbered when written, and the numbers stand in for the ids, so rows with
    a null or repeated id are kept or dropped by the same rule.
    """
    number = "row_number"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    numbered = store.keep(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(
        numbered.select(F.col(number), F.col(f"`{text_column}`")),
        store,
        id_column=number,
        text_column=text_column,
    )
    group = found.select(F.col("doc_id").alias(number), F.col("component_id").alias("component"))
    group = store.keep(group, "groups")
    slim = numbered.select(number, F.col(f"`{id_column}`").alias("id")).join(group, number)
    first = slim.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", number)).alias("m"))
    kept = first.select(F.col(f"m.{number}").alias(number))
    return numbered.join(kept, number, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
