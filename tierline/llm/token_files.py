"""Token ids in compressed files, each document readable by itself (operator 6).

A shared zstandard dictionary is trained on serialized id arrays of a bounded sample.
Every document's ids, little-endian unsigned 32-bit, are one zstandard frame made with
that dictionary. Frames are gathered into segments of a few megabytes; a segment holds
the dictionary's hash and an offset index, so one short document is read without its
neighbours. Segments are rows of a Parquet table, whose writer commits tasks atomically
on any store and survives lost executors.

Segment image (all little-endian): magic ``TKD1``, SHA-256 of the dictionary (32 bytes),
number of documents (u32), per document 1 byte (1: it has an id) and its id (i64),
then frame offsets (u64, one more than documents, from the first frame), then frames.

Defined results: a null or empty text is the end id alone; a null id sorts first and
stays null; repeated rows stay, in order of id, then text hash; an empty table makes no
segments; a very long text is one frame, so memory is bounded by the longest text.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import map_rows, slices
from tierline.llm.tokens import encoder

MAGIC = b"TKD1"
SEGMENT_SCHEMA = "part int, start_in_part long, n_tokens long, n_docs long, image binary"

# Bounds of the sample that the dictionary is trained on: about so many different texts,
# whole, as far as they fit these bytes.
SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 16 * 1024 * 1024
DICTIONARY_BYTES = 32 * 1024
SEGMENT_BYTES = 4 * 1024 * 1024
# Bytes of each half of a worker's remembered pieces.
PIECE_MEMORY = 80 * 1024 * 1024


def train_dictionary(
    docs: DataFrame, vocabulary: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> bytes:
    """Dictionary for the id arrays of ``docs``, from about ``SAMPLE_DOCS`` whole texts.

    Rows are chosen by the hash of their id and text, equal rows once, and taken in order
    of the hash until ``SAMPLE_BYTES`` are reached, so the same rows give the same bytes.
    Where the sample is too small to train on, its own id arrays are the dictionary.
    """
    rows = max(1, docs.count())
    hashed = docs.select(F.xxhash64(id_column, text_column).alias("hash"), F.col(text_column).alias("text"))
    chosen = hashed.where(F.pmod("hash", F.lit(rows)) < SAMPLE_DOCS).dropDuplicates(["hash"])
    before = F.sum(F.octet_length("text")).over(Window.orderBy("hash")) - F.octet_length("text")
    sample = chosen.withColumn("before", before).where(F.col("before") < SAMPLE_BYTES).orderBy("hash").select("text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, True, memory=PIECE_MEMORY).encode
        samples = [encode(t) for b in batches for t in b.column(0).to_pylist()]
        samples = [s for s in samples if s]
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            data = b"".join(samples)[-DICTIONARY_BYTES:]
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

    rows = sample.coalesce(1).mapInArrow(train, "data binary").collect()
    return bytes(max((r.data for r in rows), key=len, default=b""))


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def pack_segment(digest: bytes, docs: list[tuple[int | None, bytes]]) -> bytes:
    """Image of one segment from (id, frame) pairs."""
    ids = b"".join(struct.pack("<Bq", i is not None, i or 0) for i, _ in docs)
    ends = [0]
    for _, frame in docs:
        ends.append(ends[-1] + len(frame))
    index = struct.pack(f"<{len(ends)}Q", *ends)
    head = MAGIC + digest + struct.pack("<I", len(docs))
    return b"".join([head, ids, index, *(frame for _, frame in docs)])


class Segment:
    """Documents of a segment image; ``segment[k]`` reads only document ``k``."""

    def __init__(self, image: bytes, dictionary: bytes) -> None:
        if image[:4] != MAGIC:
            raise ValueError("not a token segment")
        if image[4:36] != hashlib.sha256(dictionary).digest():
            raise ValueError("the segment was written with another dictionary")
        (self.n,) = struct.unpack_from("<I", image, 36)
        self.image = image
        self.index = 40 + 9 * self.n
        self.frames = self.index + 8 * (self.n + 1)
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> tuple[int | None, bytes]:
        known, doc_id = struct.unpack_from("<Bq", self.image, 40 + 9 * k)
        a, b = struct.unpack_from("<2Q", self.image, self.index + 8 * k)
        frame = self.image[self.frames + a : self.frames + b]
        return doc_id if known else None, self.reader.decompress(frame)


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    *,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write ``docs`` under ``path`` as segments in ascending id order."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, vocabulary, id_column=id_column, text_column=text_column)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), dictionary)], "sha256 string, data binary").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/dictionary")

    # The row's number deals rows that are equal otherwise over several ranges.
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("number")]
    ordered = (
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(text_column).alias("text"),
            F.monotonically_increasing_id().alias("number"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(vocabulary, True, memory=PIECE_MEMORY).encode_all
        end = struct.pack("<I", end_id)
        shared = _dictionary(dictionary)
        if shared:
            shared.precompute_compress(level=3)
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared)
        part = TaskContext.get().partitionId()
        start, tokens, held, size = 0, 0, [], 0

        def segment() -> pa.RecordBatch:
            row = (part, start, tokens, len(held), pack_segment(digest, held))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                names=["part", "start_in_part", "n_tokens", "n_docs", "image"],
            )

        for batch in (part for whole in batches for part in slices(whole, 2048)):
            all_ids, starts = encode_all(batch.column(1))
            for doc_id, a, b in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                ids = all_ids[a:b].tobytes() + end
                frame = packer.compress(ids)
                held.append((doc_id, frame))
                tokens, size = tokens + len(ids) // 4, size + len(frame)
                if size >= SEGMENT_BYTES:
                    yield segment()
                    start, tokens, held, size = start + tokens, 0, [], 0
        if held:
            yield segment()

    ordered.mapInArrow(write, SEGMENT_SCHEMA).write.mode("overwrite").parquet(f"{path}/segments")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` adds up the parts before a segment's own. Parts are as many as the
    writer had tasks, so their totals are a small table.
    """
    (row,) = spark.read.parquet(f"{path}/dictionary").collect()
    dictionary = bytes(row.data)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments")
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, before = [], 0
    for r in totals:
        bases.append((r.part, before))
        before += r.n
    base = spark.createDataFrame(bases, "part int, base long")

    def documents(_, start: int, image: bytes) -> Iterator[tuple]:
        segment = Segment(image, dictionary)
        for k in range(len(segment)):
            doc_id, ids = segment[k]
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids)
            start += len(ids) // 4

    placed = segments.join(F.broadcast(base), "part").withColumn(
        "start", F.col("base") + F.col("start_in_part")
    )
    return map_rows(
        placed,
        ["start", "image"],
        documents,
        "doc_id long, start long, n_tokens long, ids_crc32 long",
        slice_rows=4,
    )
