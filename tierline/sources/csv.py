"""Raw CSV ingest with load lineage.

Files of one record per line and one kind of escape go through Spark's own reader. Records
that span lines, and files that mix both kinds of escapes, are cut and unescaped in
parallel first (``records``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.schemas import IS_MALFORMED, SOURCE_FILE
from tierline.sources.records import BOTH, parse_records, read_records

MALFORMED = "_malformed"


def _reader(spark: SparkSession, escape: str) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", escape)
    )


def _parsed(
    spark: SparkSession, path: str, schema: T.StructType, escape: str, multi_line: bool
) -> DataFrame:
    """``_source_file``, the columns of ``schema`` and ``_malformed``: the text of a record with
    another number of fields, or NULL."""
    if multi_line or escape == BOTH:
        records = read_records(spark, path, escape=escape, multi_line=multi_line)
        found = parse_records(records, schema, escape=escape, malformed=MALFORMED)
        return found.withColumnRenamed("name", SOURCE_FILE)
    # Only a parser that sees all columns can count a record's fields.
    reader = _reader(spark, escape).option("columnNameOfCorruptRecord", MALFORMED)
    lines = reader.option("columnPruning", False).schema(
        T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    )
    return lines.csv(path).select(F.col("_metadata.file_name").alias(SOURCE_FILE), *schema.names, MALFORMED)


def malformed_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    escape: str = "\\",
    multi_line: bool = False,
) -> DataFrame:
    """``source_file, n_lines, malformed_lines`` per file with data.

    A record is malformed if its number of fields is not the schema's: the ingest
    fills missing fields and leaves surplus ones out, and here the loss shows.
    """
    first = schema.names[0]
    return (
        _parsed(spark, path, schema, escape, multi_line)
        .select(F.col(SOURCE_FILE).alias("source_file"), first, MALFORMED)
        .groupBy("source_file")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            # The reader refuses to answer from the malformed column alone.
            F.count(F.when(F.col(MALFORMED).isNotNull(), F.coalesce(first, MALFORMED))).alias(
                "malformed_lines"
            ),
        )
    )


def ingest_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    escape: str = "\\",
    multi_line: bool = False,
    mark_malformed: bool = False,
) -> DataFrame:
    """Read comma-separated files as text columns, plus when and from which file.

    Columns are bound by position and the header line is skipped. Empty fields
    come out as ``''``, so "blank" has one spelling in the raw layer. Line ends
    may be LF or CRLF and a byte-order mark is dropped.

    ``escape='"'`` reads files that double their inner quotes, ``escape="both"`` files
    that also put a backslash before them. ``multi_line`` allows line breaks inside
    quotes, at the price of reading the files once more to find where quotes end.
    ``mark_malformed`` adds ``_is_malformed``, true for records of another number of fields.
    """
    plain = not (mark_malformed or multi_line or escape == BOTH)
    if plain:
        raw = _reader(spark, escape).schema(schema).csv(path)
        raw = raw.select(*schema.names, F.col("_metadata.file_name").alias(SOURCE_FILE))
    else:
        raw = _parsed(spark, path, schema, escape, multi_line)
    marks = [F.col(MALFORMED).isNotNull().alias(IS_MALFORMED)] if mark_malformed else []
    return raw.select(
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in schema.names],
        F.current_timestamp().alias("_ingested_at"),
        SOURCE_FILE,
        *marks,
    )
