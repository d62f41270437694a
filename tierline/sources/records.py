"""CSV records that may span lines, cut in parallel.

A file is read as lines, in as many splits as any text file. Whether a split begins inside
quotes depends on everything before it, so that is found first: each split is a function
from "begins inside quotes" to "ends inside quotes", and the functions of a file's splits
are applied one after the other. Only one small row per split reaches the driver, as many
as Spark lists itself when it plans the scan. Then every split cuts its own records. What
is left over at its borders, the end of a record begun earlier and the beginning of one
that goes on, is put together by file and place; only splits with such a border are read
again for it.

Lines are handled in batches, and only those with a quote are looked at one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which characters escape a quote inside quotes; both may be used in one file.
BACKSLASH, DOUBLED, BOTH = "\\", '"', "both"
WHOLE, HEAD, TAIL = 0, 1, 2
IN_HEADER = -1

# Lines without a quote that are handed on as they are once so many follow each other.
LONG_RUN = 1_000

_PAIR = re.compile(r"\\.", re.DOTALL)
_QUOTED = re.compile(r'(^|,)"[^"]*"')
_OPENED = re.compile(r'(^|,)"')

Split = tuple[str, int]  # file, first byte


def ends_open(line: str, opened: bool, backslash: bool) -> bool:
    """Whether a line ends inside quotes, if it begins inside them or not.

    Quotes open a field only at its start, so those inside plain text do not count.
    """
    if backslash:
        line = _PAIR.sub("x", line)
    line = line.replace('""', "")
    if opened:
        line = '"' + line
    return _OPENED.search(_QUOTED.sub(r"\1", line)) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[str, str, int, pa.Array]]:
    """The runs of lines of one split inside a batch."""
    at = 0
    file, name, start, value = batch.columns
    while at < batch.num_rows:
        own = pc.and_(pc.equal(file[at:], file[at]), pc.equal(start[at:], start[at]))
        n = pc.index(own, False).as_py()
        n = len(own) if n < 0 else n
        yield file[at].as_py(), name[at].as_py(), start[at].as_py(), value[at : at + n]
        at += n


def _quoted(lines: pa.Array) -> list[tuple[int, str]]:
    """Places of the lines that hold a quote, and these lines."""
    places = pc.indices_nonzero(pc.match_substring(lines, '"'))
    return list(zip(places.to_pylist(), lines.take(places).to_pylist()))


def split_ends(lines: DataFrame, backslash: bool) -> DataFrame:
    """Per split, whether it ends inside quotes if it begins outside, and if inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(split: Split, state: list[bool]) -> pa.RecordBatch:
            values = [pa.array([x]) for x in (*split, *state)]
            return pa.RecordBatch.from_arrays(values, names=["file", "start", "from_outside", "from_inside"])

        split, state = None, [False, True]
        for batch in batches:
            for file, _, start, part in _parts(batch):
                if (file, start) != split:
                    if split:
                        yield out(split, state)
                    split, state = (file, start), [False, True]
                for _, line in _quoted(part):
                    state = [ends_open(line, s, backslash) for s in state]
        if split:
            yield out(split, state)

    return lines.mapInArrow(run, "file string, start long, from_outside boolean, from_inside boolean")


def quote_states(ends: list[tuple[str, int, bool, bool]]) -> dict[Split, tuple[bool, bool]]:
    """Whether each split really begins and ends inside quotes."""
    found, file, state = {}, None, False
    for name, start, from_outside, from_inside in sorted(ends):
        if name != file:
            file, state = name, False
        begins, state = state, from_inside if state else from_outside
        found[name, start] = (begins, state)
    return found


def _cut(
    lines: DataFrame, states: dict[Split, tuple[bool, bool]] | None, backslash: bool, borders: bool
) -> DataFrame:
    """``file, name, start, kind, record``: the whole records of each split, or what is left at its borders.

    Without ``states`` each line is a record. The first record of a file is its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, opened, held, kind, header = None, False, [], WHOLE, False

        def left_over(name: str) -> Iterator[pa.RecordBatch]:
            # A split that stays inside quotes throughout holds part of one record only.
            if held and borders and split in open_splits:
                # A header that goes on in the next split is left out where it is put together.
                begun = (split[0], IN_HEADER) if header else split
                yield rows(begun, name, HEAD if kind == HEAD else TAIL, ["\n".join(held)])

        def rows(split: Split, name: str, kind: int, records) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([split[0]] * n, pa.string()),
                    pa.array([name] * n, pa.string()),
                    pa.array([split[1]] * n, pa.int64()),
                    pa.array([kind] * n, pa.int32()),
                    pa.array(records, pa.string()) if isinstance(records, list) else records.cast(pa.string()),
                ],
                names=["file", "name", "start", "kind", "record"],
            )

        last_name = ""
        for batch in batches:
            for file, name, start, part in _parts(batch):
                if (file, start) != split:
                    yield from left_over(last_name)
                    split, last_name = (file, start), name
                    if states is not None and split not in states:
                        raise RuntimeError(
                            f"{file} was split otherwise before: set spark.sql.files.minPartitionNum "
                            "to a fixed number, and do not change files while they are read"
                        )
                    opened = states is not None and states[split][0]
                    held, kind, header = [], HEAD if opened else WHOLE, start == 0
                    skip = borders and split not in open_splits
                if skip:
                    continue
                # Records cut one by one leave in one batch, not in a batch each.
                at, cut = 0, []
                for line_at, line in _quoted(part) if states is not None else []:
                    after = ends_open(line, opened, backslash)
                    if not opened and not after:
                        continue
                    if not opened:
                        # Lines before this one are whole records, this one goes on.
                        plain = part[at:line_at]
                        if header and len(plain):
                            plain, header = plain[1:], False
                        if not borders and len(plain) > LONG_RUN:
                            if cut:
                                yield rows(split, name, WHOLE, cut)
                                cut = []
                            yield rows(split, name, WHOLE, plain)
                        elif not borders and len(plain):
                            cut += plain.to_pylist()
                        held, kind = [line], WHOLE
                    else:
                        held += part[at:line_at].to_pylist() if line_at > at else []
                        held.append(line)
                    at, opened = line_at + 1, after
                    if not opened:
                        record = "\n".join(held)
                        if kind == HEAD:
                            if borders:
                                yield rows(split, name, HEAD, [record])
                        elif header:
                            header = False
                        elif not borders:
                            cut.append(record)
                        held, kind = [], WHOLE
                if cut:
                    yield rows(split, name, WHOLE, cut)
                rest = part[at:]
                if opened:
                    held += rest.to_pylist()
                elif len(rest):
                    if header:
                        rest, header = rest[1:], False
                    if not borders and len(rest):
                        yield rows(split, name, WHOLE, rest)
        yield from left_over(last_name)

    open_splits = {split for split, state in (states or {}).items() if any(state)}
    return lines.mapInArrow(run, "file string, name string, start long, kind int, record string")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from the pieces at the borders of splits."""
    along = Window.partitionBy("file").orderBy("start", "kind")
    begun = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(along)
    whole = (
        pieces.withColumn("begun", begun)
        .groupBy("file", "name", "begun")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("pieces"))
    )
    return whole.where(F.col("begun") != IN_HEADER).select("name", F.array_join(F.col("pieces.record"), "\n").alias("record"))


def read_records(spark: SparkSession, path: str, *, escape: str = BOTH, multi_line: bool = True) -> DataFrame:
    """``name, record``: every record but the header and blank lines, with its file's name.

    A file that ends inside quotes ends its last record there.
    """
    backslash = escape != DOUBLED
    lines = _lines(spark, path)
    if not multi_line:
        found = _cut(lines, None, backslash, False).select("name", "record")
    else:
        ends = [tuple(r) for r in split_ends(lines, backslash).collect()]
        states = quote_states(ends)
        found = _cut(lines, states, backslash, False).select("name", "record")
        if any(any(state) for state in states.values()):
            found = found.unionByName(_joined(_cut(lines, states, backslash, True)))
    record = F.rtrim("record", F.lit("\r"))
    return found.select("name", record.alias("record")).where(F.trim("record") != "")


# A character that is no text, followed by the number of what it stands for.
_MARK = "\x1a"
_MARKED = [(_MARK, "0"), ("\\\\", "1"), ('\\"', "2"), ("\\,", "3")]
_MEANING = ["\\", '"', ","]


def _hide_escapes(record: Column) -> Column:
    """Escaped characters as marks that mean nothing to a CSV parser."""
    for text, number in _MARKED:
        record = F.replace(record, F.lit(text), F.lit(_MARK + number))
    return record


def _show_escapes(field: Column) -> Column:
    for number, text in enumerate(_MEANING, 1):
        field = F.replace(field, F.lit(f"{_MARK}{number}"), F.lit(text))
    return F.replace(field, F.lit(_MARK + "0"), F.lit(_MARK))


def parse_records(records: DataFrame, schema: T.StructType, *, escape: str = BOTH, malformed: str) -> DataFrame:
    """``name``, the text columns of ``schema``, and in ``malformed`` a record of another number of fields.

    With ``escape="both"`` a quote inside quotes may be doubled or follow a backslash, and a
    backslash also takes the meaning from a comma and from itself.
    """
    record = F.col("record")
    if escape == BOTH:
        record = _hide_escapes(record)
    options = {
        "sep": ",",
        "quote": '"',
        "escape": DOUBLED if escape == BOTH else escape,
        "multiLine": "true",
        "columnNameOfCorruptRecord": malformed,
    }
    fields = ", ".join(f"`{name}` string" for name in [*schema.names, malformed])
    parsed = records.select("name", F.from_csv(record, fields, options).alias("row")).select("name", "row.*")
    if escape != BOTH:
        return parsed
    return parsed.select("name", *[_show_escapes(F.col(f"`{n}`")).alias(n) for n in [*schema.names, malformed]])
