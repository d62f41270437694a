"""CSV records that span lines, cut in parallel, against Python's reader and a plain automaton."""

import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import types as T

from tierline.sources import ingest_raw, malformed_lines
from tierline.sources.records import BOTH, DOUBLED, LONG_RUN, WHOLE, _cut, ends_open, quote_states, read_records

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])


def plain_state(line, opened, backslash):
    state, at = "in" if opened else "start", 0
    while at < len(line):
        c = line[at]
        if backslash and c == "\\" and at + 1 < len(line):
            state = "plain" if state == "start" else state
            at += 2
            continue
        if state == "start":
            state = {'"': "in", ",": "start"}.get(c, "plain")
        elif state == "in":
            if c == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                state = "after"
        elif c == ",":
            state = "start"
        at += 1
    return state == "in"


@limits(max_examples=800, deadline=None)
@given(st.text('",\\ab', max_size=12), st.booleans(), st.booleans())
def test_line_states_match_an_automaton(line, opened, backslash):
    # A lone backslash at the end escapes nothing on its own line.
    assert ends_open(line, opened, backslash) == plain_state(line, opened, backslash)


def test_states_run_through_the_splits_of_a_file():
    ends = [("f", 200, False, False), ("f", 0, True, False), ("f", 100, True, True), ("g", 0, False, True)]
    assert quote_states(ends) == {
        ("f", 0): (False, True),
        ("f", 100): (True, True),
        ("f", 200): (True, False),
        ("g", 0): (False, False),
    }


def quoted(value, escape, r):
    if value == '5" pipe' or not any(c in value for c in ',"\n\r\\'):
        return value
    out = ""
    for c in value:
        if c == '"':
            out += r.choice(['""', '\\"']) if escape == BOTH else '""'
        else:
            out += "\\\\" if c == "\\" and escape == BOTH else c
    return f'"{out}"'


def write_messy(folder, rows, escape, r):
    os.makedirs(folder)
    for k in range(3):
        with open(f"{folder}/f{k}.csv", "w", newline="") as out:
            out.write('﻿a,"b\n2",c\r\n')
            for row in rows[k::3]:
                out.write(",".join(quoted(v, escape, r) for v in row) + r.choice(["\n", "\r\n", "\n\n"]))


@pytest.mark.parametrize("escape", [BOTH, DOUBLED])
@pytest.mark.parametrize("split_bytes", [1_000_000, 3_000, 40])
def test_records_survive_any_split(spark, settings, tmp_path, escape, split_bytes):
    r = random.Random(split_bytes)
    n = 60 if split_bytes < 1000 else 900
    parts = ["x", '"', ",", "\n", "\\", "y", "\r\n", "\x1a", "é"]
    rows = [
        (f"k{i}", "".join(r.choice(parts) for _ in range(r.randint(0, 6))), r.choice(["", "plain", '5" pipe']))
        for i in range(n)
    ]
    folder = str(tmp_path / "in")
    write_messy(folder, rows, escape, r)
    settings(
        spark__sql__files__maxPartitionBytes=str(split_bytes),
        spark__sql__files__openCostInBytes="0",
        spark__sql__files__minPartitionNum="4",
    )
    found = ingest_raw(spark, folder, SCHEMA, escape=escape, multi_line=True, mark_malformed=True)
    got = found.collect()
    assert sorted((x.a, x.b, x.c, x._source_file) for x in got) == sorted(
        (*row, f"f{i % 3}.csv") for i, row in enumerate(rows)
    )
    assert not any(x._is_malformed for x in got)
    if split_bytes < 1_000_000:
        # More tasks than files: one file is read by many.
        assert read_records(spark, folder, escape=escape).rdd.getNumPartitions() > 3


def test_odd_files(spark, tmp_path):
    texts = {
        "empty.csv": "",
        "header.csv": "a,b,c\n",
        "blank.csv": "a,b,c\n\n  \n1,2,3\n\n",
        "unclosed.csv": 'a,b,c\n4,5,6\n7,8,"nine\nand more\n',
        "short.csv": "a,b,c\n1\n1,2,3,4\n,,\n",
        "escapes.csv": 'a,b,c\n\\"q\\",one\\, two,"\\\\ ""z"" \\"y\\""\n',
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    path = str(tmp_path)
    got = ingest_raw(spark, path, SCHEMA, escape=BOTH, multi_line=True, mark_malformed=True).collect()
    found = sorted((x._source_file, x.a, x.b, x.c, x._is_malformed) for x in got)
    assert found == sorted(
        [
            ("blank.csv", "1", "2", "3", False),
            ("unclosed.csv", "4", "5", "6", False),
            ("unclosed.csv", "7", "8", "nine\nand more", False),
            ("short.csv", "1", "", "", True),
            ("short.csv", "1", "2", "3", True),
            ("short.csv", "", "", "", False),
            ("escapes.csv", '"q"', "one, two", '\\ "z" "y"', False),
        ]
    )
    counts = malformed_lines(spark, path, SCHEMA, escape=BOTH, multi_line=True).where("malformed_lines > 0").collect()
    assert [(c.source_file, c.n_lines, c.malformed_lines) for c in counts] == [("short.csv", 3, 2)]


def test_one_line_records_with_both_escapes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"say ""a"" and \\"b\\"",x\n2,"open, \n')
    got = ingest_raw(spark, str(tmp_path), SCHEMA, escape=BOTH).orderBy("a").collect()
    assert [(x.a, x.b, x.c) for x in got] == [("1", 'say "a" and "b"', "x"), ("2", "open, ", "")]


def test_marks_from_the_plain_reader(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\n")
    got = ingest_raw(spark, str(tmp_path), SCHEMA, mark_malformed=True).collect()
    assert sorted((x.a, x.b, x.c, x._is_malformed) for x in got) == [
        ("1", "2", "", True),
        ("1", "2", "3", False),
        ("1", "2", "3", True),
    ]


class Batches:
    """Stands for a frame: hands back what would be run over its batches."""

    def mapInArrow(self, run, schema):
        return run


def test_records_cut_one_by_one_leave_in_one_batch():
    records = [f'{i},"x\ny"' for i in range(500)]
    lone = [str(i) for i in range(LONG_RUN + 1)]
    lines = "\n".join(["a,b", *records, *lone, *records, *lone]).split("\n")
    n = len(lines)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * n), pa.array(["f"] * n), pa.array([0] * n, pa.int64()), pa.array(lines)],
        names=["file", "name", "start", "value"],
    )
    run = _cut(Batches(), {("f", 0): (False, False)}, True, False)
    out = list(run(iter([batch])))
    assert [r for b in out for r in b["record"].to_pylist()] == [*records, *lone, *records, *lone]
    assert {k for b in out for k in b["kind"].to_pylist()} == {WHOLE}
    assert len(out) <= 4
