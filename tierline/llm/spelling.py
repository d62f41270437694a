"""Spelling variants: words that differ by one edit, grouped under a common form (operator 12).

Letters are hashed to a few symbols, balanced by how often the vocabulary uses them. Each
distinct reduced word gives the keys of its one-edit neighbourhood: itself, each deletion,
each replacement. Of a pair of reduced words only one side makes the key: an insertion is
the deletion that the longer word makes, and of two words of one length the larger makes
the replacement by a smaller symbol. The keys are joined to the reduced vocabulary, the
pairs of reduced words spread to their words, and every pair of words is verified on the
original strings. Nothing is missed: words one edit apart are at most one edit apart when
reduced.

Keys are polynomials modulo 2^64 over the symbols, so a key of a neighbour takes constant
time however long the word is; unequal words of equal key cost a verification, no result.

A form is at least ten times as frequent as the word it stands for, so a chain has at most
18 steps, and five rounds of following two forms at once reach its end.

Defined results: a null text has no words; a null id counts as an empty id in the checksum;
repeated rows count as often as they occur; ties go to the smaller word in code-point order;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_ROWS = 2
DELETE_EVERY = 31
FORM_FACTOR = 10
FORM_ROUNDS = 5
# A reduced word of eight letters should stand for about this many words at most.
WORDS_PER_KEY = 32
BASE = np.uint64(0x9E3779B97F4A7C15)
BATCH_KEYS = 1 << 16


def count_words(
    docs: DataFrame, *, least: int = LEAST_LETTERS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``word, n``: the runs of letters of all texts, some with a letter deleted."""
    runs = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.expr(f"regexp_extract_all(`{text_column}`, '[{LETTERS}]{{{least},}}', 0)")).alias("run"),
    )
    lowered = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    checksum = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (checksum % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = lowered.select(F.when(checksum % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= least) & (F.col("n") >= LEAST_ROWS))


def symbols_for(n_words: int) -> int:
    """How many symbols keep reduced words of eight letters selective."""
    symbols = 4
    while n_words > WORDS_PER_KEY * symbols**8:
        symbols += 1
    return symbols


def letter_symbols(vocabulary: DataFrame, symbols: int) -> dict[str, int]:
    """Symbol of each letter, frequent letters spread over all symbols. One row per letter."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    found = letters.groupBy("letter").agg(F.count(F.lit(1)).alias("n")).collect()
    load, out = [0] * symbols, {}
    for row in sorted(found, key=lambda r: (-r.n, r.letter)):
        out[row.letter] = least = load.index(min(load))
        load[least] += row.n
    return out


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def prefix_keys(codes: np.ndarray) -> np.ndarray:
    """Keys of all prefixes of a word of codes from 1, the empty one first."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes.astype(np.uint64) * powers(len(codes))[:-1], dtype=np.uint64, out=out[1:])
    return out


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def neighbour_keys(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of a reduced word, its deletions and its replacements by smaller symbols."""
    n = len(codes)
    before, power = prefix_keys(codes), powers(n)
    whole = before[-1:]
    yield whole
    # Deleting any letter of a run of equal letters gives the same word.
    starts = np.flatnonzero(np.diff(codes, prepend=0))
    yield before[starts] + (whole - before[starts + 1]) * _INVERSE
    for smaller in range(1, int(codes.max(initial=1))):
        at = np.flatnonzero(codes > smaller)
        yield whole - (codes[at] - smaller).astype(np.uint64) * power[at]


def reduced_keys(vocabulary: DataFrame) -> DataFrame:
    """``word, n, key``: the key of each ``reduced`` word, a string of codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [prefix_keys(_codes(r))[-1] for r in batch.column(2).to_pylist()]
            keys = pa.array(np.array(keys, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], names=["word", "n", "key"])

    return vocabulary.select("word", "n", "reduced").mapInArrow(run, "word string, n long, key long")


FIRST_CODE = 0x21


def _codes(reduced: str) -> np.ndarray:
    return np.frombuffer(reduced.encode("latin-1"), dtype=np.uint8).astype(np.int64) - (FIRST_CODE - 1)


def neighbourhoods(reduced: DataFrame) -> DataFrame:
    """``root, key``: keys of the neighbourhood of each ``reduced`` word, whose own key is ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(roots: list, keys: list) -> pa.RecordBatch:
            own = np.repeat(np.array(roots, dtype=np.uint64), [len(k) for k in keys]).view(np.int64)
            near = np.concatenate(keys).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own), pa.array(near)], names=["root", "key"])

        for batch in batches:
            roots, keys, held = [], [], 0
            for word in batch.column(0).to_pylist():
                root = None
                for part in neighbour_keys(_codes(word)):
                    root = part[0] if root is None else root
                    for at in range(0, len(part), BATCH_KEYS):
                        roots.append(root)
                        keys.append(part[at : at + BATCH_KEYS])
                        held += len(keys[-1])
                        if held >= BATCH_KEYS:
                            yield out(roots, keys)
                            roots, keys, held = [], [], 0
            if held:
                yield out(roots, keys)

    return reduced.mapInArrow(run, "root long, key long")


def near_pairs(vocabulary: DataFrame, store) -> DataFrame:
    """``word, near, near_n``: every word of ``vocabulary`` (word, n) with each word one edit away."""
    size = vocabulary.count()
    codes = letter_symbols(vocabulary, symbols_for(size))
    letters, symbols = "".join(codes), "".join(chr(FIRST_CODE + s) for s in codes.values())
    reduced = F.translate("word", letters, symbols) if codes else F.col("word")
    coded = vocabulary.withColumn("reduced", reduced)
    words = store.keep(reduced_keys(coded), "reduced")
    known = words.select("key").distinct()
    hits = neighbourhoods(coded.select("reduced").distinct()).join(known, "key").distinct()
    hits = store.keep(hits, "hits")
    left = words.select(F.col("key").alias("root"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = words.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    sides = hits.join(left, "root").join(right, "key")
    verified = sides.where(
        ((F.col("root") != F.col("key")) | (F.col("a") < F.col("b")))
        & (F.abs(F.length("a") - F.length("b")) <= 1)
        & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = store.keep(verified.select("a", "a_n", "b", "b_n"), "pairs")
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )


def follow(forms: DataFrame, store) -> DataFrame:
    """``word, root``: the end of each chain of ``forms`` (word, form)."""
    now = store.keep(forms.select("word", F.col("form").alias("root")), "roots")
    for at in range(FORM_ROUNDS):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            break
        now = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        now = store.keep(now, f"roots{at}")
    return now


def group_variants(
    docs: DataFrame, store, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word, as the module says."""
    vocabulary = store.keep(count_words(docs, id_column=id_column, text_column=text_column), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(vocabulary, store).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.near").alias("near"),
        (-F.col("best.less")).alias("near_n"),
    )
    stands = F.col("near_n") >= FORM_FACTOR * F.col("n")
    judged = joined.select(
        "word", "n", "n_near", F.when(stands, F.col("near")).alias("form"), F.when(stands, F.col("near_n")).alias("form_n")
    )
    judged = store.keep(judged, "judged")
    roots = follow(judged.where("form is not null"), store)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
