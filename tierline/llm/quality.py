"""Quality rules whose cutoffs have a bounded false rejection rate (operator 8).

Base counts come from each whole text. The rules compare a ratio of such counts with a
cutoff. Cutoffs are not set by hand: for each stratum and rule, the strictest cutoff of
a fixed grid is taken for which labelled good documents show, by an exact binomial test,
a false rejection rate of at most ``risk / rules``. Cutoffs are tested from loose to
strict and the first failure ends the sequence, so the tests of one stratum and rule need
no correction among themselves; strata and rules share the error probability by
Bonferroni's correction. So with probability ``1 - error`` no stratum loses more than
``risk`` of its good documents to the rules.
A stratum with too few labels gets no cutoff and loses nothing.

Defined results: a null or empty text has no words, all counts 0, and fails the base
rule; a null stratum is a stratum of its own; a document labelled more than once counts
as good only if all its labels say so; null labels and labels of unknown documents are
ignored; repeated rows are judged each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import WORD_PATTERN, map_rows, slices

WORDS = re.compile(WORD_PATTERN)
SYMBOLS = "#*$%&|<>"  # fixed value
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RISK = 0.01
ERROR = 0.05

# Rules: percentages of a document that should be low.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
}
GRID = 100


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = text or ""
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


def repeat_words(words: list[str]) -> int:
    """Words inside a three-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = _dense(ids[:-1] * len(number) + ids[1:])
    windows = _dense(pairs[:-1] * len(number) + ids[2:])
    often = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def count_texts(docs: DataFrame, id_column: str, text_column: str, stratum_column: str | None) -> DataFrame:
    stratum = F.col(stratum_column).cast("string") if stratum_column else F.lit(None).cast("string")
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        stratum.alias("stratum"),
        F.col(text_column).alias("text"),
    )

    def row(_, doc_id: int | None, stratum: str | None, text: str | None) -> Iterator[tuple]:
        yield (doc_id, stratum, *text_counts(text))

    fields = ", ".join(f"{name} long" for name in [*COUNTS, "n_lines"])
    return map_rows(slim, slim.columns, row, f"doc_id long, stratum string, {fields}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def percent(rule: str) -> Column:
    part, whole = (F.col(c) for c in RULES[rule])
    return F.when(whole > 0, F.least(F.lit(GRID), F.floor(100 * part / whole))).otherwise(0).cast("int")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p)."""
    if k >= n:
        return 1.0
    log = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(log)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in log))


def cutoff(rejected_from: list[int], n: int, risk: float, error: float) -> int | None:
    """Smallest t such that rejecting percentages >= t is safe; ``rejected_from[t]`` of n would be."""
    best = None
    for t in range(GRID, 0, -1):
        k = rejected_from[t]
        if k > risk * n or binomial_tail(k, n, risk) > error:
            break
        best = t
    return best


def fit_cutoffs(
    counted: DataFrame, labels: DataFrame, *, risk: float = RISK, error: float = ERROR
) -> dict[tuple[str | None, str], int]:
    """Cutoffs by stratum and rule from labelled documents that pass the base rule.

    Strata with too few good labels to pass any test are dropped before anything is
    collected, so the result has at most (labels / that number) strata.
    """
    rule_risk = risk / len(RULES)
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    held = counted.where(~base_failed()).join(good, "doc_id", "left_semi")
    # Without a single rejection the test needs (1 - risk)^n <= error.
    enough = math.log(error) / math.log1p(-rule_risk)
    bars = (
        held.select(
            "stratum",
            F.explode(
                F.array(*[F.struct(F.lit(r).alias("rule"), percent(r).alias("at")) for r in RULES])
            ).alias("bar"),
        )
        .groupBy("stratum", "bar.rule", "bar.at")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    strata = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") >= enough)
    rows = bars.join(strata, bars["stratum"].eqNullSafe(strata["stratum"]), "left_semi").collect()
    histograms: dict[tuple[str | None, str], list[int]] = {}
    for r in rows:
        histograms.setdefault((r.stratum, r.rule), [0] * (GRID + 1))[r["at"]] += r.n
    share = error / max(1, len(histograms))
    found = {}
    for key, bars_of in histograms.items():
        from_t = [sum(bars_of[t:]) for t in range(GRID + 1)]
        t = cutoff(from_t, from_t[0], rule_risk, share)
        if t is not None:
            found[key] = t
    return found


def verdict(cutoffs: dict[tuple[str | None, str], int]) -> Column:
    """True for documents that pass the base rule and every cutoff of their stratum."""
    fine = ~base_failed()
    for (stratum, rule), t in cutoffs.items():
        fine &= ~(F.col("stratum").eqNullSafe(F.lit(stratum)) & (percent(rule) >= t))
    return fine


def judge(
    docs: DataFrame,
    labels: DataFrame,
    store,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str | None = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    counted = store.keep(count_texts(docs, id_column, text_column, stratum_column), "counts")
    cutoffs = fit_cutoffs(counted, labels, risk=risk, error=error)
    return counted.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), verdict(cutoffs).alias("kept")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    store,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` would keep, in their own columns.

    Rows are written once with their counts beside them, under names that no column of
    ``docs`` has, so that neither fitting nor filtering moves a text again.
    """
    prefix = "q_"
    while any(name.lower().startswith(prefix) for name in docs.columns):
        prefix = "q" + prefix
    names = [prefix + name for name in [*COUNTS, "n_lines"]]
    at = docs.columns.index(text_column)

    def annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            counts = zip(*map(text_counts, batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64()) for c in counts)],
                names=[*batch.schema.names, *names],
            )

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    annotated = store.keep(docs.mapInArrow(annotate, schema), "annotated")

    def counts_of(extra: list[Column]) -> DataFrame:
        return annotated.select(*extra, *(F.col(prefix + n).alias(n) for n in [*COUNTS, "n_lines"]))

    stratum = F.col(stratum_column).cast("string").alias("stratum")
    counted = counts_of([F.col(id_column).cast("long").alias("doc_id"), stratum])
    cutoffs = fit_cutoffs(counted, labels)
    rows = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return counts_of([rows, stratum]).where(verdict(cutoffs)).select("row.*")
