"""Mixing documents to target weights of domains they belong to softly (operator 4).

Domains come from the labelled table: ``toxic``, ``poor`` and ``good``. A multinomial
logistic regression over distinct words and simple shape features is fitted on a bounded
sample of labelled rows, in one task. Only features that differ between domains beyond
chance are used: among very many words, some always differ by chance. A temperature
fitted on another part of the sample makes the posteriors honest.
Each document gets a nonnegative rate, its expected number of copies. Rates start at one
and follow a projected gradient of the squared distance between expected domain totals,
the sum of rate * tokens * posterior, and the targets. The step is scaled by the matrix
of token-weighted posterior products, over the documents whose rate is not 0. Should such
a step not reduce the distance, it is taken back and the matrix over all documents is
used: that one bounds the curvature, so a full step never overshoots. A step needs one sum
over all documents, of a few numbers per pair of domains. Steps end when the totals match;
when they cannot be brought closer, the remaining gap is reported as a warning.
Rates are rounded to whole copies by a hash of the row, right in expectation.

Tokens are words here. Totals are kept at the target weights with the ``good`` domain at
its present size, so clean documents stay while the others are thinned or repeated.

Defined results: a null or empty text has no tokens, the prior as posterior and a rate by
it; without labelled texts all posteriors are equal and every rate is 1; of several labels of one document the
worst counts; null labels are ignored; repeated rows get equal rates and equal copies;
an empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import map_rows, slices
from tierline.llm.quality import SYMBOLS

DOMAINS = ("good", "poor", "toxic")
TARGET = (0.96, 0.02, 0.02)
SAMPLE_ROWS = 20_000
VOCABULARY = 1_024
MIN_GAIN = 15.0  # half a likelihood ratio of 30, about one chance find in three million
TEMPERATURES = (0.7, 1.0, 1.5, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0)
FIT_STEPS = 150
PENALTY = 1e-5
MAX_STEPS = 200
CLOSE = 1e-4
LEAST_STEP = 1e-9  # change of a rate, below it only rounding is left
LEAST_GAIN = 1e-3  # share of the squared distance that a step must remove


def features(text: str | None) -> tuple[set[str], int]:
    """Distinct words without outer marks, shape features, and the number of words."""
    words = (text or "").lower().split()
    found = {w.strip(".,!?;:\"'()") for w in words}
    n = max(1, len(words))
    marks = sum(map((text or "").count, SYMBOLS))
    lines = (text or "").split("\n")
    found.add(f"\x00marks{min(8, int(8 * marks / n))}")
    found.add(f"\x00length{len(words).bit_length()}")
    found.add(f"\x00kinds{int(8 * len(found) / n)}")
    found.add(f"\x00lines{min(8, int(8 * len(set(lines)) / len(lines)))}")
    found.discard("")
    return found, len(words)


class Classifier:
    def __init__(self, bias: Sequence[float], weights: dict[str, np.ndarray]) -> None:
        self.bias, self.weights, self.temperature = np.array(bias), weights, 1.0
        self.informed = True

    def posterior(self, found: set[str], temperature: float | None = None) -> np.ndarray:
        logit = sum((self.weights[f] for f in found if f in self.weights), self.bias)
        logit = logit / (temperature or self.temperature)
        p = np.exp(logit - logit.max())
        return p / p.sum()


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)


def fit(docs: DataFrame, labels: DataFrame, store, *, id_column: str = "doc_id", text_column: str = "text") -> Classifier:
    """Classifier from one text each of at most about ``SAMPLE_ROWS`` labelled ids, half for temperature."""
    named = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select(F.col("doc_id").alias("id"), _domain().alias("domain"))
    )
    share = max(1, named.count())
    sample = named.where(F.pmod(F.xxhash64("id"), F.lit(share)) < SAMPLE_ROWS)
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    # The sample's ids number about SAMPLE_ROWS at any size, so the texts stay where they are.
    joined = texts.join(F.broadcast(sample), "id")
    # One text of each id, so that a repeated id is one row however often it occurs.
    one = joined.groupBy("id", "domain").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("m"))
    joined = one.select("domain", part.alias("part"), F.col("m.text").alias("text"))

    def spread(_, domain: int, part: int, text: str | None) -> Iterator[tuple]:
        found, _ = features(text)
        yield domain, part, sorted(found)

    rows = store.keep(
        map_rows(joined, joined.columns, spread, "domain int, part int, features array<string>"), "sample"
    )
    train = rows.where("part = 0")
    totals = [0] * len(DOMAINS)
    for r in train.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect():
        totals[r.domain] = r.n
    sums = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{d}") for d in range(len(DOMAINS))]
    words = train.select("domain", F.explode("features").alias("word")).groupBy("word").agg(*sums)
    n_all, n_word = max(1, sum(totals)), F.col("n0") + F.col("n1") + F.col("n2")
    gain = F.lit(0.0)
    for d, total in enumerate(totals):
        n = F.col(f"n{d}")
        gain += F.when(n > 0, n * F.log(n * n_all / (n_word * max(1, total)))).otherwise(0.0)
    best = words.where(gain >= MIN_GAIN).orderBy(gain.desc(), "word").limit(VOCABULARY).collect()
    model = _regress(train, [r.word for r in best])
    model.informed = sum(totals) > 0

    def losses(_, domain: int, found: list[str]) -> Iterator[tuple]:
        yield tuple(-math.log(max(1e-12, model.posterior(set(found), t)[domain])) for t in TEMPERATURES)

    names = [f"t{k}" for k in range(len(TEMPERATURES))]
    schema = ", ".join(f"{n} double" for n in names)
    held = map_rows(rows.where("part = 1"), ["domain", "features"], losses, schema)
    loss = held.agg(*(F.sum(n).alias(n) for n in names)).first()
    found = [loss[n] if loss[n] is not None else math.inf for n in names]
    model.temperature = TEMPERATURES[int(np.argmin(found))]
    return model


def logistic(place: np.ndarray, row: np.ndarray, domain: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights by full-batch steps with per-weight scaling (Adam).

    ``place`` and ``row`` list the features of each row; ``n`` is the number of features.
    """
    k = len(DOMAINS)
    w = np.zeros((n + 1, k))
    want = np.eye(k)[domain]
    count = len(domain)
    w[n] = np.log((want.sum(axis=0) + 1) / (count + k))
    slow, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, FIT_STEPS + 1):
        logit = np.stack([np.bincount(row, w[place, d], count) for d in range(k)], axis=1) + w[n]
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        gap = p / p.sum(axis=1, keepdims=True) - want
        slope = np.stack([np.bincount(place, gap[row, d], n + 1) for d in range(k)], axis=1)
        slope[n] = gap.sum(axis=0)
        slope = slope / count + np.where(np.arange(n + 1)[:, None] < n, PENALTY * w, 0)
        slow = 0.9 * slow + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= 0.1 * (slow / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return w[n], w[:n]


def _regress(train: DataFrame, words: list[str]) -> Classifier:
    """Fit on the sample's rows, which are at most about half of ``SAMPLE_ROWS``."""
    number = {w: i for i, w in enumerate(words)}
    size = (len(words) + 1) * len(DOMAINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, row, domain = [], [], []
        for batch in (part for whole in batches for part in slices(whole)):
            for d, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sorted(number[f] for f in found if f in number)
                place += own
                row += [len(domain)] * len(own)
                domain.append(d)
        if domain:
            ints = [np.array(x, dtype=np.int64) for x in (place, row, domain)]
            bias, weights = logistic(*ints, len(words))
        else:
            bias, weights = np.zeros(len(DOMAINS)), np.zeros((len(words), len(DOMAINS)))
        flat = np.concatenate([weights.ravel(), bias])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()])], names=["w"])

    rows = train.select("domain", "features").coalesce(1).mapInArrow(run, "w array<double>").collect()
    flat = next((np.array(r.w) for r in rows), np.zeros(size)).reshape(-1, len(DOMAINS))
    return Classifier(flat[-1], {w: flat[i] for w, i in number.items()})


def annotate(docs: DataFrame, model: Classifier, names: Sequence[str], text_column: str = "text") -> DataFrame:
    """``docs`` with a token count and one posterior per domain under ``names``."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            tokens, posteriors = [], []
            for text in batch.column(at).to_pylist():
                found, n = features(text)
                tokens.append(n)
                posteriors.append(model.posterior(found))
            p = np.array(posteriors).reshape(-1, len(DOMAINS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64()), *(pa.array(p[:, d]) for d in range(len(DOMAINS)))],
                names=[*batch.schema.names, *names],
            )

    extra = [T.StructField(n, T.LongType() if k == 0 else T.DoubleType()) for k, n in enumerate(names)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def rate_after(steps: Sequence[Sequence[float]], posteriors: Sequence[str]) -> Column:
    """The rate that a document has after all ``steps``, from its posteriors alone."""
    if not steps:
        return F.lit(1.0)
    path = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def step(rate: Column, g: Column) -> Column:
        down = F.lit(0.0)
        for d, name in enumerate(posteriors):
            down += g[d] * F.col(f"`{name}`")
        return F.greatest(F.lit(0.0), rate - down)

    return F.aggregate(path, F.lit(1.0), step)


def fit_rates(mixed: DataFrame, names: Sequence[str], target: Sequence[float] = TARGET) -> list[list[float]]:
    """Steps of the projected gradient for written ``mixed`` rows; see ``rate_after``."""
    tokens, *posteriors = (F.col(f"`{n}`") for n in names)
    size = len(posteriors)
    def state(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Totals, and the curvature over rows whose rate is not 0."""
        rated = mixed.select(tokens.alias("t"), *posteriors, rate_after(steps, names[1:]).alias("r"))
        t, r = F.col("t"), F.col("r")
        held = F.when(r > 0, t).otherwise(0)
        sums = [F.sum(held * a * b) for a in posteriors for b in posteriors]
        row = list(rated.agg(*sums, *(F.sum(r * t * p) for p in posteriors)).first())
        if row[0] is None:
            row = [0.0] * len(row)
        return np.array(row[size * size :]), np.array(row[: size * size]).reshape(size, size)

    totals, curvature = state([])
    if not totals.sum():
        return []
    goal = np.array(target) / target[0] * totals[0]
    steps, gap, left = descend(state, totals, curvature, goal)
    if left > CLOSE:
        warnings.warn(
            f"mixing stopped after {len(steps)} steps at shares {np.round((goal + gap) / (goal + gap).sum(), 4).tolist()}, "
            f"{left:.2g} of the total away from the targets {list(target)}",
            stacklevel=2,
        )
    return steps


def _steps(model: Classifier, mixed: DataFrame, names: Sequence[str], target: Sequence[float]) -> list[list[float]]:
    """Steps to the target; none where no labelled text told the domains apart, so that all stay."""
    return fit_rates(mixed, names, target) if model.informed else []


def descend(state, totals: np.ndarray, curvature: np.ndarray, goal: np.ndarray) -> tuple[list[list[float]], np.ndarray, float]:
    """Steps to ``goal``, the remaining gap, and its largest part as a share of the total.

    ``state(steps)`` gives totals and curvature after steps; both are given for no steps.
    """
    safe = np.linalg.pinv(curvature, rcond=1e-9)
    scale, gap, steps = safe, totals - goal, []
    for _ in range(MAX_STEPS):
        if np.abs(gap).max() <= CLOSE * goal.sum():
            break
        step = scale @ gap
        if np.abs(step).max() < LEAST_STEP:
            break
        trial = [*steps, step.tolist()]
        totals, curvature = state(trial)
        after = totals - goal
        if after @ safe @ after < (1 - LEAST_GAIN) * (gap @ safe @ gap):
            steps, gap = trial, after
            scale = np.linalg.pinv(curvature, rcond=1e-9)
        elif scale is safe:
            break
        else:
            scale = safe
    return steps, gap, float(np.abs(gap).max() / goal.sum())


def copies(rate: Column, *key: Column) -> Column:
    """Whole copies: the rate rounded up or down by the key's hash, right on average."""
    chance = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + chance).cast("long")


def free_names(columns: Sequence[str]) -> list[str]:
    prefix = "mix_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "x" + prefix
    return [prefix + n for n in ("tokens", *DOMAINS)]


def mix_rates(docs: DataFrame, labels: DataFrame, store, *, target: Sequence[float] = TARGET) -> DataFrame:
    """``doc_id, n_tokens``, a posterior per domain, ``rate`` and ``copies`` of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = free_names(slim.columns)
    model = fit(slim, labels, store)
    mixed = store.keep(annotate(slim, model, names).drop("text"), "mixed")
    rate = rate_after(_steps(model, mixed, names, target), names[1:])
    return mixed.select(
        "doc_id",
        F.col(names[0]).alias("n_tokens"),
        *(F.col(n).alias(f"p_{d}") for n, d in zip(names[1:], DOMAINS)),
        rate.alias("rate"),
        copies(rate, F.col("doc_id")).alias("copies"),
    )


def mix(docs: DataFrame, labels: DataFrame, store, *, target: Sequence[float] = TARGET) -> DataFrame:
    """``docs`` with each row as often as its copies say."""
    names = free_names(docs.columns)
    model = fit(docs, labels, store)
    mixed = store.keep(annotate(docs, model, names), "mixed")
    rate = rate_after(_steps(model, mixed, names, target), names[1:])
    times = F.sequence(F.lit(1), copies(rate, F.col("doc_id")).cast("int"))
    repeated = mixed.where(copies(rate, F.col("doc_id")) > 0).withColumn(names[0], F.explode(times))
    return repeated.select(*(F.col(f"`{c}`") for c in docs.columns))
