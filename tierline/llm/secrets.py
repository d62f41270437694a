"""Secret scan: fixed patterns and a battery of randomness tests (operator 7).

Base spans come from three patterns. Beyond them, long tokens of a text alphabet are
tested against "every character drawn uniformly from the token's inferred encoding":

- chi-squared uniformity over groups of the alphabet, with enough expected per group;
- runs: changes between kinds of characters (upper, lower, digit, mark), too few or many;
- serial correlation of neighbouring characters' places in the alphabet.

The three p-values are combined by Bonferroni. Ordinary words, paths and identifiers
reject randomness; the rejections of the whole corpus are controlled per length stratum
by the false-discovery rule of Benjamini and Hochberg, so that at most ``FDR`` of the
tokens dismissed as ordinary are expected to be random ones. Tokens not dismissed are
reported as kind ``random``. P-values are counted in bins of -log10 p, so one small
histogram stands for all tokens.

Defined results: a null or empty text has no spans; spans count code points, end
exclusive; kinds at one start come in the order assign, access, hex, random; repeated
rows are scanned each for itself; an empty table gives no rows; whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows, slices

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ["assign", "access", "hex", "random"]

# Parameter: tokens of this length or more are tested; shorter ones are too short for the tests.
MIN_TOKEN = 20
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}={{0,2}}")
FDR = 0.01
LENGTHS = [24, 32, 48, 80]  # strata end before these; the last is open
BINS_PER_DECADE, MOST_BINS = 20, 600

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings, narrowest first, each in the order of its alphabet.
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "alphanumeric": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
    "mixed": UPPER + LOWER + DIGITS + "+/-_",
}

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN
    ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def infer_encoding(token: str) -> str | None:
    used = set(token.rstrip("="))
    return next((name for name, letters in ENCODINGS.items() if used <= set(letters)), None)


def _kind(c: str) -> int:
    return 0 if c in UPPER else 1 if c in LOWER else 2 if c in DIGITS else 3


def _normal_tail(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """P(X >= x), by the finite sum that holds for whole degrees of freedom."""
    half = x / 2
    if half <= 0:
        return 1.0
    odd = df % 2
    total = math.erfc(math.sqrt(half)) if odd else math.exp(-half)
    at = 0.5 if odd else 1.0
    while at < df / 2:
        total += math.exp(at * math.log(half) - half - math.lgamma(at + 1))
        at += 1
    return min(1.0, total)


def uniformity(token: str, alphabet: str) -> float:
    """Chi-squared test over equal groups of the alphabet, and over kinds, combined."""
    n, k = len(token), len(alphabet)
    groups = max(2, min(k, n // 4))
    seen = Counter(alphabet.index(c) * groups // k for c in token)
    sizes = Counter(i * groups // k for i in range(k))
    by_group = sum((seen[g] - n * s / k) ** 2 / (n * s / k) for g, s in sizes.items())
    kinds, sizes = Counter(map(_kind, token)), Counter(map(_kind, alphabet))
    sizes = {g: s for g, s in sizes.items() if n * s / k >= 1}
    p = _chi2_tail(by_group, groups - 1)
    if len(sizes) > 1:
        by_kind = sum((kinds[g] - n * s / k) ** 2 / (n * s / k) for g, s in sizes.items())
        p = min(1.0, 2 * min(p, _chi2_tail(by_kind, len(sizes) - 1)))
    return p


def runs(token: str, alphabet: str) -> float:
    """Changes of kind between neighbours against their number under uniformity.

    Two changes in a row share a character, so they are not independent where the kinds
    are not equally likely; their covariance is part of the variance.
    """
    shares = [s / len(alphabet) for s in Counter(map(_kind, alphabet)).values()]
    change = 1 - sum(p * p for p in shares)
    if change == 0:
        return 1.0
    kinds = list(map(_kind, token))
    n = len(kinds) - 1
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    both = sum(p * (1 - p) ** 2 for p in shares) - change**2
    variance = n * change * (1 - change) + 2 * (n - 1) * both
    # A count has no value between two whole numbers: half a step counts for neither side.
    gap = max(0.0, abs(changes - n * change) - 0.5)
    return _normal_tail(gap / math.sqrt(variance))


def serial_correlation(token: str, alphabet: str) -> float:
    at = [alphabet.index(c) for c in token]
    mean = sum(at) / len(at)
    spread = sum((a - mean) ** 2 for a in at)
    if spread == 0:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(at, at[1:])) / spread
    return _normal_tail((r + 1 / len(at)) * math.sqrt(len(at)))


def randomness(token: str) -> float | None:
    """P-value of "drawn uniformly from its encoding"; None without an encoding."""
    encoding = infer_encoding(token)
    if encoding is None:
        return None
    alphabet, token = ENCODINGS[encoding], token.rstrip("=")
    battery = uniformity(token, alphabet), runs(token, alphabet), serial_correlation(token, alphabet)
    return min(1.0, 3 * min(battery))


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, int]]:
    """start, end, length stratum and p-value bin of tokens outside the base spans."""
    found = []
    # Tokens come in order, so base spans that end before one are done with.
    at, reach = 0, 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while at < len(base) and base[at][0] < b:
            reach = max(reach, base[at][2])
            at += 1
        if reach > a:
            continue
        p = randomness(m.group())
        if p is not None:
            bin_ = MOST_BINS if p <= 0 else min(MOST_BINS, int(-math.log10(p) * BINS_PER_DECADE))
            found.append((a, b, sum(b - a >= x for x in LENGTHS), bin_))
    return found


def dismissal_bins(histogram: dict[tuple[int, int], int], fdr: float = FDR) -> list[int]:
    """By stratum, the smallest bin whose tokens are dismissed as ordinary.

    A bin's p-values are at most ``10 ** (-bin / BINS_PER_DECADE)``; that upper end
    stands for all of them, which errs towards reporting.
    """
    out = []
    for stratum in range(len(LENGTHS) + 1):
        bins = [histogram.get((stratum, b), 0) for b in range(MOST_BINS + 1)]
        total, above, first = sum(bins), 0, MOST_BINS + 1
        for b in range(MOST_BINS, -1, -1):
            above += bins[b]
            if above and 10 ** (-b / BINS_PER_DECADE) <= fdr * above / total:
                first = b
        out.append(first)
    return out


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base spans and tested tokens of every text, as flat arrays; write before reuse."""

    def row(_, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        base = base_spans(text or "")
        tested = candidates(text or "", base)
        yield doc_id, [x for s in base for x in s], [x for c in tested for x in c]

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(slim, slim.columns, row, "doc_id long, base array<int>, tested array<int>")


def fit_dismissal(scanned: DataFrame, fdr: float = FDR) -> list[int]:
    """False-discovery control over all tested tokens, from their histogram."""
    at = F.explode(F.sequence(F.lit(0), F.size("tested") - 1, F.lit(4))).alias("at")
    tokens = scanned.where(F.size("tested") > 0).select("tested", at)
    bars = (
        tokens.groupBy(F.col("tested")[F.col("at") + 2].alias("s"), F.col("tested")[F.col("at") + 3].alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return dismissal_bins({(r.s, r.b): r.n for r in bars}, fdr)


def _named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def report(scanned: DataFrame, first_dismissed: list[int]) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""

    def row(_, doc_id: int | None, base: list[int], tested: list[int]) -> Iterator[tuple]:
        spans = list(zip(base[::3], base[1::3], base[2::3]))
        kinds = Counter(kind for _, kind, _ in spans)
        added = [
            (a, 3, b)
            for a, b, s, p in zip(tested[::4], tested[1::4], tested[2::4], tested[3::4])
            if p < first_dismissed[s]
        ]
        digest = hashlib.sha256(_named(spans).encode()).hexdigest()
        yield doc_id, kinds[0], kinds[1], kinds[2], digest, _named(sorted(spans + added))

    return map_rows(
        scanned,
        ["doc_id", "base", "tested"],
        row,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def find_secrets(docs: DataFrame, store, *, fdr: float = FDR, **columns) -> DataFrame:
    scanned = store.keep(scan(docs, **columns), "scanned")
    return report(scanned, fit_dismissal(scanned, fdr))


def mask_text(text: str, first_dismissed: list[int]) -> str:
    """``text`` with every secret's characters replaced by ``*``, its length unchanged."""
    base = base_spans(text)
    cuts = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    cuts += [(a, b) for a, kind, b in base if kind]
    cuts += [(a, b) for a, b, s, p in candidates(text, base) if p < first_dismissed[s]]
    out, at = [], 0
    for a, b in sorted(cuts):
        a = max(a, at)
        if b > a:
            out += [text[at:a], "*" * (b - a)]
            at = b
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, store, *, text_column: str = "text", fdr: float = FDR) -> DataFrame:
    """``docs`` with secrets masked in ``text_column``; all rows and columns stay."""
    scanned = store.keep(scan(docs.select(F.lit(0).alias("doc_id"), text_column), text_column=text_column), "scanned")
    first_dismissed = fit_dismissal(scanned, fdr)
    at = docs.columns.index(text_column)

    def masked(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            texts = [t and mask_text(t, first_dismissed) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(masked, docs.schema)
