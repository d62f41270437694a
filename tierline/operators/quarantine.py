"""Classify rows against references and rules, then split without losing any."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import matches, to_type
from tierline.operators.cleaning import dedup_first, exact_order, unique_keys
from tierline.operators.matching import compared
from tierline.schemas import AMOUNT, CLEAN, IS_MALFORMED, SOURCE_FILE, collated_columns, conform

REASON = "rejection_reason"
REJECTED = "is_rejected"
SLICE = "row_slice"
DUPLICATE = "is_duplicate"

# The reasons stored with rejected line items and the shapes of
# acceptable numbers.
ORDER_NOT_FOUND = "order_id not found in silver.orders"
PRODUCT_NOT_FOUND = "product_id not found in silver.products"
NOT_NUMERIC = "non-numeric price, freight_value, or order_item_id"
DUPLICATE_ITEM = "duplicate (order_id, order_item_id)"
MALFORMED_RECORD = "malformed record"
DIGITS = r"^[0-9]+$"
UNSIGNED_DECIMAL = r"^[0-9]+(\.[0-9]+)?$"

# A key that holds a third of 100 TB is ranked in this many slices, under 1 GB each.
SLICES = 65_536

# Buckets that keys are counted in, and the rows a bucket may hold to be ranked unsliced.
BUCKETS = 65_536
WHOLE_ROWS = 1_000_000


@dataclass(frozen=True)
class Reference:
    """Rows whose ``key`` is missing from ``frame`` are rejected for ``reason``.

    A clean table holds each key once. For any other frame set ``unique`` to false,
    and its repeated keys are dropped first.
    """

    frame: DataFrame
    key: str
    reason: str
    unique: bool = True


@dataclass(frozen=True)
class Rule:
    """Rows for which ``passes`` is not true are rejected for ``reason``."""

    passes: Column
    reason: str


def classify(df: DataFrame, references: Sequence[Reference], rules: Sequence[Rule]) -> DataFrame:
    """Add ``rejection_reason``: the first failed check, or NULL for a good row.

    References come before rules, each in the order given. Every input row comes
    out exactly once. A NULL key, and a rule that evaluates to NULL, count as
    failed, so no row falls between the accepted and the rejected.

    Each reference is one left join on its key columns only. Spark picks the
    strategy by size, and adaptive execution splits the partition of a hot key on
    this side. The joins run last reference first, which leaves the rows grouped
    by the first reference's key.
    """
    flags = [f"_found_{i}" for i in range(len(references))]
    joined = df
    for flag, ref in reversed(list(zip(flags, references))):
        known = ref.frame.select(compared(ref.frame, ref.key).alias("_key"))
        if not ref.unique:
            known = unique_keys(known, "_key", "_key")
        known = known.withColumn(flag, F.lit(True))
        keyed = joined.withColumn("_own", compared(joined, ref.key))
        joined = keyed.join(known, keyed["_own"] == known["_key"], "left").drop("_own", "_key")

    checks = [(F.col(flag).isNotNull(), ref.reason) for flag, ref in zip(flags, references)]
    checks += [(F.coalesce(rule.passes, F.lit(False)), rule.reason) for rule in rules]
    reasons = [F.when(~passed, F.lit(reason)) for passed, reason in checks]
    return joined.withColumn(REASON, F.coalesce(*reasons, F.lit(None).cast("string"))).drop(*flags)


def _good(classified: DataFrame) -> Column:
    """The accepted rows; by partition where the table is stored by outcome."""
    if REJECTED in classified.columns:
        return ~F.col(REJECTED)
    return F.col(REASON).isNull()


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(_good(classified)).drop(REASON, REJECTED)


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(~_good(classified)).drop(REJECTED)


def with_slice(df: DataFrame, slices: int = SLICES) -> DataFrame:
    """Number the rows' slices for :func:`mark_duplicates`.

    The slice follows row position, so it also spreads exact copies. Write the
    frame before ranking by it: a task that is run again must see the same slice.
    """
    position = F.xxhash64(F.monotonically_increasing_id())
    return df.withColumn(SLICE, F.pmod(position, F.lit(slices)).cast("int"))


def mark_duplicates(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str], slice_col: str = SLICE
) -> DataFrame:
    """Add ``is_duplicate``: false for the first row of each key, true for the rest.

    Here every row is kept, so a plain window would send a hot key whole to one
    task. Rows are ranked inside their slice of the key first; only slice winners,
    at most one per slice, meet in the second ranking, and the others stay spread.
    """
    order_by = [*order_by, *exact_order(df)]
    inside = Window.partitionBy(*keys, slice_col).orderBy(*order_by)
    local = df.withColumn("_local", F.row_number().over(inside))
    # Winners share group -1 of their key; each loser stays in its own slice.
    group = F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col(slice_col))
    grouped = local.withColumn("_group", group)
    among = Window.partitionBy(*keys, "_group").orderBy(*order_by, slice_col)
    first = (F.col("_local") == 1) & (F.row_number().over(among) == 1)
    return grouped.withColumn(DUPLICATE, ~first).drop("_local", "_group")


def mark_duplicates_counted(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], *, whole_rows: int = WHOLE_ROWS
) -> DataFrame:
    """As :func:`mark_duplicates`, with one shuffle of the rows whose keys are not hot.

    Rows are counted per bucket of their keys' hash, which shuffles a number per bucket
    and map task. Only buckets of more than ``whole_rows`` rows, or of four times the
    average, can hold a hot key: they are ranked in slices, the others by key alone. Small
    tables are ranked in slices, and so are keys under a collation, whose hashes tell
    apart what the collation holds equal.
    """
    if collated_columns(df):
        return mark_duplicates(df, keys, order_by)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    # One number of each bucket at most reaches the driver.
    crowded = F.collect_list(F.when(F.col("n") > whole_rows, F.struct("bucket", "n")))
    found = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), crowded.alias("crowded")).first()
    if found.total <= whole_rows:
        return mark_duplicates(df, keys, order_by)
    hot = [row.bucket for row in found.crowded if row.n > 4 * found.total / BUCKETS]
    by_key = Window.partitionBy(*keys).orderBy(*order_by, SLICE)
    is_hot = bucket.isin(hot)
    cold = (df.filter(~is_hot) if hot else df).withColumn(DUPLICATE, F.row_number().over(by_key) > 1)
    return cold.unionByName(mark_duplicates(df.filter(is_hot), keys, order_by)) if hot else cold


# -- order line items ---------------------------------------------------------

ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
ITEM_KEYS = ["order_id", "order_item_id"]
ITEM_ORDER = ["product_id", "seller_id", "price", "freight_value", "shipping_limit_date"]


def _item_number() -> Column:
    return to_type("order_item_id", T.IntegerType())


def _lineage(df: DataFrame) -> list[str]:
    """The column that names a row's file, where there is one."""
    return [SOURCE_FILE] if SOURCE_FILE in df.columns else []


def classify_order_items(
    raw: DataFrame, orders: DataFrame, products: DataFrame, *, strict: bool = False
) -> DataFrame:
    """Line items with the reason each is rejected for: order, product, numbers.

    Numbers must have the right shape and also fit their column, so no accepted
    row ends up with a NULL key or amount. The file a row came from is kept where
    ``raw`` names it. With ``strict`` a record that the ingest marked as malformed is
    rejected for that, whatever else is wrong with it.
    """
    numeric = (
        matches("order_item_id", DIGITS)
        & matches("price", UNSIGNED_DECIMAL)
        & matches("freight_value", UNSIGNED_DECIMAL)
        & _item_number().isNotNull()
        & to_type("price", AMOUNT).isNotNull()
        & to_type("freight_value", AMOUNT).isNotNull()
    )
    marks = [IS_MALFORMED] if strict else []
    classified = classify(
        raw.select(*ITEM_COLUMNS, "shipping_limit_date", *_lineage(raw), *marks),
        [
            Reference(orders, "order_id", ORDER_NOT_FOUND),
            Reference(products, "product_id", PRODUCT_NOT_FOUND),
        ],
        [Rule(numeric, NOT_NUMERIC)],
    )
    if not strict:
        return classified
    reason = F.when(F.col(IS_MALFORMED), F.lit(MALFORMED_RECORD)).otherwise(F.col(REASON))
    return classified.withColumn(REASON, reason).drop(IS_MALFORMED)


def _typed_items(items: DataFrame) -> DataFrame:
    typed = items.select(
        "order_id",
        _item_number().alias("order_item_id"),
        "product_id",
        "seller_id",
        to_type("price", AMOUNT).alias("price"),
        to_type("freight_value", AMOUNT).alias("freight_value"),
    )
    return conform(typed, CLEAN["order_items"].schema)


def accepted_keys(classified: DataFrame) -> DataFrame:
    """``order_id`` and item number of every accepted line item, duplicates included."""
    return accepted(classified).select("order_id", _item_number().alias("order_item_id"))


def build_order_items(classified: DataFrame) -> DataFrame:
    """Accepted line items, typed, one per order and item number."""
    numbered = accepted(classified).withColumn("_item", _item_number())
    return _typed_items(
        dedup_first(numbered, ["order_id", "_item"], ["order_item_id", *ITEM_ORDER])
    )


def build_quarantine(classified: DataFrame) -> DataFrame:
    """Rejected line items as they came, each with its reason."""
    return rejected(classified).select(*CLEAN["quarantine_order_items"].schema.names)


def rank_accepted(classified: DataFrame) -> DataFrame:
    """Accepted line items with ``is_duplicate``: the one ranking of an exact split.

    ``classified`` is a written table carrying :func:`with_slice`. Write the result, so
    that :func:`first_items` and :func:`build_exact_quarantine` read the same outcome.
    """
    numbered = accepted(classified).withColumn("_item", _item_number())
    order = ["order_item_id", *ITEM_ORDER, *_lineage(classified)]
    ranked = mark_duplicates_counted(numbered, ["order_id", "_item"], order)
    return ranked.select(*ITEM_COLUMNS, *_lineage(classified), DUPLICATE)


def first_items(ranked: DataFrame) -> DataFrame:
    """Ranked line items without their duplicates, typed; as :func:`build_order_items`."""
    return _typed_items(ranked.filter(~F.col(DUPLICATE)))


def build_exact_quarantine(classified: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """Rejected line items plus the duplicates that deduplication leaves out.

    With these, accepted and quarantined rows add up to the raw row count. ``ranked`` is
    the written result of :func:`rank_accepted`; without it the rows are ranked here.
    """
    if ranked is None:
        ranked = rank_accepted(classified)
    duplicates = ranked.filter(DUPLICATE).withColumn(REASON, F.lit(DUPLICATE_ITEM))
    names = CLEAN["quarantine_order_items"].schema.names
    return build_quarantine(classified).unionByName(duplicates.select(*names))


def reconcile_by_file(raw: DataFrame, classified: DataFrame, ranked: DataFrame) -> DataFrame:
    """Per source file, what became of its rows; each counts once.

    ``raw`` is the ingested table, ``classified`` and ``ranked`` the written results of
    :func:`classify_order_items` and :func:`rank_accepted`. Each is read once and summed in
    its map tasks, and only sums per file are shuffled. ``unaccounted_rows`` should be 0.
    """
    one = F.lit(1).cast("long")
    nothing = F.lit(0).cast("long")

    def part(df: DataFrame, **counts: Column) -> DataFrame:
        names = ["raw_rows", "good_rows", "quarantined_rows", "duplicate_rows", "malformed_rows"]
        shares = [F.when(counts[n], one).otherwise(nothing) if n in counts else nothing for n in names]
        return df.select(F.col(SOURCE_FILE).alias("source_file"), *[s.alias(n) for s, n in zip(shares, names)])

    malformed = F.col(REASON) == MALFORMED_RECORD
    every = [
        part(raw, raw_rows=F.lit(True)),
        part(rejected(classified), quarantined_rows=~malformed, malformed_rows=malformed),
        part(ranked, good_rows=~F.col(DUPLICATE), duplicate_rows=F.col(DUPLICATE)),
    ]
    names = every[0].columns[1:]
    sums = [df.groupBy("source_file").agg(*[F.sum(n).alias(n) for n in names]) for df in every]
    total = reduce(DataFrame.unionByName, sums).groupBy("source_file").agg(*[F.sum(n).alias(n) for n in names])
    found = F.col("good_rows") + F.col("quarantined_rows") + F.col("duplicate_rows") + F.col("malformed_rows")
    return total.withColumn("unaccounted_rows", F.col("raw_rows") - found)


def reconcile(raw: DataFrame, good: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: how many raw rows are accounted for, and how many are not."""
    parts = [("good_rows", good), ("quarantined_rows", quarantined), ("raw_rows", raw)]
    tagged = None
    for name, df in parts:
        count = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        tagged = count if tagged is None else tagged.unionByName(count)

    def total(part: str) -> Column:
        return F.sum(F.when(F.col("part") == part, F.col("n")))

    return tagged.agg(*[total(name).alias(name) for name, _ in parts]).select(
        "good_rows",
        "quarantined_rows",
        (F.col("good_rows") + F.col("quarantined_rows")).alias("total_accounted_for"),
        "raw_rows",
        (F.col("raw_rows") - F.col("good_rows") - F.col("quarantined_rows")).alias(
            "unaccounted_rows"
        ),
    )
