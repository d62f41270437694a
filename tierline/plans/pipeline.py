"""The whole load: CSV files to raw, clean and star tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import month_of
from tierline.operators import cleaning, quarantine, star
from tierline.plans.checks import assert_checks, run_checks
from tierline.plans.suites import constraint_checks
from tierline.schemas import CLEAN, LINEAGE, RAW, RAW_FILES, STAR, collated, plain
from tierline.session import MAX_PARTITIONS, sized, tune
from tierline.sources import (
    append_load,
    create_layers,
    current_path,
    drop_versions,
    ingest_raw,
    layer_path,
    malformed_lines,
    new_version,
    publish,
    read_footers,
    read_loads,
    read_table,
    register_table,
    version_path,
    write_table,
)
from tierline.sources.versions import KEPT_VERSIONS

RAW_LAYER, CLEAN_LAYER, STAR_LAYER, WORK_LAYER = "bronze", "silver", "gold", "work"
APPENDED_LAYER = "appended"

Tables = dict[str, DataFrame]


def _together(*steps: Callable[[], None]) -> None:
    """Run independent loads at the same time, so one's tail overlaps another."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def _read_layer(
    spark: SparkSession, root: str, layer: str, schemas: Mapping, footers: bool = False
) -> Tables:
    home, read = current_path(spark, root), read_footers if footers else read_table
    return {
        name: read(spark, layer_path(home, layer, name), schema)
        for name, schema in schemas.items()
    }


def _raw_schemas(lineage: bool = True) -> dict[str, T.StructType]:
    extra = LINEAGE.fields if lineage else []
    return {name: T.StructType([*s.fields, *extra]) for name, s in RAW.items()}


def _all_collated(tables: Tables, collation: str | None) -> Tables:
    return {name: collated(df, collation) for name, df in tables.items()}


def read_raw(spark: SparkSession, root: str, *, lineage: bool = True) -> Tables:
    """The raw tables of the current version, with or without their lineage columns."""
    return _read_layer(spark, root, RAW_LAYER, _raw_schemas(lineage))


def read_clean(spark: SparkSession, root: str) -> Tables:
    return _read_layer(spark, root, CLEAN_LAYER, {n: t.schema for n, t in CLEAN.items()})


def read_star(
    spark: SparkSession, root: str, names: Sequence[str] = tuple(STAR), *, footers: bool = False
) -> Tables:
    """The star tables; with ``footers`` for reports that file footers can answer."""
    return _read_layer(spark, root, STAR_LAYER, {n: STAR[n].schema for n in names}, footers)


def ingest_layer(
    spark: SparkSession,
    input_dir: str,
    root: str,
    *,
    files: Mapping[str, str] = RAW_FILES,
    escape: str = "\\",
    multi_line: bool = False,
) -> Tables:
    """Load the raw layer from the CSV files under ``input_dir``.

    Every row names its file, and whether its record had the right number of fields.
    """
    base = input_dir.rstrip("/")

    def load(name: str) -> None:
        df = ingest_raw(
            spark,
            f"{base}/{files[name]}",
            RAW[name],
            escape=escape,
            multi_line=multi_line,
            mark_malformed=True,
        )
        write_table(df, layer_path(root, RAW_LAYER, name))

    _together(*[lambda name=name: load(name) for name in RAW])
    return {n: read_table(spark, layer_path(root, RAW_LAYER, n), s) for n, s in _raw_schemas().items()}


def append_raw(
    spark: SparkSession,
    input_dir: str,
    root: str,
    load_id: str,
    *,
    files: Mapping[str, str] = RAW_FILES,
    tables: Sequence[str] = tuple(RAW),
    escape: str = "\\",
    multi_line: bool = False,
) -> Tables:
    """Add the CSV files under ``input_dir`` to the raw tables that grow load by load.

    A load that is repeated replaces its own rows and no others. Returns all loads.
    """
    base = input_dir.rstrip("/")
    for name in tables:
        path = f"{base}/{files[name]}"
        df = ingest_raw(
            spark, path, RAW[name], escape=escape, multi_line=multi_line, mark_malformed=True
        )
        append_load(df, layer_path(root, APPENDED_LAYER, name), load_id)
    return read_appended(spark, root, tables=tables)


def read_appended(
    spark: SparkSession, root: str, *, loads: Sequence[str] | None = None, tables: Sequence[str] = tuple(RAW)
) -> Tables:
    """The raw tables that grow load by load, with lineage and ``load_id``; all loads or some."""
    schemas = _raw_schemas()
    return {
        name: read_loads(spark, layer_path(root, APPENDED_LAYER, name), schemas[name], loads)
        for name in tables
    }


def count_malformed(
    spark: SparkSession,
    input_dir: str,
    *,
    files: Mapping[str, str] = RAW_FILES,
    escape: str = "\\",
    multi_line: bool = False,
) -> DataFrame:
    """Malformed records of every input file, with the table each belongs to."""
    base = input_dir.rstrip("/")
    counts = [
        malformed_lines(
            spark, f"{base}/{files[name]}", RAW[name], escape=escape, multi_line=multi_line
        ).select(F.lit(name).alias("table_name"), "*")
        for name in RAW
    ]
    return reduce(DataFrame.unionByName, counts)


def build_clean(
    spark: SparkSession,
    raw: Tables,
    root: str,
    *,
    exact: bool = False,
    strict: bool = False,
    collation: str | None = None,
) -> Tables:
    """Load the clean layer from raw tables.

    Each table is written before the next one reads it, so no step is computed
    twice. The classified line items go to a work table, written once and read by
    both halves of the split. ``strict`` quarantines malformed line items. Under a
    ``collation`` such as ``UNICODE_CI_AI`` keys are looked up, grouped and kept unique
    by it; tables are stored as plain text.
    """
    tune(spark)
    raw = _all_collated(raw, collation)
    tables: Tables = {}

    def load(name: str, df: DataFrame) -> None:
        path = layer_path(root, CLEAN_LAYER, name)
        write_table(plain(df), path)
        tables[name] = collated(read_table(spark, path, CLEAN[name].schema), collation)

    def products() -> None:
        load("categories", cleaning.build_categories(raw["product_category_translation"]))
        load("products", cleaning.build_products(raw["products"], tables["categories"]))

    def orders() -> None:
        load("customers", cleaning.build_customers(raw["customers"]))
        load("orders", cleaning.build_orders(raw["orders"], tables["customers"]))

    _together(products, orders)
    work = layer_path(root, WORK_LAYER, "classified_order_items")
    classified = write_classified(
        spark, raw["order_items"], tables["orders"], tables["products"], work, strict=strict
    )
    classified = collated(classified, collation)
    if exact:
        work = layer_path(root, WORK_LAYER, "ranked_order_items")
        ranked = collated(write_ranked(spark, classified, work), collation)
        good = quarantine.first_items(ranked)
        rejects = quarantine.build_exact_quarantine(classified, ranked)
    else:
        good = quarantine.build_order_items(classified)
        rejects = quarantine.build_quarantine(classified)
    _together(
        lambda: load("order_items", good),
        lambda: load("quarantine_order_items", rejects),
    )
    return {name: plain(df) for name, df in tables.items()}


def write_classified(
    spark: SparkSession, raw_items: DataFrame, orders: DataFrame, products: DataFrame, path: str,
    *, slices: int = quarantine.SLICES, strict: bool = False,
) -> DataFrame:
    """Classify the line items into a table that the split reads back.

    Writing cuts the lineage: a lost executor repeats a scan, not the joins. It
    also leaves the joins free to split hot keys, since nothing above them relies
    on how their output is partitioned. Good and rejected rows are stored apart, so
    each half of the split reads only its own files. ``slices`` bounds what one task
    ranks of a hot key in exact mode; results do not depend on it.
    """
    classified = quarantine.with_slice(
        quarantine.classify_order_items(raw_items, orders, products, strict=strict), slices
    )
    outcome = F.col(quarantine.REASON).isNotNull().alias(quarantine.REJECTED)
    stored = plain(classified.select("*", outcome))
    write_table(stored, path, [quarantine.REJECTED], gather=False)
    return read_table(spark, path, stored.schema)


def write_ranked(spark: SparkSession, classified: DataFrame, path: str) -> DataFrame:
    """Rank the accepted line items once, into a table that both exact outputs read."""
    ranked = plain(quarantine.rank_accepted(classified))
    write_table(ranked, path, [quarantine.DUPLICATE], gather=False)
    return read_table(spark, path, ranked.schema)


def build_star(
    spark: SparkSession,
    clean: Tables,
    root: str,
    *,
    fact_by_month: bool = False,
    collation: str | None = None,
) -> Tables:
    """Load the star layer from clean tables, whose keys meet under ``collation``.

    ``fact_by_month`` adds a ``purchase_month`` column to the fact and stores it in
    one folder per month, for readers that look at a period at a time.
    """
    tune(spark)
    clean = _all_collated(clean, collation)
    tables: Tables = {}

    def load(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        path = layer_path(root, STAR_LAYER, name)
        write_table(plain(df), path, partition_by)
        tables[name] = read_table(spark, path, None if partition_by else STAR[name].schema)

    def facts_and_people() -> None:
        path = layer_path(root, WORK_LAYER, "order_profiles")
        write_table(plain(star.build_order_profiles(clean["orders"], clean["customers"])), path)
        profiles, items = collated(read_table(spark, path), collation), clean["order_items"]
        fact = star.fact_from_profiles(items, profiles)
        if fact_by_month:
            fact = fact.withColumn("purchase_month", month_of("purchase_ts"))
        _together(
            lambda: load("dim_customers", star.people_from_profiles(profiles, items)),
            lambda: load("fact_order_items", fact, ("purchase_month",) * fact_by_month),
        )

    _together(
        lambda: load(
            "dim_products", star.build_dim_products(clean["products"], clean["categories"])
        ),
        facts_and_people,
    )
    return tables


def register(spark: SparkSession, root: str, *, prefix: str = "") -> None:
    """Name the current version's tables in the catalog, one database per layer.

    Afterwards any SQL over ``bronze.*``, ``silver.*`` and ``gold.*`` runs as is. The names
    stay with that version until the next call, or the next ``run`` with ``catalog``.
    """
    home = current_path(spark, root)
    layers = {RAW_LAYER: RAW, CLEAN_LAYER: CLEAN, STAR_LAYER: STAR}
    create_layers(spark, [prefix + layer for layer in layers], root=f"{root.rstrip('/')}/catalog")
    for layer, names in layers.items():
        for name in names:
            register_table(spark, prefix + layer, name, layer_path(home, layer, name))


def run(
    spark: SparkSession,
    input_dir: str,
    output_root: str,
    *,
    files: Mapping[str, str] = RAW_FILES,
    escape: str = "\\",
    multi_line: bool = False,
    exact: bool = False,
    strict: bool = False,
    enforce: bool = False,
    fact_by_month: bool = False,
    collation: str | None = None,
    catalog: str | None = None,
    keep_versions: int = KEPT_VERSIONS,
    max_partitions: int = MAX_PARTITIONS,
) -> dict[str, Tables]:
    """Load all three layers under ``output_root``. Repeating a run replaces them.

    The tables are written beside the current ones and published as the last step, so
    readers see the old version whole, or the new one; a load that stops changes nothing
    for them. ``exact`` also quarantines the duplicates that deduplication leaves out,
    ``strict`` malformed line items; ``multi_line`` keeps line breaks inside quotes. With
    ``enforce`` a repeated key, a missing required value or an orphan in the clean or star
    layer stops the load with an ``AssertionError``, before anything is published.
    ``collation`` compares keys and names as ``build_clean`` says, from bronze to gold.
    ``catalog`` names the published tables in the catalog, as ``register`` with that prefix.
    The last ``keep_versions`` versions stay on disk. The caller's settings come back.
    """
    version = new_version()
    staged = version_path(output_root, version)
    with sized(spark, input_dir, max_partitions=max_partitions):
        raw = ingest_layer(
            spark, input_dir, staged, files=files, escape=escape, multi_line=multi_line
        )
        clean = build_clean(spark, raw, staged, exact=exact, strict=strict, collation=collation)
        if enforce:
            seen = _all_collated(clean, collation)
            assert_checks(run_checks(CLEAN_LAYER, seen, constraint_checks(CLEAN)))
        gold = build_star(spark, clean, staged, fact_by_month=fact_by_month, collation=collation)
        if enforce:
            seen = _all_collated(gold, collation)
            assert_checks(run_checks(STAR_LAYER, seen, constraint_checks(STAR)))
    publish(spark, output_root, version)
    if catalog is not None:
        register(spark, output_root, prefix=catalog)
    drop_versions(spark, output_root, keep_versions)
    return {"bronze": raw, "silver": clean, "gold": gold}


def read_accepted(spark: SparkSession, root: str) -> DataFrame:
    """Keys of the accepted line items before dedup, from the load's work table."""
    path = layer_path(current_path(spark, root), WORK_LAYER, "classified_order_items")
    return quarantine.accepted_keys(read_table(spark, path))


def accounting_by_file(spark: SparkSession, root: str) -> DataFrame:
    """Per source file of the line items, what became of its rows in the current version.

    A load with ``exact`` has ranked the accepted rows already; otherwise they are ranked here.
    """
    home = current_path(spark, root)
    raw = read_raw(spark, root)["order_items"]
    classified = read_table(spark, layer_path(home, WORK_LAYER, "classified_order_items"))
    try:
        ranked = read_table(spark, layer_path(home, WORK_LAYER, "ranked_order_items"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        ranked = quarantine.rank_accepted(classified)
    # Read without a schema, the folders' names come as text.
    ranked = ranked.withColumn(quarantine.DUPLICATE, F.col(quarantine.DUPLICATE).cast("boolean"))
    return quarantine.reconcile_by_file(raw, classified, ranked)
