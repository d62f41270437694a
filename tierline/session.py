"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024

# Settings that change how a plan runs, never what it returns.
#
# forceOptimizeSkewedJoin: an oversized join partition is split even where the
# operator above wanted the join's partitioning; the extra exchange appears only
# when there is skew to split.
#
# maxShuffledHashJoinLocalMapThreshold: where every partition of a join's smaller
# side turns out this small, hash it instead of sorting both sides.
#
# maxConcurrentOutputFileWriters: a task that writes a few partition values keeps
# their files open side by side instead of sorting its rows by value first.
#
# aggregatePushdown: counts and ranges come from Parquet footers where the reader can.
#
# compression.codec: layers are written smaller, as they are written and read once a step.
RUNTIME_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * MIB),
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive-execution settings the plans here count on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files under ``paths``, from their listing; no file is opened.

    The listing is packed into about one task per core while it is summed.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    )
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(1024 * 1024 * MIB))
    try:
        return listing.agg(F.sum("length")).first()[0] or 0
    finally:
        spark.conf.set(setting, before)


SPLITS = "spark.sql.files.minPartitionNum"

# Most shuffle partitions asked for; past about 25 TB the partitions grow instead.
MAX_PARTITIONS = 100_000


def sizing_for(size: int, max_partitions: int = MAX_PARTITIONS) -> dict[str, str]:
    """Scan and shuffle settings for an input of ``size`` bytes.

    Tasks stay near 256 MiB while that gives a manageable number of them. Above
    that the tasks grow instead, because a shuffle moves (scan tasks) x (shuffle
    partitions) blocks: 100 TB runs as about 200,000 scan tasks of 500 MB and
    100,000 shuffle partitions of 1 GiB, which sort and spill within an executor.
    The pieces a hot partition is split into grow likewise, up to 256 MiB, and so
    does the size up to which a join's smaller side is hashed: Spark wants it at
    least as large as those pieces. Raise ``max_partitions`` for far larger inputs.
    """
    shuffle = max(1, min(-(-size // (256 * MIB)), max_partitions))
    scan = min(max(128 * MIB, size // (2 * max_partitions)), 1024 * MIB)
    piece = min(max(64 * MIB, size // 400_000), 256 * MIB)
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(piece),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(piece),
    }


def size_for(
    spark: SparkSession, size: int, max_partitions: int = MAX_PARTITIONS
) -> SparkSession:
    """Raise the session's scan and shuffle settings to suit ``size``.

    Settings that are already larger stay. Too many shuffle partitions do no harm,
    as adaptive execution merges the small ones.
    """
    for name, value in sizing_for(size, max_partitions).items():
        if _number(spark.conf.get(name)) < int(value):
            spark.conf.set(name, value)
    return spark


@contextmanager
def sized(
    spark: SparkSession, *paths: str, max_partitions: int = MAX_PARTITIONS
) -> Iterator[SparkSession]:
    """Tuned and sized for the files under ``paths``; afterwards the settings are as before.

    Plans read the settings when they run, so run them inside.
    """
    names = [*RUNTIME_SETTINGS, *sizing_for(0), SPLITS]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        # Files read twice must be split alike, also where executors come and go.
        if before[SPLITS] is None:
            spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
        yield size_for(tune(spark), input_bytes(spark, *paths), max_partitions)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _number(setting: str) -> int:
    """A count or a size such as ``256m`` or ``134217728b`` as a plain number, ``-1`` too."""
    digits, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(digits) * 1024 ** " kmgtp".index(unit or " ")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks.

    Small row groups and splits let every core take part in reading a small table;
    on a cluster the defaults do, since there are many more splits than cores.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tierline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.hadoop.parquet.block.size", str(2 * MIB))
        .config("spark.sql.files.openCostInBytes", str(MIB // 4))
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, for tables that cut lineage.

    It lies under ``spark.checkpoint.dir``. Only a local session may go without
    that setting: there the driver's own disk is the executors' disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        root = tempfile.mkdtemp(prefix="tierline-")
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/tierline-{app}-{uuid.uuid4().hex[:8]}"
