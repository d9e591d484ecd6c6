"""Session settings the operators count on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

# Day and hour boundaries follow the session time zone, so it is pinned rather than inherited.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


MIB = 2**20


def sized_for(
    data_bytes: int,
    partition_bytes: int = 512 * MIB,
    least_partitions: int = 200,
    most_partitions: int = 100_000,
    split_bytes: int = 128 * MIB,
) -> dict[str, str]:
    """Settings for the data a run shuffles at most.

    AQE merges shuffle partitions that turn out small but makes no further ones, so a run has to start
    with enough of them: one for each ``partition_bytes``. Beyond ``most_partitions``, what a driver
    tracks comfortably, they hold more each (100 TiB: 1 GiB) and spill sooner; with a larger driver,
    raise it. ``split_bytes`` is the size of scan tasks and of merged shuffle partitions.
    """
    partitions = min(max(data_bytes // partition_bytes, least_partitions), most_partitions)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
    }


def build_session(
    app: str = "voltlake", data_bytes: int | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with :data:`SETTINGS`, sized for ``data_bytes`` if given; ``conf`` has the last word.

    The master and the executors stay with the launcher.
    """
    sizing = {} if data_bytes is None else sized_for(data_bytes)
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **sizing, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Pin an existing session to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Files that a task keeps open in :func:`unsorted_writes`; rows of partitions beyond them are sorted after all.
OPEN_FILES = 100
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
_lock = Lock()
#: By session: how many blocks are in use, and what was set before the first.
_blocks: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """In the block, partitioned writes keep a file open for each partition instead of sorting the rows of a task.

    Tasks are cut by compressed bytes, but a sort holds whole rows: payloads that repeat each other take many
    times as much. The setting is the session's; of several threads, the last to leave puts it back.
    """
    with _lock:
        used, before = _blocks.get(spark, (0, None))
        if not used:
            before = spark.conf.get(OPEN_FILES_KEY, None)
            spark.conf.set(OPEN_FILES_KEY, str(max(int(before or 0), OPEN_FILES)))
        _blocks[spark] = used + 1, before
    try:
        yield
    finally:
        with _lock:
            used, before = _blocks.pop(spark)
            if used > 1:
                _blocks[spark] = used - 1, before
            elif before is None:
                spark.conf.unset(OPEN_FILES_KEY)
            else:
                spark.conf.set(OPEN_FILES_KEY, before)
