"""Session helpers shared by the library, the tests and the bench."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a stored table up to which Spark may broadcast it, and up to which it always does.
LARGE_ROWS, SMALL_ROWS = 200_000, 1_000
#: Rows of a task where ``spread`` deals them.
TASK_ROWS = 100_000
#: Joins by the same keys in one stage at most: each holds a sort, and a task has memory for eight to sixteen pages.
STAGE_JOINS = 6


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plotwise")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; fall back to a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plotwise-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later steps start from files, with pruned columns, not from lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """A frame over stored files, joined by the size of its rows.

    Spark takes the length of compressed, pruned files for the size of a broadcast, which holds its rows unpacked in the
    driver: columns of few values take a hundredth of that on disk. A table of more than ``LARGE_ROWS`` rows (read from
    the files' footers) is therefore merged, never broadcast; one of at most ``SMALL_ROWS`` is broadcast whatever it meets.
    """
    rows = df.count()
    if rows > LARGE_ROWS:
        return df.hint("merge")
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to tasks of about ``TASK_ROWS`` rows; ``rows`` is their number, or more.

    Spark merges partitions by their compressed length and has a fixed number of them. Rows that repeat in most columns
    take a twentieth of their memory there, so that a task's sort grows with the input; dealt by number it does not.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def in_stages(df: DataFrame, joins: list[Callable[[DataFrame], DataFrame]], *keys: str) -> DataFrame:
    """``df`` after left joins by ``keys``, dealt anew after every ``STAGE_JOINS`` of them.

    Joins by the same keys run in one stage, whose tasks hold the sorted rows of all of them at once. Spark leaves out an
    exchange by the same keys to as many tasks, so each deals to one more than the one before.
    """
    if len(joins) <= STAGE_JOINS:
        return reduce(lambda rows, join: join(rows), joins, df)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))
    for i, join in enumerate(joins):
        df = join(df.repartition(tasks + i // STAGE_JOINS, *keys) if i and i % STAGE_JOINS == 0 else df)
    return df


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder so that later steps start from stored rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
