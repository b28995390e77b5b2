"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.options import DEFAULTS, Options


# The JVM never compiles a method of over 8,000 bytes. Spark puts all columns of a stage into one method up to this limit, and
# over it evaluates them operator by operator in methods that it splits.
HUGE_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def session_settings(options: Options = DEFAULTS) -> dict[str, str]:
    """Settings a session for this package should carry. Sizes are per task, so they hold at any data volume."""
    return {
        "spark.sql.session.timeZone": options.time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        HUGE_METHOD: COMPILED_BYTES,
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def build_session(app_name: str = "bookflow", options: Options = DEFAULTS, **extra: str) -> SparkSession:
    """A session with ``session_settings``; ``extra`` settings win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**session_settings(options), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; on a local master that names none, one in the warehouse folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/shared-{uuid.uuid4().hex}")
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back.

    Cuts the lineage like a checkpoint, survives the loss of executors, and later steps read only their columns.
    ``folder`` is a ``stage_folder`` that its user removes; without one the files stay as long as the shared folder.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    with compiled_methods(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside run in methods that the JVM compiles, unless the session has a limit of its own."""
    default = spark.conf.get(HUGE_METHOD, None) in (None, "65535")
    try:
        if default:
            spark.conf.set(HUGE_METHOD, COMPILED_BYTES)
        yield
    finally:
        if default:
            spark.conf.unset(HUGE_METHOD)


@contextmanager
def stage_folder(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared one for ``materialize``, removed at the end: results must be stored by then."""
    folder = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


ROWS_PER_TASK = 100_000


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, of at most about ``rows_per_task`` rows; an input that
    has them already is left alone.

    Small tables come in one or two files, which would keep most cores idle, and of the splits of a large file only those
    hold rows in which a row group begins. So the rows of each partition are counted, for parquet from the footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().toLocalIterator()]
    if len(counts) >= cores and max(counts) <= rows_per_task:
        return df
    rounds = -(-sum(counts) // (rows_per_task * cores))
    return df.repartition(cores * max(rounds, 1))
