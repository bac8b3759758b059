"""Session set-up and the shared folder for intermediate results."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# may be set on a session that is already running
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where the next step groups by the same key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a batch of whole texts has to fit beside the heap
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # so have the rows that the Parquet reader decodes at a time
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    # counts and extremes of whole files come from their footers where the reader can do that
    "spark.sql.parquet.aggregatePushdown": "true",
}
SESSION_OPTIONS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no call site per column expression: halves the time to build a wide DataFrame
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    **RUNTIME_OPTIONS,
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a session made elsewhere."""
    for name, value in RUNTIME_OPTIONS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "lakeops", master: str | None = None, **options: str) -> SparkSession:
    """A session with the options this package is tested with; ``options`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    extra = {name.replace("__", "."): value for name, value in options.items()}
    for name, value in {**SESSION_OPTIONS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="lakeops-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: this process's part of the scratch folder; what is written there goes with the process
_PROCESS = uuid.uuid4().hex
_cleared_at_exit: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, removed when this process ends in good order."""
    own = f"{shared_dir(spark)}/lakeops/{_PROCESS}"
    if own not in _cleared_at_exit:
        _cleared_at_exit.add(own)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        atexit.register(_clear, target, spark.sparkContext._jsc.hadoopConfiguration())
    return f"{own}/{label}-{uuid.uuid4().hex}"


def _clear(target, configuration) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        target.getFileSystem(configuration).delete(target, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, for several later reads of some of its columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage through the shared checkpoint folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
