"""Session helpers: building a local session for tests/bench and cutting lineage.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A directory is set here only when none is
configured (tests, bench), never overriding a cluster setting.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rateweave") -> SparkSession:
    """A local session configured the way the library expects (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, creating a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: "
                           "on a cluster there is no default")
    scratch = tempfile.mkdtemp(prefix="rateweave-ckpt-", dir=os.environ.get("RATEWEAVE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared checkpoint directory
    and continue from that table.

    Equivalent to a reliable ``checkpoint()`` (the data lives in the shared
    folder, so losing an executor never forces recomputation of the lineage),
    but it is one job instead of two, the result is columnar, and the scan
    carries file-size statistics the optimizer can use."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    return spark.read.parquet(path)


#: Tables of the innermost scope, of this thread's context alone.
_WRITTEN: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("written", default=None)


def in_context(fn, jobs) -> list:
    """``jobs`` paired with a call of ``fn`` in a copy of this context, for threads of a pool."""
    return [(contextvars.copy_context(), fn, job) for job in jobs]


def call_in_context(bound: tuple):
    context, fn, job = bound
    return context.run(fn, job)


@contextlib.contextmanager
def intermediates(spark: SparkSession):
    """Within this scope, tables that ``cut_lineage`` writes are removed at the end: for jobs
    whose results stand in their own sinks by then.  Scopes of jobs that run side by side in
    threads of their own don't touch each other's tables; an inner scope removes its own."""
    own: list[str] = []
    token = _WRITTEN.set(own)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while own:
            path = jvm.org.apache.hadoop.fs.Path(own.pop())
            path.getFileSystem(conf).delete(path, True)
