"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "opinara") -> SparkSession:
    """A session for tests and benchmarks; on a cluster pass your own session."""
    n = 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to
    a temporary folder, because there every task runs on the same machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="opinara-checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back, by default under a new name in the shared folder.

    Cuts lineage: later steps survive lost executors and compute nothing twice.
    """
    spark = df.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """A block in which Spark removes a query's shuffle files when it ends, not when the driver happens to collect
    its garbage. What is persisted keeps its files."""
    before = spark.conf.get(_SWEEP, None)
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SWEEP)
        else:
            spark.conf.set(_SWEEP, before)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


def removed(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(name, True)
