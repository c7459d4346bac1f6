"""Session set-up for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "lodestrata", memory: str = "16g") -> SparkSession:
    """Single-machine session. On a cluster the submitter's settings apply."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    A session without that setting gets a folder of its own on the local machine, if
    driver and executors are one machine, as in tests; on a cluster that is refused,
    since executors would not see each other's files. ``drop_stages`` removes
    the folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="lodestrata-")
    folder = f"{root.rstrip('/')}/lodestrata-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def drop_stages(spark: SparkSession) -> int:
    """Remove the intermediate results of this application; their number.

    For the end of a run: DataFrames that still read them fail afterwards.
    """
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for folder in made:
        delete_path(spark, folder)
    return len(made)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there, wherever it is stored."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder within its store; fails if it could not."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(old, new):
        raise OSError(f"could not move {path} to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that a pattern finds, wherever they are stored."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.globStatus(hadoop_path) or [])


def touch(spark: SparkSession, path: str) -> None:
    """Write an empty file, with the folders above it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(hadoop_path, True).close()


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs meanwhile go when it ends, not when the driver collects its garbage.

    For writes: nothing reads their shuffles again, and the files of all writes of a run would add up.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stage(df: DataFrame, name: str = "stage", schema: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the file.

    Several readers then share one computation, and a lost executor costs a
    re-read, not a recomputation. Later reads see only the columns they need. Fields of
    ``schema`` that were not written read as null. Keys are digests for the most part, which
    zstd packs to half of what the default codec takes.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    with dropped_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


#: Rows of a task after `spread`.
SPREAD_ROWS = 100_000


def spread_tasks(df: DataFrame) -> int:
    """Tasks for costly per-row work on a table read from files: all cores, and few enough rows in each."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows over all cores, and few enough in a task, where the input has fewer splits than that.

    Meant for costly per-row work on a table read from files, whose rows are counted from their
    footers. A table with enough splits passes through without a shuffle. Rows are dealt by the
    columns ``by``, if any: a join by them then needs no shuffle of its own.
    """
    wanted = spread_tasks(df)
    return df.repartition(wanted, *by) if df.rdd.getNumPartitions() < wanted else df
