"""Session defaults and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder: on a cluster
    the executors could not see it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    root = spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


#: Fixed value: the engine's setting that frees what a query shuffled as soon as it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; otherwise these stay until the driver collects garbage.

    For writes whose result is read again from where it was written.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.createNewFile(hadoop_path)


def delete_files(spark: SparkSession, files: Iterable[str]) -> None:
    """Delete single files; folders are never removed."""
    for file in files:
        fs, hadoop_path = _file_system(spark, file)
        fs.delete(hadoop_path, False)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths of what a folder holds."""
    fs, hadoop_path = _file_system(spark, path)
    return [status.getPath().toString() for status in fs.listStatus(hadoop_path)]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder but hidden ones."""
    fs, hadoop_path = _file_system(spark, path)
    found, each = [], fs.listFiles(hadoop_path, True)
    while each.hasNext():
        file = each.next().getPath()
        if not file.getName().startswith((".", "_")):
            found.append(file.toString())
    return found


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path
