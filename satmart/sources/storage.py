"""Shared storage: where intermediate tables go, and small file-system questions."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return _checked(spark, named.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="satmart-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def _checked(spark: SparkSession, folder: str) -> str:
    """The folder, once it is known that files which executors write there reach the driver.

    Only a ``file:`` folder can fail that, and only where executors run on other machines.
    """
    fs, _ = _path(spark, folder)
    local = spark.sparkContext.master.startswith("local")
    key = (spark.sparkContext.applicationId, folder)
    if local or fs.getScheme() != "file" or key in _shared:
        return folder
    if not reaches_driver(spark, folder, spark.sparkContext.defaultParallelism):
        raise RuntimeError(f"{folder} is local to each machine; name one that all share")
    _shared.add(key)
    return folder


def reaches_driver(spark: SparkSession, folder: str, tasks: int) -> bool:
    """Whether one small file from each of some tasks is there for the driver to see."""
    probe = f"{folder}/probe-{uuid.uuid4().hex}"
    spark.range(0, tasks, 1, tasks).write.parquet(probe)
    seen = sum(name.startswith("part-") for name in child_names(spark, probe))
    remove(spark, probe)
    return seen == tasks


_shared: set[tuple[str, str]] = set()


class Stage:
    """Writes a result that has several readers once, and hands back the written table.

    Unlike a cached table it outlives executors, and its file size is what Catalyst and AQE
    measure when they decide whether a lookup is small enough to broadcast.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove the staged tables, once everything that reads them is done."""
        remove(self.spark, self.root)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and time of change of a file or folder; new data under the same name changes it."""
    fs, hadoop_path = _path(spark, path)
    status = fs.getFileStatus(hadoop_path)
    return fs.getContentSummary(hadoop_path).getLength(), status.getModificationTime()


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_only(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole content, unless it is there; whether this call made it.

    Of several callers one succeeds: the text is written aside and given its name by a step that
    fails where the name is taken. That is a link on a local disk and a rename elsewhere, as
    distributed file systems do it; an object store needs one whose rename is exclusive."""
    fs, hadoop_path = _path(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    aside = f"{path}.{uuid.uuid4().hex}"
    stream = fs.create(_path(spark, aside)[1], False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.getScheme() == "file":
        names = [_path(spark, p)[1].toUri().getPath() for p in (aside, path)]
        try:
            os.link(*names)
            made = True
        except FileExistsError:
            made = False
    else:
        made = not fs.exists(hadoop_path) and fs.rename(_path(spark, aside)[1], hadoop_path)
    remove(spark, aside)
    return made


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)
