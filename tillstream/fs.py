"""Directory questions asked of whatever file system a path lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def numbered(spark: SparkSession, root: str, column: str) -> list[int]:
    """Numbers of the `<column>=<n>` folders under root, ascending; none while there is no root."""
    fs, p = _open(spark, root)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{column}="))


def named(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the `<column>=<value>` folders under root, ascending."""
    fs, p = _open(spark, root)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(name.partition("=")[2] for name in names if name.startswith(f"{column}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, p = _open(spark, source)
    return fs.rename(p, _open(spark, target)[1])


def complete_batches(spark: SparkSession, root: str, marked: bool = True) -> list[int]:
    """Ids of the `batch_id=<n>` folders under root whose write job committed, ascending.

    Batches are written one after the other, so only the newest can be unfinished. Folders of a partitioned table bear
    no mark of their own and appear when their job commits: `marked=False`.
    """
    found = numbered(spark, root, "batch_id")
    if marked and found and not exists(spark, f"{root}/batch_id={found[-1]}/_SUCCESS"):
        found.pop()
    return found
