"""File helpers over any store that Spark reaches: local folders, object stores, HDFS.

Paths go through Hadoop's file systems, so the same call works on a cluster; contents and listings are DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def working_folder(spark: SparkSession) -> str:
    """The folder that relative paths start from, on the default file system."""
    fs, _ = _fs(spark, ".")
    return fs.getWorkingDirectory().toString()


def temporary_folder(spark: SparkSession, project: str) -> str:
    """A project's folder for temporary files, made if it is missing: in ``hadoop.tmp.dir``, so that all machines name the same."""
    base = spark.sparkContext._jsc.hadoopConfiguration().get("hadoop.tmp.dir") or "/tmp"
    path = f"{base.rstrip('/')}/{project}"
    make_folders(spark, path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen()


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds since 1970."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, milliseconds, -1)


def delete(spark: SparkSession, path: str, *, tree: bool = False) -> bool:
    """Deletes a file, or with ``tree`` a folder; a root is refused. Whether there was something to delete."""
    fs, p = _fs(spark, path)
    if p.isRoot():
        raise ValueError("the root of a file system is not deleted")
    return fs.delete(p, tree)


def make_folders(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> bool:
    fs, p = _fs(spark, source)
    return fs.rename(p, _fs(spark, target)[1])


def copy(spark: SparkSession, source: str, target: str) -> bool:
    (fs, p), (other, q) = _fs(spark, source), _fs(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, other, q, False, conf)


def listing(spark: SparkSession, path: str, order: str = "name", *, descending: bool = False) -> DataFrame:
    """Rows (path, size, modified) of a folder's entries, by name, size or date."""
    fs, p = _fs(spark, path)
    rows = [(s.getPath().toString(), s.getLen(), s.getModificationTime(), s.isDirectory()) for s in fs.listStatus(p)] if fs.exists(p) else []
    column = {"name": "path", "size": "size", "date": "modified"}[order]
    table = spark.createDataFrame(rows, "path string, size long, modified long, is_directory boolean")
    return table.orderBy(F.desc(column) if descending else F.asc(column), "path")


def first_with_prefix(spark: SparkSession, path: str, prefix: str) -> str | None:
    row = listing(spark, path).where(F.substring_index("path", "/", -1).startswith(prefix)).first()
    return row["path"] if row else None


def rotate(spark: SparkSession, path: str, pattern: str, keep: int) -> int:
    """Deletes the oldest files whose names match a regular expression, beyond ``keep``; how many were deleted."""
    old = listing(spark, path, "date", descending=True).where(~F.col("is_directory") & F.substring_index("path", "/", -1).rlike(pattern))
    return sum(delete(spark, r["path"]) for r in old.collect()[keep:])


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, text), a file each."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def whole_bytes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("bytes"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def tail(spark: SparkSession, path: str, lines: int) -> list[str]:
    """The last lines of a file, in order."""
    numbered = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    return [r["value"] for r in reversed(numbered.orderBy(F.desc("n")).limit(lines).collect())]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
