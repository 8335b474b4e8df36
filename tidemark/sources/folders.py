"""Listing, removing and sizing of folders, and files that can be created once, through Hadoop's file systems."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def parts(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column below a folder."""
    prefix = f"{column}="
    return [n[len(prefix):] for n in names(spark, path) if n.startswith(prefix)]


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def write_number(spark: SparkSession, path: str, number: int) -> None:
    fs, hadoop_path = _file_system(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.writeLong(number)
    finally:
        out.close()


def read_number(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _file_system(spark, path)
    source = fs.open(hadoop_path)
    try:
        return source.readLong()
    finally:
        source.close()


def create_once(spark: SparkSession, path: str, number: int, linked: bool | None = None) -> bool:
    """Create a file that holds a number, whole at once; False when there is one already.

    The file is written under another name first. A local file is then linked, others are renamed, and both fail where
    the name is taken. The file system's rename must be atomic, as it is on HDFS and local disks; on an object store
    without that, let one writer at a time commit.
    """
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    write_number(spark, draft, number)
    hadoop_draft = spark._jvm.org.apache.hadoop.fs.Path(draft)
    try:
        if fs.getScheme() == "file" if linked is None else linked:
            files = spark._jvm.java.io.File
            link, old = files(target.toUri().getPath()).toPath(), files(hadoop_draft.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createLink(link, old)
        else:
            rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            full = fs.makeQualified(target)
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(hadoop_draft), full, options)
        return True
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in str(problem.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(hadoop_draft, False)
