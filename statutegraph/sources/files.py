"""What a table format needs of a file system beyond reading and writing tables: exclusive creation, listing, removal."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create a file of a text, whole or not at all; of several that try one name, exactly one gets true.

    The text is written under a hidden name first.  It then gets its own name by
    a step that fails where the name is taken: a hard link on local disks, elsewhere a
    rename that does not replace.  The file system has to make that step atomic,
    as HDFS does; object stores need a committer of their own.
    """
    jvm, at, fs = _system(spark, f"{folder}/{name}")
    hidden = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (at, hidden)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(hidden, at, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        if fs.exists(hidden):
            fs.delete(hidden, False)
    return True


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names in a folder with the milliseconds at which they last changed; none if it is not there."""
    _, at, fs = _system(spark, folder)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(at)] if fs.exists(at) else []


def removed(spark: SparkSession, path: str) -> None:
    _, at, fs = _system(spark, path)
    fs.delete(at, True)
