"""Small files on shared storage: reading, listing, and creating one that must not exist yet."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def names_in(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Names below a folder, sorted; none if it is not there."""
    files, path = _of(spark, f"{folder}/{pattern}")
    return sorted(entry.getPath().getName() for entry in files.globStatus(path) or ())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file; None if there is none."""
    files, found = _of(spark, path)
    if not files.exists(found):
        return None
    source = files.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, found = _of(spark, path)
    sink = files.create(found, True)
    try:
        sink.write(bytearray(text.encode()))
    finally:
        sink.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; False if it does. Never seen half written.

    The text is written beside it and moved into place: by a rename that does not replace, which
    file systems for clusters do atomically, or on a local disk by a link.
    """
    jvm = spark.sparkContext._jvm
    files, found = _of(spark, path)
    draft = f"{path}.{uuid4().hex}.draft"
    write_text(spark, draft, text)
    try:
        if files.getUri().getScheme() == "file":
            local = [jvm.java.io.File(_of(spark, p)[1].toUri().getPath()).toPath() for p in (path, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(_of(spark, draft)[1], found, none)
        return True
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    finally:
        files.delete(_of(spark, draft)[1], False)
