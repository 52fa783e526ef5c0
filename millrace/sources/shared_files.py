"""Small files in a shared folder: whole or absent, and never two writers of one name."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """File system and path object of any folder Spark can reach."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Publish a file by one rename; raises FileExistsError if the name is taken."""
    jvm, at, fs = _place(spark, path)
    own = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{uuid.uuid4().hex}")
    out = fs.create(own)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(at).toUri(), spark._jsc.hadoopConfiguration())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # does not replace
    try:
        context.rename(fs.makeQualified(own), fs.makeQualified(at), options)
    except Py4JJavaError as e:
        fs.delete(own, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise


def read_text(spark: SparkSession, path: str) -> str:
    jvm, at, fs = _place(spark, path)
    source = fs.open(at)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder. Hidden names are left out."""
    _, at, fs = _place(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in found if not n.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    _, at, fs = _place(spark, path)
    fs.delete(at, True)


@contextmanager
def lease(spark: SparkSession, path: str, owner: str, take_over: bool = False):
    """Hold the lease file at ``path``; a second holder gets a FileExistsError that names the first.

    A holder that died leaves its lease behind; ``take_over`` is for the operator who knows that it did.
    """
    if take_over:
        remove(spark, path)
    try:
        write_new(spark, path, owner)
    except FileExistsError:
        raise FileExistsError(f"{path} is held by {read_text(spark, path)}") from None
    try:
        yield
    finally:
        if names(spark, path.rpartition("/")[0]).count(path.rpartition("/")[2]) and read_text(spark, path) == owner:
            remove(spark, path)
