"""Create a file once and whole: the single step by which something is published.

What is published must not be seen half written, and of several writers of one name exactly one may succeed.  How a
file system offers that differs, so it is behind `OnceStore`; `register` names the store of a further scheme.
"""

from __future__ import annotations

import os
import uuid
from typing import Protocol
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class OnceStore(Protocol):
    def put(self, spark: SparkSession, path: str, data: bytes) -> bool:
        """Make `path` hold `data`, unless it exists; says whether it was made.  Never leaves it half written."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists_already(e: Py4JJavaError) -> bool:
    name = e.java_exception.getClass().getName()
    return "AlreadyExists" in name or "PreconditionFailed" in name


class LinkStore:
    """Local files: filled under a hidden name, then linked, which fails if the name is taken."""

    def put(self, spark: SparkSession, path: str, data: bytes) -> bool:
        target = unquote(urlparse(path).path)
        folder = os.path.dirname(target)
        os.makedirs(folder, exist_ok=True)
        filled = f"{folder}/.{uuid.uuid4().hex}"
        with open(filled, "xb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(filled, target)
        except FileExistsError:
            return False
        finally:
            os.remove(filled)
        return True


class RenameStore:
    """File systems whose rename is atomic and doesn't replace, as HDFS: filled under a hidden name, then renamed."""

    def put(self, spark: SparkSession, path: str, data: bytes) -> bool:
        jvm = spark._jvm
        fs, p = _fs(spark, path)
        filled = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        stream = fs.create(filled, False)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(context.makeQualified(filled), context.makeQualified(p), how)
        except Py4JJavaError as e:
            if _exists_already(e):
                return False
            raise
        finally:
            fs.delete(filled, False)
        return True


class ConditionalStore:
    """Object stores that show a file when it is closed and can refuse to replace one, by the create option `option`."""

    def __init__(self, option: str = "fs.option.create.conditional.overwrite"):
        self.option = option

    def put(self, spark: SparkSession, path: str, data: bytes) -> bool:
        fs, p = _fs(spark, path)
        try:
            stream = fs.createFile(p).recursive().must(self.option, True).build()
            try:
                stream.write(bytearray(data))
            finally:
                stream.close()
        except Py4JJavaError as e:
            if _exists_already(e):
                return False
            raise
        return True


_stores: dict[str, OnceStore] = {"file": LinkStore(), "s3a": ConditionalStore()}
_stores |= dict.fromkeys(("hdfs", "viewfs", "abfs", "abfss"), RenameStore())


def register(scheme: str, store: OnceStore) -> None:
    """Publish on file systems of this scheme by `store`."""
    _stores[scheme] = store


def put_once(spark: SparkSession, path: str, data: bytes) -> bool:
    """Make `path` hold `data`, unless it exists."""
    fs, p = _fs(spark, path)
    scheme = p.toUri().getScheme() or fs.getUri().getScheme()
    if scheme not in _stores:
        raise NotImplementedError(f"no way is known to create a file once on {scheme}: give one to docloom.plans.once.register")
    return _stores[scheme].put(spark, path, data)
