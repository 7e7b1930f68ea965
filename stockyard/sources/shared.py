"""The folder that driver and executors share, and the few file operations that Spark's readers and writers lack."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on a local master without it (tests) a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not where and jvm_dir.isDefined():
        where = jvm_dir.get()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="stockyard-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Files:
    """Paths of any store that Spark can write to."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def exists(self, path: str) -> bool:
        store, at = self._at(path)
        return store.exists(at)

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder, sorted."""
        store, at = self._at(path)
        return sorted(x.getPath().getName() for x in store.listStatus(at) if x.isDirectory()) if store.exists(at) else []

    def make(self, path: str) -> None:
        """A folder, unless it is there."""
        store, at = self._at(path)
        store.mkdirs(at)

    def delete(self, path: str) -> bool:
        store, at = self._at(path)
        return store.delete(at, True)

    def rename(self, path: str, to: str) -> None:
        store, at = self._at(path)
        if not store.rename(at, self.jvm.org.apache.hadoop.fs.Path(to)):
            raise OSError(f"cannot rename {path} to {to}")

    def create(self, path: str, text: str, overwrite: bool = False) -> bool:
        """Write a small file; without `overwrite`, False if there is one (the store decides, so only one caller wins)."""
        store, at = self._at(path)
        try:
            out = store.create(at, overwrite)
        except Exception as e:
            if "already exists" in str(e):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def text(self, path: str) -> str | None:
        """A small file's text; None if there is none."""
        store, at = self._at(path)
        if not store.exists(at):
            return None
        source = store.open(at)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()
