"""Shared folders: where scratch data may go, and marker files through Hadoop's API."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder of the machine.
    """
    name = f"{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"{name}-")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


class Folder:
    """Names and markers under one root; holds metadata only, never rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path(self.at(*parts)))

    def make(self, *parts: str) -> None:
        self._fs.mkdirs(self._path(self.at(*parts)))

    def names(self, *parts: str) -> list[str]:
        if not self.exists(*parts):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.at(*parts))))

    def mark(self, *parts: str) -> None:
        self._fs.create(self._path(self.at(*parts)), True).close()

    def claim(self, text: str, *parts: str) -> bool:
        """Create a marker that holds `text`; False if there is one already."""
        self._fs.mkdirs(self._path(self.at(*parts[:-1])))
        try:
            out = self._fs.create(self._path(self.at(*parts)), False)
        except Py4JJavaError as error:
            if self.exists(*parts):
                return False
            raise error
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, *parts: str) -> str:
        path = self._path(self.at(*parts))
        size = self._fs.getFileStatus(path).getLen()
        stream = self._fs.open(path)
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def remove(self, *parts: str) -> None:
        self._fs.delete(self._path(self.at(*parts)), True)
