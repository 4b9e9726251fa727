"""Folders and small marker files in the file system that a path belongs to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


class FileSystem:
    """The file system of one path, through Spark's own client, so that any store Spark writes to works."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none for a missing folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(folder))) if self.exists(folder) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._at(folder))

    def rename(self, old: str, new: str) -> None:
        """Move a file or folder to a name that is not taken."""
        if self.exists(new) or not self._fs.rename(self._at(old), self._at(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def create(self, path: str, text: str) -> bool:
        """Write a new small file; False if the name is taken. One of several writers wins."""
        if self._fs.getScheme() == "file":
            # The client looks before it creates there; the system call does both at once.
            try:
                with open(self._at(path).toUri().getPath(), "x") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            out = self._fs.create(self._at(path), False)
        except Exception as error:
            if self.exists(path):
                return False
            raise error
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share, for tables that a query makes on its way.

    It is the one named by ``spark.checkpoint.dir``; a local session without it gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="renewline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"
