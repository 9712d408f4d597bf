"""Small files beside a table, through the file system that Spark itself uses for its path."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """Files below ``path``; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.gateway, self.hadoop, self.settings = context._gateway, context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.system = self.hadoop.Path(self.path).getFileSystem(self.settings)

    def _at(self, name: str = ""):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names of files and folders directly below; none if there is no such folder."""
        if not self.system.exists(self._at(name)):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(self._at(name))]

    def files(self, name: str = "") -> list[tuple[str, int, int]]:
        """Name, bytes and time (milliseconds) of all files below, however deep; those whose names are hidden are left out."""
        if not self.system.exists(self._at(name)):
            return []
        base, found = self.system.makeQualified(self._at()).toUri().getPath(), []
        each = self.system.listFiles(self._at(name), True)
        while each.hasNext():
            status = each.next()
            own = status.getPath().toUri().getPath()[len(base) + 1:]
            if not any(part[:1] in "_." and "=" not in part for part in own.split("/")):
                found.append((own, status.getLen(), status.getModificationTime()))
        return found

    def create(self, name: str, text: str) -> bool:
        """Write a file whole, or not at all if there already is one of that name.

        It is moved into place, and a move does not replace.  Stores that copy
        instead of moving need one writer at a time.
        """
        draft = self._at(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = self.system.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        kinds = getattr(self.hadoop, "Options$Rename")
        keep = self.gateway.new_array(kinds, 1)
        keep[0] = kinds.NONE
        try:
            self.hadoop.FileContext.getFileContext(self.system.getUri(), self.settings).rename(draft, self._at(name), keep)
        except Py4JJavaError as error:
            self.system.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), False)
