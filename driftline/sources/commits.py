"""A log of small numbered files in a shared folder, of which each number is written once: what is in it happened, in its order."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


class Taken(Exception):
    """Another writer wrote this number first."""


class CommitLog:
    """Numbered JSON files `<path>/<number>.json`.

    A file is written under another name first. Then a hard link (file: folders) or a rename without overwriting (other
    file systems, HDFS for one) gives it its number, which is done at once or not at all: of several writers of one
    number one wins, and no reader sees half a file.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark._jvm.org.apache.hadoop.fs
        self._jvm, self._spark, self.path = jvm, spark, path
        self._dir = jvm.Path(path)
        self._fs = self._dir.getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = jvm.FileContext.getFileContext(self._fs.getUri(), spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._dir)
        self._local = self._fs.makeQualified(self._dir).toUri().getPath() if self._fs.getUri().getScheme() == "file" else None

    def _place(self, number: int):
        return self._fs.makeQualified(self._jvm.Path(self._dir, f"{number:020d}.json"))

    def numbers(self) -> list[int]:
        """The numbers that are written, in order."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._dir)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def put(self, number: int, content: dict) -> None:
        """Write this number; Taken if it is there already."""
        if self._local:
            draft = f"{self._local}/.{uuid.uuid4().hex}"
            with open(draft, "x", encoding="utf-8") as f:
                json.dump(content, f)
            try:
                os.link(draft, f"{self._local}/{number:020d}.json")
            except FileExistsError as e:
                raise Taken(f"{self.path}: {number}") from e
            finally:
                os.unlink(draft)
            return
        draft = self._fs.makeQualified(self._jvm.Path(self._dir, f".{uuid.uuid4().hex}"))
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        rename = self._spark._jvm.java.lang.reflect.Array.newInstance(self._spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self._context.rename(draft, self._place(number), rename)
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(self._place(number)):
                raise Taken(f"{self.path}: {number}") from e
            raise

    def get(self, number: int) -> dict:
        if self._local:
            with open(f"{self._local}/{number:020d}.json", encoding="utf-8") as f:
                return json.load(f)
        opened = self._fs.open(self._place(number))
        try:
            return json.loads(bytes(self._spark._jvm.org.apache.commons.io.IOUtils.toByteArray(opened)))
        finally:
            opened.close()

    def drop(self, number: int) -> None:
        self._fs.delete(self._place(number), False)

    def folder(self, name: str) -> str:
        """A folder beside the log."""
        return f"{self.path.rstrip('/').rpartition('/')[0]}/{name}"

    def delete_folder(self, path: str) -> None:
        self._fs.delete(self._jvm.Path(path), True)

    def folders(self, path: str) -> list[str]:
        """The names of the folders in a folder; none if it is not there."""
        p = self._jvm.Path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p) if s.isDirectory()] if self._fs.exists(p) else []
