"""Folders of any store that Spark reads: renamed, listed and removed through the session's own file systems."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Folders:
    """What jobs need of a store, for the store that a path is in."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._fs = spark._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        uri = self._path(path).toUri()
        context = self._fs.FileContext
        self._context = context.getFileContext(uri, conf) if uri.getScheme() else context.getFileContext(conf)
        self._files = self._path(path).getFileSystem(conf)
        self._no_overwrite = spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 1)
        self._no_overwrite[0] = self._fs.Options.Rename.NONE

    def _path(self, path: str):
        return self._fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, path: str) -> dict[str, int]:
        """The names in a folder (none if it is not there) and when they were last changed, in milliseconds."""
        if not self.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._files.listStatus(self._path(path))}

    def make(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename; fails if the target is there, also if it has come about meanwhile."""
        self._context.rename(self._path(source), self._path(target), self._no_overwrite)

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._files.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """A whole new file under that name, or an error if there is one: nobody sees a part of it."""
        parent, _, name = path.rpartition("/")
        draft = f"{parent}/.{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(draft), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            self.move(draft, path)
        except Exception:
            self.remove(draft)
            raise


def _beside(path: str, kind: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    # A hidden name: nothing that reads the parent takes it for data.
    return f"{parent or '.'}/.{name}.{kind}-{uuid.uuid4().hex}"


def restore(spark: SparkSession, path: str) -> bool:
    """Bring back what a job that died between its two renames has moved away; whether there was anything."""
    path = path.rstrip("/")
    folders = Folders(spark, path)
    parent, _, name = path.rpartition("/")
    moved = {n: t for n, t in folders.names(parent or ".").items() if n.startswith(f".{name}.replaced-")}
    if folders.exists(path) or not moved:
        return False
    folders.move(f"{parent or '.'}/{max(moved, key=moved.get)}", path)
    return True


def replaced(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[str], None] | None = None) -> None:
    """Replace a folder by what ``write`` puts into the path it is given.

    The new rows are written beside the old ones, which stay readable, and may be read to make them. Only when they are
    complete, and ``check`` has looked at them, are the folders exchanged by two renames; if anything fails before, the
    old folder is left as it was. A job that dies between the renames leaves both; the next one, or :func:`restore`,
    brings the old one back.
    """
    path = path.rstrip("/")
    folders = Folders(spark, path)
    restore(spark, path)
    staged, old = _beside(path, "staged"), _beside(path, "replaced")
    try:
        write(staged)
        if check is not None:
            check(staged)
        there = folders.exists(path)
        if there:
            folders.move(path, old)
        try:
            folders.move(staged, path)
        except Exception:
            if there and not folders.exists(path):
                folders.move(old, path)
            raise
    except Exception:
        folders.remove(staged)
        raise
    if there:
        folders.remove(old)
