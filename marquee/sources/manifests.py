"""Numbered manifests: what a folder's current content is, decided by one rename.

Writers put data under new names that no reader looks for, then publish a
manifest that names them. Readers follow the manifest of the highest number,
so they see all of a publication or nothing of it, and a writer that
fails leaves the last publication as it was. One writer at a time: a second
one that publishes the same number raises.

Only file names and small JSON texts pass the driver, through the Hadoop file
system of the folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


class Folder:
    """Names, renames and small texts in a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, name: str = "") -> list[str]:
        """Names of files and folders in a folder under this one; none if it does not exist."""
        at = self._at(name) if name else self._path(self.path)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def files(self, name: str) -> list[str]:
        """All files below ``name``, as paths relative to it."""
        base = self._fs.makeQualified(self._at(name)).toString().rstrip("/") + "/"
        found, it = [], self._fs.listFiles(self._at(name), True)
        while it.hasNext():
            found.append(it.next().getPath().toString()[len(base):])
        return sorted(found)

    def rename(self, source: str, target: str) -> None:
        """Move a file; the target must not exist."""
        if self._fs.exists(self._at(target)):
            raise FileExistsError(f"{self.path}/{target}")
        self._fs.mkdirs(self._at(target).getParent())
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot rename {source} to {target} in {self.path}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        size = self._fs.getFileStatus(self._at(name)).getLen()
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readNBytes(int(size))).decode("utf-8")
        finally:
            stream.close()


def latest(folder: Folder) -> tuple[int, dict | None]:
    """``(number, content)`` of the current manifest; ``(0, None)`` if nothing was published."""
    numbers = [int(n[:-5]) for n in folder.names(MANIFESTS) if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return 0, None
    return max(numbers), json.loads(folder.read_text(f"{MANIFESTS}/{max(numbers):08d}.json"))


def publish(folder: Folder, number: int, content: dict) -> None:
    """Make ``content`` the manifest of ``number``: written beside, then renamed."""
    staged = f"{MANIFESTS}/_{uuid.uuid4().hex}"
    folder.write_text(staged, json.dumps(content, indent=1))
    try:
        folder.rename(staged, f"{MANIFESTS}/{number:08d}.json")
    except Exception:
        folder.delete(staged)
        raise
