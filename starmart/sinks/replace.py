"""Replacing a folder so that a job that fails leaves the old one in place."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from uuid import uuid4

from pyspark.sql import SparkSession

from starmart.sources.stores import scheme_of

# Schemes whose renames copy every object; there a folder is overwritten in place.
COPYING_SCHEMES = ("s3a", "gs")


class _Folder:
    """A folder and its neighbours, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str, options: Mapping[str, str] | None):
        conf = spark._jvm.org.apache.hadoop.conf.Configuration(spark._jsc.hadoopConfiguration())
        for name, value in (options or {}).items():
            conf.set(name, value)
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self._of = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path.getFileSystem(conf)

    def beside(self, kind: str, token: str = "") -> str:
        """A hidden neighbour, which readers of the parent folder skip."""
        name = f".{self._path.getName()}.{kind}.{token}"
        return self._of(self._path.getParent(), name).toString()

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def move(self, source: str | None, target: str | None) -> None:
        """Rename; ``None`` stands for the folder itself."""
        ends = [self._of(end) if end else self._path for end in (source, target)]
        if not self._files.rename(*ends):
            raise OSError(f"could not rename {ends[0].toString()} to {ends[1].toString()}")

    def delete(self, path: str) -> None:
        self._files.delete(self._of(path), True)

    def replaced(self) -> list[str]:
        """Old folders that were moved away, oldest first."""
        found = self._files.globStatus(self._of(self.beside("replaced", "*")))
        ordered = sorted(found or [], key=lambda status: status.getModificationTime())
        return [status.getPath().toString() for status in ordered]


def recover(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> bool:
    """Bring back the folder of a job that ended between its two renames; whether there was one."""
    folder = _Folder(spark, path, options)
    left = folder.replaced()
    if folder.exists() or not left:
        return False
    folder.move(left[-1], None)
    return True


def replace_folder(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    options: Mapping[str, str] | None = None,
) -> None:
    """Let ``write`` fill a hidden neighbour of ``path``, then put it in its place.

    Until all tasks have committed, ``path`` holds what it held, and a failed write changes
    nothing; so a table may also be replaced by rows read from itself. Then two renames
    exchange the folders; a job that ends between them is made good by ``recover``, which every
    later replacement starts with. Where renames copy (``COPYING_SCHEMES``), ``write`` gets ``path``
    itself and relies on the store's committer.
    """
    if scheme_of(path) in COPYING_SCHEMES:
        write(path)
        return
    recover(spark, path, options)
    folder, token = _Folder(spark, path, options), uuid4().hex
    staged, old = folder.beside("staged", token), folder.beside("replaced", token)
    try:
        write(staged)
    except Exception:
        folder.delete(staged)
        raise
    had = folder.exists()
    if had:
        folder.move(None, old)
    try:
        folder.move(staged, None)
    except Exception:
        if had:
            folder.move(old, None)
        raise
    if had:
        folder.delete(old)
    spark.catalog.refreshByPath(path)
