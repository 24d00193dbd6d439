"""Folders that appear together or not at all."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STAGING = "_staging"
MANIFEST = "_manifest.json"
_MOVING = "moving"


class _Files:
    """The Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def move(self, name: str, to: str) -> None:
        if not self.fs.rename(self._path(name), self._path(to)):
            raise OSError(f"{self.root}: {name} could not be moved to {to}")

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self._path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def sizes(self, name: str) -> dict[str, int]:
        """Files of a folder that readers see, with their bytes."""
        listed = self.fs.listStatus(self._path(name))
        files = {s.getPath().getName(): s.getLen() for s in listed if s.isFile()}
        return {f: n for f, n in files.items() if f[0] not in "_."}

    def delete_if_empty(self) -> None:
        if self.exists() and not len(self.fs.listStatus(self._path(""))):
            self.delete("")


def _roll_back(files: _Files, names: Sequence[str]) -> None:
    """Remove the staging folder, and what an unfinished publication had moved out of it."""
    if not files.exists(STAGING):
        return
    if files.exists(f"{STAGING}/{_MOVING}"):
        for name in [*names, MANIFEST]:
            if not files.exists(f"{STAGING}/{name}") and files.exists(name):
                files.delete(name)
    files.delete(STAGING)


@contextmanager
def publication(
    spark: SparkSession, path: str, names: Sequence[str], manifest: Mapping | None = None
) -> Iterator[str]:
    """A folder to write ``names`` to; when the block ends they are moved to ``path``, all or none.

    If the block or a move fails, nothing of them is left. If the driver is lost instead, a marker in the
    staging folder tells the next publication to the same path what had been moved; it removes that first,
    so that a report that was never whole does not stand in the way. A folder that stands at ``path``
    otherwise is refused before the block starts. With ``manifest``, a mapping that may be filled within the
    block, ``_manifest.json`` is moved last: whoever sees it sees all folders. It lists their files.

    One publication to a path at a time. A move is a rename of the file system: cheap where renames are
    (HDFS, local disks), a copy on an object store.
    """
    files = _Files(spark, path)
    _roll_back(files, names)
    for name in [*names, *([] if manifest is None else [MANIFEST])]:
        if files.exists(name):
            raise FileExistsError(f"{path}/{name}")
    try:
        yield f"{files.root}/{STAGING}"
        absent = [name for name in names if not files.exists(f"{STAGING}/{name}")]
        if absent:
            raise FileNotFoundError(f"not written: {absent}")
        if manifest is not None:
            held = {name: files.sizes(f"{STAGING}/{name}") for name in names}
            lines = [
                {"folder": n, "n_files": len(f), "n_bytes": sum(f.values()), "n_rows": manifest.get(n)}
                for n, f in held.items()
            ]
            files.write(f"{STAGING}/{MANIFEST}", "\n".join(map(json.dumps, lines)) + "\n")
        files.write(f"{STAGING}/{_MOVING}", "")
        for name in [*names, *([] if manifest is None else [MANIFEST])]:
            files.move(f"{STAGING}/{name}", name)
    except BaseException:
        _roll_back(files, names)
        files.delete_if_empty()
        raise
    files.delete(STAGING)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``folder, n_files, n_bytes, n_rows`` of a published report; an error if there is none."""
    files = _Files(spark, path)
    if not files.exists(MANIFEST):
        raise FileNotFoundError(f"{path}/{MANIFEST}")
    stream = files.fs.open(files._path(MANIFEST))
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    rows = [json.loads(line) for line in text.splitlines()]
    shape = "folder string, n_files long, n_bytes long, n_rows long"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in shape.split(", ")) for r in rows], shape)
