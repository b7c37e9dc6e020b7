"""Data folders whose current state is named by a manifest, published version by version.

A version is one small JSON file.  It is written beside its place and renamed to it, which fails
where another writer has put that version first: of two writers that start from one version, one
publishes and the other gets ``Conflict``.  Readers see the last published version, never a half
of one.  Files go through Hadoop's file systems, so any shared folder of the cluster will do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has published since the version this one started from."""


class Published:
    """The versions under one folder; version 0 is the state before any was published."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self._conf).makeQualified(path)

    def children(self, name: str = "") -> list[str]:
        """Names of files and folders in a folder below this one, sorted; none if it isn't there."""
        path = self._path(name)
        fs = path.getFileSystem(self._conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def version(self) -> int:
        return max((int(n[1:-5]) for n in self.children("_versions") if n.startswith("v") and n.endswith(".json")), default=0)

    def read(self, version: int | None = None) -> dict:
        """The content of a version, by default the last."""
        number = self.version() if version is None else version
        if number == 0:
            return {}
        path = self._path(f"_versions/v{number:010d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, base: int, content: dict) -> int:
        """Makes ``content`` version ``base`` + 1, if ``base`` is still the last one."""
        if self.version() != base:
            raise Conflict(f"{self.folder} is at version {self.version()}, not {base}")
        place, draft = self._path(f"_versions/v{base + 1:010d}.json"), self._path(f"_versions/.draft-{uuid.uuid4().hex}")
        fs = place.getFileSystem(self._conf)
        fs.mkdirs(self._path("_versions"))
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        none = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(none, 1)
        how[0] = none.NONE  # never over a file that is there
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf).rename(draft, place, how)
        except Exception as error:
            fs.delete(draft, False)
            if "AlreadyExists" in str(error):
                raise Conflict(f"{self.folder} got version {base + 1} from another writer") from error
            raise
        return base + 1
