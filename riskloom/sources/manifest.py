"""Tables whose folders count only when a manifest names them: committed appends and compacted logs.

A writer puts its rows into a folder of its own, then writes the next manifest under a name of its own and
renames it to the next version; the rename fails if somebody else had that version. A job that is killed
leaves a folder that no manifest names, and a job that runs again finds its name in the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Manifests that stay, for readers that have just listed one.
KEPT = 20


class Conflict(RuntimeError):
    """Another writer took the version."""


class Manifest:
    """Versions of a list of entries under ``{base}/manifest``, read and written through Spark's file systems."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._context = jvm.org.apache.hadoop.fs.FileContext
        self._none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        self._io = jvm.org.apache.commons.io.IOUtils

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        top = self._path(f"{self.base}/manifest")
        fs = self._fs(top)
        if not fs.exists(top):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(top)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> tuple[int, list[dict]]:
        """The newest version and its entries; 0 and none at the beginning."""
        found = self.versions()
        if not found:
            return 0, []
        path = self._path(f"{self.base}/manifest/{found[-1]:012d}.json")
        stream = self._fs(path).open(path)
        try:
            text = self._io.toString(stream, "UTF-8")
        finally:
            stream.close()
        return found[-1], json.loads(text)

    def commit(self, version: int, entries: list[dict]) -> None:
        """Make ``entries`` the version after ``version``."""
        own = self._path(f"{self.base}/manifest/.{uuid.uuid4().hex}")
        stream = self._fs(own).create(own)
        try:
            self._io.write(json.dumps(entries), stream, "UTF-8")
        finally:
            stream.close()
        to = self._path(f"{self.base}/manifest/{version + 1:012d}.json")
        try:
            self._context.getFileContext(to.toUri(), self._conf).rename(own, to, self._to_array())
        except Exception as e:
            self._fs(own).delete(own, False)
            if "AlreadyExists" in str(e):
                raise Conflict(f"version {version + 1} of {self.base}") from e
            raise
        for old in self.versions()[:-KEPT]:
            self.delete(f"manifest/{old:012d}.json")

    def _to_array(self):
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._none
        return options

    def delete(self, name: str) -> None:
        """Delete a folder or file under the base."""
        path = self._path(f"{self.base}/{name}")
        self._fs(path).delete(path, True)


class CommittedTable:
    """Appends that happen once: each has a name, and a name that is in the manifest is not written again."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, partition: str | None = None):
        self.spark, self.base, self.schema, self.partition = spark, base.rstrip("/"), schema, partition
        self.manifest = Manifest(spark, base)

    def append(self, rows: DataFrame, name: str, tries: int = 20) -> bool:
        """Write ``rows`` under ``name``; False, and nothing written, if that was done before. Writers of different
        names may run side by side; of two of one name the first to commit counts."""
        if any(e["name"] == name for e in self.manifest.latest()[1]):
            return False
        folder = f"data/attempt={uuid.uuid4().hex}"
        w = rows.select(*self.schema.names).write
        (w.partitionBy(self.partition) if self.partition else w).parquet(f"{self.base}/{folder}")
        for _ in range(tries):
            version, entries = self.manifest.latest()
            if any(e["name"] == name for e in entries):
                self.manifest.delete(folder)
                return False
            try:
                self.manifest.commit(version, [*entries, {"name": name, "path": folder}])
                return True
            except Conflict:
                continue
        raise Conflict(f"{tries} versions of {self.base} went to others")

    def read(self) -> DataFrame:
        """All committed rows."""
        entries = self.manifest.latest()[1]
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.base}/data")
        return reader.parquet(*[f"{self.base}/{e['path']}" for e in entries]).select(*self.schema.names)


class CompactedLog:
    """A log of numbered batches in levels: every ``fanout`` folders of a level become one of the next.

    ``merge`` reduces rows of several batches to what a reader needs; merging in any grouping gives the same.
    A reader opens at most ``fanout`` - 1 folders a level, so the logarithm of the batches. A batch that is
    run again is found by its number, merged or not, and changes nothing. Folders that the last two versions
    do not name are deleted.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame], fanout: int = 8):
        self.spark, self.base, self.schema, self.merge, self.fanout = spark, base.rstrip("/"), schema, merge, fanout
        self.manifest = Manifest(spark, base)

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        folder = f"data/{level}-{first}-{last}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.base}/{folder}")
        return {"level": level, "first": first, "last": last, "path": folder}

    def _rows(self, entries: list[dict]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.base}/{e['path']}" for e in entries])

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Add a batch (numbers ascend); False if it is in the log already."""
        version, entries = self.manifest.latest()
        live, stale = [e for e in entries if e["level"] >= 0], [e for e in entries if e["level"] < 0]
        if any(e["first"] <= batch <= e["last"] for e in live):
            return False
        now, level = [*live, self._write(self.merge(rows), 0, batch, batch)], 0
        unnamed = []  # written and merged within this append
        while len(full := [e for e in now if e["level"] == level]) >= self.fanout:
            merged = self._write(self.merge(self._rows(full)), level + 1, min(e["first"] for e in full), max(e["last"] for e in full))
            unnamed += [e for e in full if e not in live]
            now = [e for e in now if e["level"] != level] + [merged]
            level += 1
        replaced = [{**e, "level": -1} for e in live if e not in now]  # readers of this version may still have them open
        self.manifest.commit(version, [*now, *replaced])
        for e in [*stale, *unnamed]:
            self.manifest.delete(e["path"])
        return True

    def folders(self) -> list[dict]:
        """The folders that a read opens."""
        return [e for e in self.manifest.latest()[1] if e["level"] >= 0]

    def read(self) -> DataFrame:
        """Merged rows of all batches."""
        entries = self.folders()
        return self.merge(self._rows(entries)) if entries else self.spark.createDataFrame([], self.schema)
