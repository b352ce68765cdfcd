"""Snapshots: builds of all tables that become visible by one write.

A destination holds ``builds/<id>/<table>`` and ``manifests/<nr>-<id>.json``.
A build writes its tables into a folder of its own, which no reader knows. Its
manifest names the folder of every table, their row counts, layouts and
columns, and the results of the checks that rode on the writes; it is written
under another name and renamed, so it is there whole or not at all. Readers
take the manifest with the greatest number once and stay with the tables it
names. A build that fails has no manifest; one that publishes while a reader
reads changes nothing for that reader.

All access goes through Hadoop's file systems, as Spark's own does.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import SparkSession


class Folder:
    """Small files and listings of a folder in any store Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self.root = path.rstrip("/")
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        if not self.fs.exists(self.at(name)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name)))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole, under a name that must be new."""
        aside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.at(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(self.at(aside), self.at(name)):
            self.fs.delete(self.at(aside), False)
            raise FileExistsError(name)

    def move(self, name: str, to: str) -> None:
        if not self.fs.rename(self.at(name), self.at(to)):
            raise FileExistsError(to)

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def new_build(dest: str) -> tuple[str, str]:
    """Id and folder of a build that is about to be written."""
    build = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    return build, f"{dest.rstrip('/')}/builds/{build}"


def _manifests(folder: Folder) -> list[str]:
    return [n for n in folder.names("manifests") if n.endswith(".json")]


def publish(spark: SparkSession, dest: str, build: str, manifest: dict) -> str:
    """Make a build the current one: one file appears. Returns its name."""
    folder = Folder(spark, dest)
    last = max((int(n.split("-")[0]) for n in _manifests(folder)), default=0)
    name = f"{last + 1:09d}-{build}.json"
    folder.write(f"manifests/{name}", json.dumps({"build": build, **manifest}, default=str))
    return name


def current(spark: SparkSession, dest: str) -> dict | None:
    """The manifest of the current build, None where nothing is published."""
    folder = Folder(spark, dest)
    found = _manifests(folder)
    return json.loads(folder.read(f"manifests/{found[-1]}")) if found else None


def builds(spark: SparkSession, dest: str) -> list[dict]:
    """Every build: id, manifest (None: not published), current or not."""
    folder = Folder(spark, dest)
    by_build = {n.split("-", 1)[1].removesuffix(".json"): n for n in _manifests(folder)}
    last = max(by_build.values(), default=None)
    return [{"build": b, "manifest": by_build.get(b), "current": last is not None and by_build.get(b) == last}
            for b in sorted(set(folder.names("builds")) | set(by_build))]


def drop_builds(spark: SparkSession, dest: str, keep: int = 1, unpublished: bool = False) -> list[str]:
    """Drop all but the last ``keep`` published builds, manifests first, so no
    new reader finds a build that goes; with ``unpublished`` also folders
    without a manifest (builds under way are among them)."""
    if keep < 1:
        raise ValueError("the current build stays")
    folder = Folder(spark, dest)
    known = builds(spark, dest)
    old = sorted((b for b in known if b["manifest"]), key=lambda b: b["manifest"])[:-keep]
    if unpublished:
        old += [b for b in known if not b["manifest"]]
    for b in old:
        if b["manifest"]:
            folder.drop(f"manifests/{b['manifest']}")
        folder.drop(f"builds/{b['build']}")
    return [b["build"] for b in old]
