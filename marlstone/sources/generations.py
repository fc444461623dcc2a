"""A table kept as partitions of immutable generations, switched by one manifest file.

A writer puts new generations of the partitions it touches beside the old ones and then creates
the next numbered manifest, which only one writer can: another that was faster makes it look
again, and fails it if both changed one partition. Readers hold the manifest they opened, so they
see either all of a change or none of it, and a writer that dies leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer changed the same partitions first."""


class GenerationTable:
    """Parquet partitions (an integer column ``part``) under ``root`` on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, prefix: str) -> list[str]:
        at = self._path(self.root)
        return [n for s in (self._files.listStatus(at) if self._files.exists(at) else []) if (n := s.getPath().getName()).startswith(prefix)]

    def version(self) -> int:
        """The number of the current manifest, 0 before the first."""
        return max((int(n.split("-")[1].split(".")[0]) for n in self._names("MANIFEST-")), default=0)

    def _load(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if not number:
            return {"parts": {}, "mark": -1, "version": 0}
        stream = self._files.open(self._path(f"{self.root}/MANIFEST-{number:09d}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return {"parts": {int(k): v for k, v in found["parts"].items()}, "mark": found["mark"], "version": number}

    def manifest(self) -> dict[int, list[str]]:
        """The current generations of each partition."""
        return self._load()["parts"]

    def mark(self) -> int:
        """What the last change left as its mark, -1 before any."""
        return self._load()["mark"]

    def read(self, parts: Iterable[int] | None = None) -> DataFrame:
        """The current rows of the named partitions (all, if none are named), with ``part``."""
        now = self.manifest()
        chosen = sorted(now if parts is None else {p for p in parts if p in now})
        full = T.StructType([*self.schema.fields, T.StructField("part", T.LongType())])
        if not chosen:
            return self.spark.createDataFrame([], full)
        generations: dict[str, list[int]] = {}
        for p in chosen:
            for g in now[p]:
                generations.setdefault(g, []).append(p)
        frame = self.spark.read.schema(full).option("basePath", self.root)
        return frame.parquet(*(f"{self.root}/{g}/part={p}" for g, ps in generations.items() for p in ps)).select(*(f.name for f in full.fields))

    def publish(self, rows: DataFrame, replace: Iterable[int] = (), mark: int | None = None) -> None:
        """Switch in ``rows`` (which carry ``part``), atomically: partitions in ``replace`` hold them alone, others hold them too.

        A partition to be replaced that has no rows becomes empty. If another writer was faster,
        the change is made on top of its manifest, unless that changed a partition replaced
        here, or the mark: then this is a Conflict, and the table stays as the other left it.
        """
        replaced, seen = set(replace), self._load()
        new = f"gen={uuid.uuid4().hex}"
        rows.select(*(f.name for f in self.schema.fields), F.col("part").cast("bigint").alias("part")).write.partitionBy("part").parquet(f"{self.root}/{new}")
        made = {int(s.getPath().getName().split("=")[1]) for s in self._files.listStatus(self._path(f"{self.root}/{new}")) if s.getPath().getName().startswith("part=")}
        while True:
            now = self._load()
            if any(now["parts"].get(p) != seen["parts"].get(p) for p in replaced) or (mark is not None and now["mark"] != seen["mark"]):
                self._files.delete(self._path(f"{self.root}/{new}"), True)
                raise Conflict(f"{self.root}: changed by another writer since version {seen['version']}")
            parts = {p: gs for p, gs in now["parts"].items() if p not in replaced}
            for p in made:
                parts[p] = [*parts.get(p, []), new]
            if self._commit(now["version"] + 1, {"parts": parts, "mark": now["mark"] if mark is None else mark}):
                return

    def overwrite(self, rows: DataFrame, parts: Iterable[int], mark: int | None = None) -> None:
        """Replace exactly ``parts`` by ``rows``; rows of other parts are an error the caller has to rule out."""
        self.publish(rows, parts, mark)

    def _commit(self, number: int, content: dict) -> bool:
        """Create the manifest ``number``; False if it is there already."""
        jvm = self.spark._jvm
        temporary, final = self._path(f"{self.root}/.new-{uuid.uuid4().hex}"), self._path(f"{self.root}/MANIFEST-{number:09d}.json")
        out = self._files.create(temporary, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(temporary, final, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            self._files.delete(temporary, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def vacuum(self, keep: int = 1) -> int:
        """Delete the generations that none of the last ``keep`` manifests names, and older manifests; how many went.

        Only for times without writers or readers of older manifests.
        """
        numbers = sorted(int(n.split("-")[1].split(".")[0]) for n in self._names("MANIFEST-"))
        held = {g for n in numbers[-keep:] for gs in self._load(n)["parts"].values() for g in gs}
        gone = [g for g in self._names("gen=") if g not in held]
        for name in [*gone, *(f"MANIFEST-{n:09d}.json" for n in numbers[:-keep])]:
            self._files.delete(self._path(f"{self.root}/{name}"), True)
        return len(gone)
