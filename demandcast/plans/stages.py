"""Stages with manifests: written once, reused while they are valid.

A stage is a table and a manifest beside it. The manifest is written after the
table, so it is the commit mark: without one, whatever lies in the stage's
folder is half-written and is done anew. It holds what the stage was made of
(the listing of its input files, its parameters) and what came out (the
listing of its own files, the row count); if any of it has changed, the stage
is done anew.

:class:`StageStore` keeps stages in a folder of the caller (the pipeline's
artefacts). :func:`session_store` is one in the session's checkpoint folder,
for tables that several queries share; the file system drops it when the
application ends, or :meth:`StageStore.drop` before.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.session import resolve_checkpoint_dir

MANIFESTS = "_manifests"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def listing(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the files below ``paths``: names, sizes, times. The files are
    listed by Spark, and their contents are not read."""
    there = [p for p in sorted(paths) if _exists(spark, p)]
    found = [sorted(paths), there]
    if there:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
        row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                        F.sum(F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")).alias("hash")).first()
        found.append([row["n"], row["bytes"], str(row["hash"])])
    return hashlib.sha256(json.dumps(found).encode()).hexdigest()


def _exists(spark: SparkSession, name: str) -> bool:
    at, fs = _path(spark, name)
    return fs.exists(at)


@dataclass
class StageStore:
    spark: SparkSession
    folder: str
    done: list[str] = field(default_factory=list)  # stages written by this run
    reused: list[str] = field(default_factory=list)  # stages found valid

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def _manifest(self, name: str):
        return _path(self.spark, f"{self.folder.rstrip('/')}/{MANIFESTS}/{name}.json")

    def manifest(self, name: str) -> dict | None:
        """The stage's manifest, None if it was never finished."""
        at, fs = self._manifest(name)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, name: str, manifest: Mapping) -> None:
        """Write a stage's manifest (callers that write their table by parts)."""
        at, fs = self._manifest(name)
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            stream.close()

    def valid(self, name: str, inputs: Sequence[str], parameters: Mapping) -> bool:
        """Whether the stage is finished, made of these inputs and parameters,
        and its files are those it wrote."""
        known = self.manifest(name)
        return bool(known is not None and known["parameters"] == json.loads(json.dumps(parameters, default=str))
                and known["inputs"] == listing(self.spark, inputs) and known["output"] == listing(self.spark, [self.path(name)]))

    def run(self, name: str, inputs: Sequence[str], parameters: Mapping, build: Callable[[], DataFrame | tuple[DataFrame, dict]],
            write: Callable[[DataFrame, str], object] | None = None) -> DataFrame:
        """The stage's table: read if valid, else built, written and committed.

        ``build`` may return notes for the manifest beside the table; ``write``
        puts the table at a path, by default it overwrites Parquet."""
        path = self.path(name)
        if self.valid(name, inputs, parameters):
            self.reused.append(name)
            return self.spark.read.parquet(path)
        self.forget(name)  # from here on the stage counts as half-written
        made = listing(self.spark, inputs)
        table, notes = built if isinstance(built := build(), tuple) else (built, {})
        if write is None:
            table.write.mode("overwrite").parquet(path)
        else:
            write(table, path)
        written = self.spark.read.parquet(path)
        self.commit(name, {"inputs": made, "parameters": json.loads(json.dumps(parameters, default=str)),
                            "output": listing(self.spark, [path]), "rows": written.count(), "notes": notes})
        self.done.append(name)
        return written

    def forget(self, name: str) -> None:
        """Take back a stage's commit, so that it is done anew."""
        at, fs = self._manifest(name)
        fs.delete(at, False)

    def drop(self) -> None:
        """Remove the folder with all its stages."""
        at, fs = _path(self.spark, self.folder)
        fs.delete(at, True)


def session_store(spark: SparkSession, label: str) -> StageStore:
    """Stages of this application under ``label``, below the checkpoint folder;
    gone when the application ends."""
    folder = f"{resolve_checkpoint_dir(spark).rstrip('/')}/demandcast-{spark.sparkContext.applicationId}-{label}"
    at, fs = _path(spark, folder)
    fs.mkdirs(at)  # only what exists can be marked
    fs.deleteOnExit(at)
    return StageStore(spark, folder)
