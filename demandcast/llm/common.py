"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.session import resolve_checkpoint_dir

# bytes.split() without arguments splits on exactly these: [\x20\x09-\x0D]+
WORD_SPACE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact name, whatever else ``df`` holds.

    Columns whose names differ only in case, or repeat, would make a plain
    ``select`` ambiguous; the first column of exactly that name counts.
    """
    where = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(where, names)])


def keep_row(df: DataFrame, *names: str) -> DataFrame:
    """(_row, the named columns): every column of ``df`` packed into ``_row``,
    so that names an operator adds cannot clash with columns of the input."""
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(
        F.struct(*[F.col(c) for c in plain.columns]).alias("_row"),
        *[F.col(f"_c{df.columns.index(n)}").alias(n) for n in names],
    )


def unpack_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """Undo :func:`keep_row`: the input's columns under their own names."""
    return df.select(*[F.col("_row")[f"_c{i}"] for i in range(len(columns))]).toDF(*columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` whose Python workers find this package where the
    driver found it (on a cluster, install it or pass it with --py-files)."""
    home = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return df.mapInArrow(function, schema)


class Scratch:
    """Tables written below the session's checkpoint folder and read back.

    Cuts lineage: a lost executor costs at most the tasks of one step, and a
    step used twice is computed once.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{resolve_checkpoint_dir(spark).rstrip('/')}/demandcast-{label}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame, name: str = "step") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the folder (for callers whose result no longer reads it)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def rows_in(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``size`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def python_strings(column: pa.Array) -> list[str]:
    """Values as str, null as the empty string."""
    return ["" if v is None else v for v in column.to_pylist()]


def python_bytes(column: pa.Array) -> Iterator[bytes]:
    """Values of a string column as UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind):
        raw = v.as_py()
        yield b"" if raw is None else raw


class Memo(dict):
    """A dict that fills itself from a function and starts anew beyond ``limit`` entries."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value
